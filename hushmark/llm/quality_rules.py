"""Quality rules with an isolation forest over their statistics.

Each text gives a handful of rule statistics. Fixed rules fail the hopeless ones. For the rest, an
isolation forest says how few random splits set a document apart from the others: the shorter its
mean path, the more anomalous. The forest grows on a bounded sample of all documents, the way
isolation forests do. The score above which a document goes is calibrated on all labelled rows:
their scores are counted in bins by label, and the threshold is the one that catches most bad rows
while losing no more than ``MOST_LOST`` of the good ones.

Texts are read once, in place; the statistics, a few numbers a document, are written and used for
sampling, calibration and scoring.

Defined results: null is the empty text, which has no words and fails; repeated rows get a result
each; without labelled rows the forest rejects nothing. Labels other than 0 and 1 are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hushmark.llm.common import bounded_sample, per_batch, ship, table, written

SPAN = 5
SYMBOLS = "#*$%&|<>"
ROWS = 20_000
TREES, LEAVES = 200, 64
BINS = 2000
MOST_LOST = 0.003
SEED = 7

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_marks")


def repeated_words(words: list[bytes], span: int = SPAN) -> int:
    """Places covered by runs of ``span`` words that the text has twice or more."""
    n = len(words) - span + 1
    if n < 2:
        return 0
    if n <= 1 << 16:
        runs = list(zip(*(words[i:] for i in range(span)), strict=False))
        often = Counter(runs)
        if len(often) == n:
            return 0
        starts = np.fromiter((often[r] > 1 for r in runs), bool, n)
    else:  # the same with numbers for words, in less memory
        known: dict[bytes, int] = {}
        ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))
        code = ids[:n]
        for i in range(1, span):
            code = np.unique(code * len(known) + ids[i : n + i], return_inverse=True)[1].astype(np.int64)
        starts = np.bincount(code)[code] > 1
    change = np.zeros(len(words) + 1, np.int64)
    at = np.flatnonzero(starts)
    np.add.at(change, at, 1)
    np.add.at(change, at + span, -1)
    return int((np.cumsum(change)[:-1] > 0).sum())


def counts(text: str | None) -> tuple[int, ...]:
    """The numbers named in ``COUNTS`` for one text."""
    text = text or ""
    data = text.encode()
    words = data.split()  # of bytes: ASCII blanks only
    lines = [x for x in data.split(b"\n") if x.strip()]
    blanks = sum(map(text.count, " \t\n\v\f\r"))
    upper = len(data) - len(data.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
    marks = sum(map(text.count, "!?"))
    return (
        len(words), len(text) - blanks, sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)),
        repeated_words(words), len(lines), upper, marks,
    )


def statistics(docs: DataFrame) -> DataFrame:
    """(doc_id, and a long for each of ``COUNTS``) for docs (doc_id, text)."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(x: dict[str, list]) -> dict[str, list]:
        found = list(map(counts, x["text"]))
        return {"doc_id": x["doc_id"]} | dict(zip(COUNTS, map(list, zip(*found, strict=True)), strict=True))

    return per_batch(docs.select("doc_id", "text"), run, f"doc_id {kind}, " + ", ".join(f"{c} long" for c in COUNTS))


def features(c: np.ndarray) -> np.ndarray:
    """What the forest splits on, from rows of ``COUNTS``: shares that good texts keep near zero.

    Roots spread the small values. What the fixed rules judge already (length, repeats) stays out, as
    every further column blunts random splits.
    """
    words, chars, symbols, _, _, _, upper, marks = c.T.astype(float)
    letters = np.maximum(chars, 1)
    return np.sqrt(np.stack([symbols / letters, np.minimum(marks / np.maximum(words, 1), 1), upper / letters], axis=1))


@dataclass(frozen=True)
class Forest:
    """Trees of one depth as arrays [tree, node]; the children of node i are 2i+1 and 2i+2."""

    feature: np.ndarray
    split: np.ndarray
    path: np.ndarray
    usual: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """0 to 1; the higher, the fewer splits set a row apart."""
        if not len(self.feature) or not len(x):
            return np.zeros(len(x))
        total, rows = np.zeros(len(x)), np.arange(len(x))
        for feature, split, path in zip(self.feature, self.split, self.path, strict=True):
            node = np.zeros(len(x), np.int64)
            while (inner := feature[node] >= 0).any():
                right = x[rows, feature[node]] >= split[node]
                node = np.where(inner, 2 * node + 1 + right, node)
            total += path[node]
        return 2.0 ** (-total / len(self.feature) / self.usual)


def _usual_path(n: int | np.ndarray) -> np.ndarray:
    """Mean path of an unsuccessful search among n."""
    n = np.asarray(n, float)
    m = np.maximum(n, 2)
    return np.where(n < 2, 0.0, 2 * (np.log(m - 1) + 0.5772156649) - 2 * (m - 1) / m)


def grow(x: np.ndarray, trees: int = TREES, leaves: int = LEAVES, seed: int = SEED) -> Forest:
    """An isolation forest over the rows of ``x``; every tree draws ``leaves`` of them."""
    depth = int(np.ceil(np.log2(max(2, min(leaves, len(x))))))
    size = 2 ** (depth + 1) - 1
    feature, split, path = np.full((trees, size), -1), np.zeros((trees, size)), np.zeros((trees, size))
    if len(x) < 2:
        return Forest(feature[:0], split[:0], path[:0], 1.0)
    for t in range(trees):
        rng = np.random.default_rng([seed, t])
        todo = [(0, 0, x[rng.choice(len(x), min(leaves, len(x)), replace=False)])]
        while todo:
            node, level, rows = todo.pop()
            low, high = (rows.min(axis=0), rows.max(axis=0)) if len(rows) else (np.zeros(1), np.zeros(1))
            able = np.flatnonzero(high > low)
            if level == depth or not len(able):
                path[t, node] = level + _usual_path(len(rows))
                continue
            f = rng.choice(able)
            at = rng.uniform(low[f], high[f])
            feature[t, node], split[t, node] = f, at
            right = rows[:, f] >= at
            todo += [(2 * node + 1, level + 1, rows[~right]), (2 * node + 2, level + 1, rows[right])]
    return Forest(feature, split, path, float(_usual_path(min(leaves, len(x)))))


def scored(stats: DataFrame, forest: Forest) -> DataFrame:
    """``stats`` with the forest's score, a batch of rows at a time."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import DoubleType, StructType

    ship(stats.sparkSession)
    schema = StructType(stats.schema.fields[:]).add("score", DoubleType())
    out = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = features(np.stack([batch.column(c).to_numpy() for c in COUNTS], axis=1))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(forest.score(x))], schema=out)

    return stats.mapInArrow(run, schema)


def base_failed():
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def calibrate(found: DataFrame, labels: DataFrame, most_lost: float = MOST_LOST, bins: int = BINS) -> float:
    """The score at which documents go, from all labelled rows that the fixed rules leave.

    Only counts per bin and label reach the driver.
    """
    known = labels.select("doc_id", "quality").where("quality in (0, 1)")
    rows = found.where(~base_failed()).join(known, "doc_id")
    tally = rows.groupBy(F.floor(F.col("score") * bins).cast("int").alias("bin"), "quality").count().collect()
    n = np.zeros((2, bins + 2))
    for r in tally:
        n[int(r.quality), r.bin] += r["count"]
    at_or_above = n[:, ::-1].cumsum(axis=1)[:, ::-1]
    lost, caught = at_or_above[1] / max(1, n[1].sum()), at_or_above[0]
    fine = np.flatnonzero((lost <= most_lost) & (caught > 0))
    if not len(fine):
        return float("inf")
    best = fine[np.argmax(caught[fine] - 1e-9 * fine)]
    # of thresholds that catch the same, the highest loses fewest
    best = max(i for i in fine if caught[i] == caught[best])
    return float(best / bins)


def apply_rules(docs: DataFrame, labels: DataFrame, rows: int = ROWS, most_lost: float = MOST_LOST) -> DataFrame:
    """Statistics, score and verdict for every row of ``docs`` (doc_id, text); labels (doc_id, quality)."""
    stats = written(statistics(docs), "rule-statistics")
    drawn = bounded_sample(stats.withColumn("_all", F.lit("all")), "_all", rows, "doc_id", *COUNTS)
    sample = np.array([[r[c] for c in COUNTS] for r in sorted(drawn.collect(), key=lambda r: (r._draw, str(r.doc_id)))[:rows]], dtype=float)
    forest = grow(features(sample.reshape(-1, len(COUNTS))))
    found = scored(stats, forest)
    threshold = calibrate(found, labels, most_lost)
    failed = base_failed()
    return found.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), (~failed & (F.col("score") < F.lit(threshold))).alias("kept"), "score",
    )


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
