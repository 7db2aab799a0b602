"""Quality classifier: histogram gradient-boosted trees over document statistics.

Every text becomes a row of statistics. Trees of one depth are boosted on the logistic loss:
features are cut into bins at their quantiles, and a level's best splits come from the sums of
gradients per node, feature and bin. The trees are then flattened into arrays [tree, node], whose
children lie at 2i+1 and 2i+2, and all rows of a batch walk all trees together in numpy.

Training takes a bounded sample, ``ROWS`` labelled documents drawn by a hash of their id, which
are picked from the corpus by a broadcast of that sample. Scoring reads every text whole, once, in
place, without a shuffle or a table in between.

Defined results: null counts as the empty text, which is scored like any other; repeated rows get
equal scores; without labelled rows every score is 0.5. Labels other than 0 and 1 are ignored;
a document with several labels counts with each.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hushmark.llm.common import bounded_sample, id_remainder, per_batch, ship, table

ROWS = 20_000
TREES, DEPTH, BINS, RATE, RIDGE = 60, 4, 64, 0.2, 2.0
CUT = 0.3

FEATURES = (
    "words", "chars_per_word", "symbols", "pipes", "marks", "upper", "digits", "other", "kinds",
    "repeats", "lines", "dup_lines", "words_per_line", "commonest", "stops", "packed",
)


def describe(text: str | None) -> list[float]:
    """The values of ``FEATURES`` for one text."""
    import zlib
    from collections import Counter

    text = text or ""
    data = text.encode()
    words = data.split()
    lines = [x for x in data.split(b"\n") if x.strip()]
    n, size = max(1, len(words)), max(1, len(data))
    without = lambda drop: (len(data) - len(data.translate(None, drop))) / size
    often = Counter(words)
    return [
        np.log1p(len(words)),
        sum(map(len, words)) / n,
        without(b"#*$%&<>@^~_=+{}[]\\"),
        data.count(b"|") / n,
        without(b"!?"),
        without(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
        without(b"0123456789"),
        without(bytes(range(128, 256))),
        len(often) / n,
        sum(a == b for a, b in zip(words, words[1:], strict=False)) / n,
        np.log1p(len(lines)),
        1 - len(set(lines)) / max(1, len(lines)),
        n / max(1, len(lines)),
        max(often.values(), default=0) / n,
        without(b".,;:"),
        len(zlib.compress(data, 1)) / (size + 20),
    ]


def statistics(docs: DataFrame) -> DataFrame:
    """(doc_id, x array<double>) for docs (doc_id, text)."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return per_batch(
        docs.select("doc_id", "text"),
        lambda x: {"doc_id": x["doc_id"], "x": [describe(t) for t in x["text"]]},
        f"doc_id {kind}, x array<double>",
    )


@dataclass(frozen=True)
class Trees:
    feature: np.ndarray
    split: np.ndarray
    leaf: np.ndarray
    start: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row: all trees at once, one level a step."""
        if not len(x):
            return np.zeros(0)
        total = np.full(len(x), self.start)
        if len(self.feature):
            tree, rows = np.arange(len(self.feature)), np.arange(len(x))[:, None]
            depth = int(np.log2(self.leaf.shape[1]))
            for at in range(0, len(x), 4096):
                part = x[at : at + 4096]
                node = np.zeros((len(part), len(tree)), np.int64)
                for _ in range(depth):
                    node = 2 * node + 1 + (part[rows[: len(part)], self.feature[tree, node]] > self.split[tree, node])
                total[at : at + 4096] += self.leaf[tree, node - self.feature.shape[1]].sum(axis=1)
        return 1 / (1 + np.exp(-total))


def boost(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, bins: int = BINS, rate: float = RATE, ridge: float = RIDGE) -> Trees:
    """Fit on rows ``x`` with labels ``y`` (0 or 1)."""
    inner, leaves = 2**depth - 1, 2**depth
    feature, split, leaf = np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf), np.zeros((trees, leaves))
    if not len(y) or y.min() == y.max():
        share = np.clip(y.mean(), 0.01, 0.99) if len(y) else 0.5
        return Trees(feature[:0], split[:0], leaf[:0], float(np.log(share / (1 - share))))
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T]
    binned = np.stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T, strict=True)], axis=1)  # bin b: up to edge b
    start = float(np.log(y.mean() / (1 - y.mean())))
    raw, n_features = np.full(len(y), start), x.shape[1]
    for t in range(trees):
        p = 1 / (1 + np.exp(-raw))
        g, h, node = p - y, p * (1 - p), np.zeros(len(y), np.int64)
        for level in range(depth):
            width, first = 2**level, 2**level - 1
            key = ((node - first)[:, None] * n_features + np.arange(n_features)) * bins + binned
            sums = [np.bincount(key.ravel(), np.repeat(v, n_features), width * n_features * bins).reshape(width, n_features, bins) for v in (g, h)]
            (gl, hl), (ga, ha) = ([s.cumsum(axis=2) for s in sums]), ([s.sum(axis=2, keepdims=True) for s in sums])
            gain = gl**2 / (hl + ridge) + (ga - gl) ** 2 / (ha - hl + ridge) - ga**2 / (ha + ridge)
            for f, e in enumerate(edges):
                gain[:, f, len(e) :] = 0  # nothing lies above the last edge
            best = gain.reshape(width, -1).argmax(axis=1)
            f, b = np.divmod(best, bins)
            use = gain.reshape(width, -1)[np.arange(width), best] > 1e-9
            feature[t, first : first + width] = np.where(use, f, 0)
            split[t, first : first + width] = [edges[i][j] if u else np.inf for i, j, u in zip(f, b, use, strict=True)]
            own = node - first
            node = 2 * node + 1 + (use[own] & (binned[np.arange(len(y)), f[own]] > b[own]))
        own = node - inner
        leaf[t] = -rate * np.bincount(own, g, leaves) / (np.bincount(own, h, leaves) + ridge)
        raw += leaf[t, own]
    return Trees(feature, split, leaf, start)


def fit(docs: DataFrame, labels: DataFrame, rows: int = ROWS) -> Trees:
    """Trees from at most ``rows`` labelled documents; labels (doc_id, quality)."""
    known = labels.select("doc_id", F.col("quality").cast("int").alias("y")).where("y in (0, 1) and doc_id is not null")
    drawn = bounded_sample(known.withColumn("_all", F.lit("all")), "_all", rows, "doc_id").drop("_all")
    drawn = drawn.orderBy("_draw", "doc_id", "y").limit(rows).select("doc_id", "y")
    text = docs.select("doc_id", "text").join(F.broadcast(drawn), "doc_id")  # bounded by the sample
    stats = statistics(text.select(F.struct("doc_id", "y").alias("doc_id"), "text"))
    found = sorted(stats.collect(), key=lambda r: (str(r.doc_id), r.x))
    x = np.array([r.x for r in found], dtype=float).reshape(-1, len(FEATURES))
    return boost(x, np.array([r.doc_id.y for r in found], dtype=float))


def classify(docs: DataFrame, trees: Trees, cut: float = CUT) -> DataFrame:
    """(doc_id, score, predicted) for every row of ``docs`` (doc_id, text)."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(x: dict[str, list]) -> dict[str, list]:
        score = trees.score(np.array([describe(t) for t in x["text"]]))
        return {"doc_id": x["doc_id"], "score": score.tolist(), "predicted": (score >= cut).astype(int).tolist()}

    return per_batch(docs.select("doc_id", "text"), run, f"doc_id {kind}, score double, predicted int")


def keep_good(docs: DataFrame, trees: Trees, cut: float = CUT) -> DataFrame:
    """The rows of ``docs`` scored ``cut`` or more, all columns unchanged, in one pass."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                x = np.array([describe(t) for t in part.column("text").to_pylist()])
                yield part.filter(pa.array(trees.score(x) >= cut))

    return docs.mapInArrow(run, docs.schema)


def training_labels(labels: DataFrame) -> DataFrame:
    """The labels that may be learned from: crc32 of the id modulo 5 is not 0."""
    return labels.where(id_remainder(F.col("doc_id"), 5) != 0)


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = classify(docs, fit(docs, training_labels(table(spark, sf_dir, "labels"))))
    return found.select("doc_id", (id_remainder(F.col("doc_id"), 5) == 0).alias("held_out"), "score", "predicted")
