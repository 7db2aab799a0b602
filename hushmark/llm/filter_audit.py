"""Filter interaction audit: five document filters, every order, what each step removes.

Filters, on whole texts (null: empty; words: maximal runs without ASCII blanks, case-sensitive):

* A: under 50 words;
* B: fewer than 65 distinct words per 100 words;
* C: more than 5 capitals ``A-Z`` per 100 code points;
* D: holds any of ``# $ % & * |``;
* E: the same text as a row with a smaller doc_id, table-wide (null ids are never smaller, and never fail E).

The statistics of A-D come from one pass over each text's UTF-8 bytes by a table-driven transducer: a
256-entry table gives each byte its class (blank, capital, symbol, continuation byte, other), a state
table over (inside a word, class) says where words start and end, and the word spans are inserted into
a hash table whose keys are the words' bytes, so equal hashes are verified by comparing bytes.

Spark does the rest: E from the least id per text digest (an aggregate that combines before its
shuffle); rows are then folded to (part, failures, good, toxic) with a count, so hot sources, hot ids
and large groups of copies are counted, never gathered; the 120 orders are applied to that small table.

Result: one row per part (``source``; null: the empty string), order (a permutation of ``ABCDE``) and
step (1-5): kept after the step, removed at it, redundant (failing its filter, removed before),
unique_fails (failing only its filter), good_lost and toxic_lost (removed at it, with a ``labels`` row
of quality 1 or toxic 1 for the id; several label rows: any of them; a null id matches no label), and shapley (what its filter
removes, summed over all 120 orders). Parts of an empty table: none, so an empty result.
"""

from __future__ import annotations

from itertools import permutations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hushmark.llm.common import per_batch, table

LETTERS = "ABCDE"
BIT = {c: 1 << i for i, c in enumerate(LETTERS)}

# Fixed values of the filters, as the contract gives them.
MIN_WORDS = 50
DISTINCT_PCT = 65
CAPITALS_PCT = 5
SYMBOLS = b"#$%&*|"
BLANKS = b"\x20\x09\x0a\x0b\x0c\x0d"

OTHER, BLANK, CAPITAL, SYMBOL, TRAIL = range(5)


def _classes() -> np.ndarray:
    made = np.full(256, OTHER, np.uint8)
    made[0x80:0xC0] = TRAIL
    made[ord("A") : ord("Z") + 1] = CAPITAL
    made[list(SYMBOLS)] = SYMBOL
    made[list(BLANKS)] = BLANK
    return made


#: byte -> class
CLASS = _classes()
#: (inside a word, class) -> inside a word after the byte
NEXT = np.array([[c != BLANK for c in range(5)]] * 2, bool)


def measure(text: str | None) -> tuple[int, int, int, int, int]:
    """(words, distinct words, capitals, code points, symbols) of a text in one pass over its bytes."""
    raw = (text or "").encode("utf-8")
    if not raw:
        return 0, 0, 0, 0, 0
    kinds = CLASS[np.frombuffer(raw, np.uint8)]
    inside = NEXT[1, kinds]
    before = np.concatenate(([False], inside[:-1]))
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(~inside & before)
    if len(ends) < len(starts):
        ends = np.append(ends, len(raw))
    seen: set[bytes] = set()
    for s, e in zip(starts.tolist(), ends.tolist()):
        seen.add(raw[s:e])
    counts = np.bincount(kinds, minlength=5)
    return len(starts), len(seen), int(counts[CAPITAL]), len(raw) - int(counts[TRAIL]), int(counts[SYMBOL])


def _measured(columns: dict[str, list]) -> dict[str, list]:
    made = [measure(t) for t in columns["text"]]
    out = {k: columns[k] for k in ("doc_id", "part", "h")}
    for i, name in enumerate(("n_words", "n_distinct", "n_capitals", "n_points", "n_symbols")):
        out[name] = [m[i] for m in made]
    return out


def failures(docs: DataFrame) -> DataFrame:
    """(part, doc_id, good, toxic, mask, n) with ``mask`` the failed filters as bits, ``n`` its rows."""
    keyed = docs.select(
        "doc_id",
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
        F.unhex(F.sha2(F.coalesce(F.col("text"), F.lit("")), 256)).alias("h"),
        "text",
    )
    schema = "doc_id long, part string, h binary, n_words long, n_distinct long, n_capitals long, n_points long, n_symbols long"
    stats = per_batch(keyed, _measured, schema)
    mask = (
        F.when(F.col("n_words") < MIN_WORDS, BIT["A"]).otherwise(0)
        + F.when(100 * F.col("n_distinct") < DISTINCT_PCT * F.col("n_words"), BIT["B"]).otherwise(0)
        + F.when(100 * F.col("n_capitals") > CAPITALS_PCT * F.col("n_points"), BIT["C"]).otherwise(0)
        + F.when(F.col("n_symbols") > 0, BIT["D"]).otherwise(0)
    )
    # equal rows fold into one before any key is shuffled
    folded = stats.groupBy("part", "h", "doc_id", mask.alias("mask")).agg(F.count(F.lit(1)).alias("n"))
    least = stats.groupBy("h").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    with_e = folded.join(least, ["h", "doc_id"], "left").select(
        "part", "doc_id", "n",
        (F.col("mask") + F.when(F.col("doc_id").isNotNull() & F.col("first").isNull(), BIT["E"]).otherwise(0)).alias("mask"),
    )
    return with_e.groupBy("part", "doc_id", "mask").agg(F.sum("n").alias("n"))


def _labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    flags = labels.groupBy("doc_id").agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"),
    )
    # an id has at most (parts x 32) folded rows, so no id is hot on this side any more
    joined = rows.join(flags, "doc_id", "left")
    return joined.groupBy("part", "mask", F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic")).agg(
        F.sum("n").alias("n")
    )


def _steps() -> list[tuple[str, int, int, int]]:
    """(order, step, bit of its filter, bits of the filters before it), for all 120 orders."""
    made = []
    for order in permutations(LETTERS):
        for k, letter in enumerate(order):
            made.append(("".join(order), k + 1, BIT[letter], sum(BIT[c] for c in order[:k])))
    return made


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The audit over ``docs`` (doc_id, text, source) with ``labels`` (doc_id, quality, toxic)."""
    groups = _labelled(failures(docs.select("doc_id", "text", "source")), labels.select("doc_id", "quality", "toxic"))
    steps = F.array(*[F.struct(F.lit(o).alias("filter_order"), F.lit(s).alias("step"), F.lit(b).alias("bit"), F.lit(e).alias("before")) for o, s, b, e in _steps()])
    flat = groups.select("part", "mask", "good", "toxic", "n", F.explode(steps).alias("s")).select("part", "mask", "good", "toxic", "n", "s.*")
    fails, earlier = (F.col("mask").bitwiseAND(F.col("bit")) != 0), (F.col("mask").bitwiseAND(F.col("before")) != 0)
    removed = fails & ~earlier
    total = lambda cond: F.sum(F.when(cond, F.col("n")).otherwise(0)).cast("long")
    per_step = flat.groupBy("part", "filter_order", "step", "bit").agg(
        total(~fails & ~earlier).alias("kept"),
        total(removed).alias("removed"),
        total(fails & earlier).alias("redundant"),
        total(F.col("mask") == F.col("bit")).alias("unique_fails"),
        total(removed & F.col("good")).alias("good_lost"),
        total(removed & F.col("toxic")).alias("toxic_lost"),
    )
    shapley = F.sum("removed").over(Window.partitionBy("part", "bit")).cast("long")
    return per_step.select(
        "part", "filter_order", F.col("step").cast("int").alias("step"),
        "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", shapley.alias("shapley"),
    )


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


ORACLE = r"""
WITH d AS (
  SELECT doc_id, coalesce(CAST(source AS VARCHAR), '') AS part, coalesce(text, '') AS t FROM documents),
w AS (
  SELECT doc_id, part, t, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM d),
m AS (
  SELECT doc_id, part,
    (CASE WHEN len(ws) < 50 THEN 1 ELSE 0 END)
    + (CASE WHEN 100 * len(list_distinct(ws)) < 65 * len(ws) THEN 2 ELSE 0 END)
    + (CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t) THEN 4 ELSE 0 END)
    + (CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END)
    + (CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 16 ELSE 0 END) AS mask
  FROM w),
lab AS (
  SELECT doc_id, bool_or(coalesce(quality = 1, false)) AS good, bool_or(coalesce(toxic = 1, false)) AS toxic
  FROM labels GROUP BY doc_id),
g AS (
  SELECT part, mask, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic, count(*) AS n
  FROM m LEFT JOIN lab USING (doc_id) GROUP BY ALL),
l AS (SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) v(c, b)),
o AS (
  SELECT l1.c || l2.c || l3.c || l4.c || l5.c AS filter_order, [l1.b, l2.b, l3.b, l4.b, l5.b] AS bits
  FROM l l1, l l2, l l3, l l4, l l5
  WHERE l1.b + l2.b + l3.b + l4.b + l5.b = 31 AND l1.b | l2.b | l3.b | l4.b | l5.b = 31),
s AS (
  SELECT filter_order, k AS step, bits[k] AS bit, list_sum(bits[1:k - 1]) AS before
  FROM o, range(1, 6) r(k)),
c AS (
  SELECT g.part, s.filter_order, CAST(s.step AS INTEGER) AS step, s.bit,
    CAST(sum(CASE WHEN g.mask & s.bit = 0 AND g.mask & coalesce(s.before, 0) = 0 THEN n ELSE 0 END) AS BIGINT) AS kept,
    CAST(sum(CASE WHEN g.mask & s.bit <> 0 AND g.mask & coalesce(s.before, 0) = 0 THEN n ELSE 0 END) AS BIGINT) AS removed,
    CAST(sum(CASE WHEN g.mask & s.bit <> 0 AND g.mask & coalesce(s.before, 0) <> 0 THEN n ELSE 0 END) AS BIGINT) AS redundant,
    CAST(sum(CASE WHEN g.mask = s.bit THEN n ELSE 0 END) AS BIGINT) AS unique_fails,
    CAST(sum(CASE WHEN g.mask & s.bit <> 0 AND g.mask & coalesce(s.before, 0) = 0 AND good THEN n ELSE 0 END) AS BIGINT) AS good_lost,
    CAST(sum(CASE WHEN g.mask & s.bit <> 0 AND g.mask & coalesce(s.before, 0) = 0 AND toxic THEN n ELSE 0 END) AS BIGINT) AS toxic_lost
  FROM g, s GROUP BY ALL)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
FROM c
"""
