"""License scans by ordered signature rules.

A few hundred regular expressions over a text's words (``license_rules``). Each has a keyword, a word
that every match holds. One pass over the texts makes words and keeps the words of those texts
only that hold a keyword at all; each of these then meets the rules of its own keywords. Matches
are stretches of words. One inside another of higher priority, or inside a longer or earlier one
of the same, is suppressed: a running maximum per priority over a document's matches in order of
their start finds that without comparing pairs. What stays gives the labels.

Built from DataFrame functions. The rule table is a fixed list.

Defined results: a null or wordless text has no words, no places, empty labels, score 0 and null
places; repeated rows get a result each; of equal stretches the rule of higher priority, then
the earlier one, stays.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hushmark.llm.common import lower_words, table, written
from hushmark.llm.license_rules import Rule, rules

#: Phrases whose places are told, and their labels.
BASE = (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc"))
BASE_SCORE = 0.95


def _spelled(phrase: str) -> str:
    return "".join(f"<{w} " for w in phrase.split())


def _words_in(text: Column) -> Column:
    return F.char_length(text) - F.char_length(F.replace(text, F.lit("<"), F.lit("")))


def gate(docs: DataFrame, keywords: list[str]) -> DataFrame:
    """(doc_id, copy, n_words, told): ``told`` spells the words of texts with a keyword, else null."""
    listed = F.array(*map(F.lit, keywords))
    words = docs.select("doc_id", F.xxhash64("text").alias("copy"), lower_words(F.col("text")).alias("w"))
    told = F.concat(F.lit("<"), F.array_join("w", " <"), F.lit(" "))
    return words.select("doc_id", "copy", F.size("w").cast("long").alias("n_words"), F.when(F.arrays_overlap("w", listed), told).alias("told"))


def matches(gated: DataFrame, table_of: list[Rule]) -> DataFrame:
    """(doc_id, copy, number, label, priority, score, start, end) of every match; ends inside, in words."""
    spark = gated.sparkSession
    rows = spark.createDataFrame(
        [(r.number, r.label, r.priority, r.score, r.keyword, r.pattern) for r in table_of],
        "number int, label string, priority int, score double, keyword string, pattern string",
    )
    keys = F.array(*[F.lit(k) for k in sorted({r.keyword for r in table_of})])
    holding = gated.where("told is not null").select("doc_id", "copy", "told", F.explode(F.filter(keys, lambda k: F.contains(F.col("told"), F.concat(F.lit("<"), k, F.lit(" "))))).alias("keyword"))
    tried = holding.join(F.broadcast(rows), "keyword").where(F.rlike("told", F.col("pattern")))
    # the stretches between matches and the matches, in words, tell where each match starts
    cut = tried.select(
        "doc_id", "copy", "number", "label", "priority", "score",
        F.transform(F.split("told", F.col("pattern"), -1), _words_in).alias("between"),
        F.transform(F.regexp_extract_all("told", F.col("pattern"), F.lit(0)), _words_in).alias("n"),
    )
    at = cut.select("*", F.posexplode("n").alias("i", "length")).where("length > 0")
    # a running sum would be quadratic as slices: turn the arrays into rows and sum over these
    one = Window.partitionBy("doc_id", "copy", "number").orderBy("i").rowsBetween(Window.unboundedPreceding, -1)
    gap = Window.partitionBy("doc_id", "copy", "number").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    at = at.select("doc_id", "copy", "number", "label", "priority", "score", "i", "length", F.get("between", F.col("i")).alias("gap")).distinct()
    start = F.coalesce(F.sum("length").over(one), F.lit(0)) + F.sum("gap").over(gap)
    return at.withColumn("start", start).select("doc_id", "copy", "number", "label", "priority", "score", "start", (F.col("start") + F.col("length") - 1).alias("end"))


def unsuppressed(found: DataFrame, priorities: list[int]) -> DataFrame:
    """The matches that no other contains by the rules above."""
    order = Window.partitionBy("doc_id", "copy").orderBy("start", F.desc("end"), F.desc("priority"), "number").rowsBetween(Window.unboundedPreceding, -1)
    reach = [F.when(F.col("priority") == p, F.max(F.when(F.col("priority") >= p, F.col("end"))).over(order)) for p in priorities]
    return found.withColumn("_reach", F.coalesce(*reach, F.lit(-1))).where(F.col("_reach") < F.col("end")).drop("_reach")


def base_places(told: Column) -> dict[str, Column]:
    """Count, first and last place and labels of the base phrases in spelled words."""
    n = [F.regexp_count(told, F.lit(_spelled(p))) for p, _ in BASE]
    first = [_words_in(F.substring_index(told, _spelled(p), 1)) for p, _ in BASE]
    last = [
        _words_in(told) - _words_in(F.substring_index(told, _spelled(p), -1)) - len(p.split()) for p, _ in BASE
    ]
    hit = [F.coalesce(c, F.lit(0)) > 0 for c in n]
    return {
        "n_base": sum((F.coalesce(c, F.lit(0)) for c in n), F.lit(0)).cast("long"),
        "first_word": F.array_min(F.array_compact(F.array(*[F.when(h, c) for h, c in zip(hit, first, strict=True)]))).cast("long"),
        "last_word": F.array_max(F.array_compact(F.array(*[F.when(h, c) for h, c in zip(hit, last, strict=True)]))).cast("long"),
        "_base": F.array_compact(F.array(*[F.when(h, F.lit(label)) for h, (_, label) in zip(hit, BASE, strict=True)])),
    }


def scan(docs: DataFrame) -> DataFrame:
    """The result for every row of ``docs`` (doc_id, text); further columns: n_matches, those that stay."""
    table_of = rules()
    keywords = sorted({r.keyword for r in table_of} | {p.split()[-2] for p, _ in BASE} | {"cc"})
    gated = written(gate(docs, keywords), "license-words")
    kept = unsuppressed(matches(gated, table_of), sorted({r.priority for r in table_of}))
    named = kept.groupBy("doc_id", "copy").agg(
        F.collect_set("label").alias("_labels"), F.max("score").alias("_score"), F.count(F.lit(1)).alias("_n")
    )
    b = base_places(F.col("told"))
    rows = gated.select("doc_id", "copy", "n_words", *[c.alias(k) for k, c in b.items()])
    named = named.select(F.col("doc_id").alias("_id"), F.col("copy").alias("_copy"), "_labels", "_score", "_n")
    all_labels = F.array_union("_base", F.coalesce("_labels", F.array().cast("array<string>")))
    base_score = F.when(F.size("_base") > 0, F.lit(BASE_SCORE)).otherwise(F.lit(0.0))
    return rows.join(named, rows.doc_id.eqNullSafe(F.col("_id")) & (F.col("copy") == F.col("_copy")), "left").select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        F.array_join(F.array_sort("_base"), ",").alias("base_labels"),
        F.array_join(F.array_sort(all_labels), ",").alias("labels"),
        F.greatest(F.coalesce("_score", F.lit(0.0)), base_score).alias("score"),
        F.coalesce("_n", F.lit(0)).alias("n_matches"),
    )


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents").select("doc_id", "text"))


def oracle() -> str:
    """DuckDB SQL for the query: every match of every rule, and containment by comparing all in a document."""

    def quoted(s: str) -> str:
        return "'" + s.replace("'", "''") + "'"

    values = ",\n".join(
        f"({r.number}, {quoted(r.label)}, {r.priority}, {r.score}::DOUBLE, {quoted(r.keyword)}, {quoted(r.pattern)})" for r in rules()
    )
    phrases = ", ".join(f"({quoted(p)}, {quoted(label)})" for p, label in BASE)
    return rf"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
phrases(phrase, label) AS (VALUES {phrases}),
places AS (
  SELECT doc_id, label, i - 1 AS place FROM (
    SELECT doc_id, label, phrase, w, len(string_split(phrase, ' ')) AS k, unnest(range(1, len(w) + 1)) AS i FROM w, phrases)
  WHERE array_to_string(w[i:i + k - 1], ' ') = phrase),
base AS (
  SELECT doc_id, count(*) AS n_base, min(place) AS first_word, max(place) AS last_word,
         string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM places GROUP BY doc_id),
rules(number, label, priority, score, keyword, pattern) AS (VALUES {values}),
told AS (SELECT doc_id, '<' || array_to_string(w, ' <') || ' ' AS told FROM w WHERE len(w) > 0),
hits AS (
  SELECT doc_id, number, label, priority, score, regexp_extract_all(told, pattern) AS h, string_split_regex(told, pattern) AS g
  FROM told JOIN rules ON contains(told, '<' || keyword || ' ') WHERE regexp_matches(told, pattern)),
each AS (SELECT *, unnest(range(1, len(h) + 1)) AS i FROM hits),
found AS (
  SELECT doc_id, number, label, priority, score,
         len(string_split(array_to_string(g[1:i], '') || array_to_string(h[1:i - 1], ''), '<')) - 1 AS a,
         len(string_split(h[i], '<')) - 1 AS n FROM each),
kept AS (
  SELECT * FROM found f WHERE NOT EXISTS (
    SELECT 1 FROM found o WHERE o.doc_id = f.doc_id AND o.a <= f.a AND o.a + o.n >= f.a + f.n
      AND (o.priority > f.priority OR o.priority = f.priority AND (o.n > f.n OR o.n = f.n AND o.number < f.number)))),
named AS (
  SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM (
    SELECT doc_id, label FROM kept UNION ALL SELECT doc_id, label FROM places) GROUP BY doc_id),
best AS (SELECT doc_id, max(score) AS score, count(*) AS n_matches FROM kept GROUP BY doc_id)
SELECT w.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       greatest(coalesce(score, 0), CASE WHEN n_base > 0 THEN {BASE_SCORE}::DOUBLE ELSE 0 END) AS score, coalesce(n_matches, 0) AS n_matches
FROM w LEFT JOIN base USING (doc_id) LEFT JOIN named USING (doc_id) LEFT JOIN best USING (doc_id)
"""
