"""Benchmark decontamination by a distributed positional inverted index.

The training texts become postings ``(doc, term, position)``, written once to the shared
folder. A search takes the two rarest terms of every test window, shifts their postings by the
term's place in the item, so that all words of one occurrence fall on the same diagonal
``position - place``, and intersects the two lists. What both hold is intersected with the shifted
postings of the other terms. What stays are exact phrase matches, found without going back to any
text. ``near_matches``
answers from the same index where the words of a phrase stand close together in any order.

The index holds the postings of terms that occur in a test item. No other posting can be
part of a match. Everything is built from DataFrame functions.

Defined results: a null or wordless text has no words and no hits; items without words
match nothing; items of fewer words than a window are one window of their own length;
repeated documents each get their row; repeated items count once per id. Ties between
equally rare terms go to the earlier place.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hushmark.llm.common import broadcast_if_small, lower_words, small, table, unused, written

WINDOW = 10


@dataclass(frozen=True)
class PositionalIndex:
    """``postings`` (doc_id, copy, term_id, pos); ``docs`` (doc_id, copy, n_words), a row per document;
    ``terms`` (term, term_id). ``copy`` tells texts apart that share an id."""

    postings: DataFrame
    docs: DataFrame
    terms: DataFrame


def item_words(items: DataFrame) -> DataFrame:
    """(item, item_id, j, term, n) for every word of every test item."""
    words = items.select("item_id", lower_words(F.col("text")).alias("_w")).distinct()
    words = words.select(F.xxhash64(F.col("item_id").cast("string"), F.array_join("_w", " ")).alias("item"), "item_id", F.size("_w").alias("n"), "_w")
    return words.select("item", "item_id", "n", F.posexplode("_w").alias("j", "term"))


def build_index(docs: DataFrame, words: DataFrame) -> PositionalIndex:
    """Index ``docs`` (doc_id, text) for the terms in ``words`` (column ``term``).

    One pass over the texts: every word meets the term list, and the postings that stay are
    written. Each document also leaves one posting of the empty term, whose position is its
    number of words. Any text may be long: its words stream, they are never sorted or grouped.
    """
    terms = written(words.select("term").distinct().withColumn("term_id", F.monotonically_increasing_id()), "terms")
    end = words.sparkSession.createDataFrame([("", -1)], "term string, term_id long")
    listed = broadcast_if_small(terms.unionAll(end), "term")
    text = F.col("text")
    tokens = F.concat(lower_words(text), F.array(F.lit("")))
    spread = docs.select("doc_id", F.xxhash64(text).alias("copy"), F.posexplode(tokens).alias("pos", "term"))
    postings = written(spread.join(listed, "term").select("doc_id", "copy", "term_id", "pos"), "postings")
    ends = postings.where("term_id = -1").select("doc_id", "copy", F.col("pos").cast("long").alias("n_words"))
    return PositionalIndex(postings.where("term_id >= 0"), ends, terms)


def rarest_anchors(index: PositionalIndex, words: DataFrame, window: int) -> DataFrame:
    """Per item the pairs of places that are the two rarest of some window, with the stretch of those windows.

    (item, first, first_term, second, second_term, lo, hi): ``lo`` and ``hi`` are the first and last
    place of the windows that rely on the pair. A window of one word pairs with itself. The window over
    an item is bounded by the item's own words.
    """
    often = index.postings.groupBy("term_id").agg(F.count(F.lit(1)).alias("often"))
    known = words.join(index.terms, "term").join(often, "term_id", "left").na.fill(0, ["often"])
    ahead = Window.partitionBy("item").orderBy("j").rowsBetween(0, window - 1)
    ranked = F.array_sort(F.collect_list(F.struct("often", "j", "term_id")).over(ahead))
    picked = known.select("item", "n", "j", ranked.alias("r")).where(F.col("j") <= F.greatest(F.col("n") - window, F.lit(0)))
    second = F.coalesce(F.get("r", F.lit(1)), F.col("r")[0])
    picked = picked.select("item", "n", "j", F.col("r")[0].alias("a"), second.alias("b"))
    last = F.least(F.col("j") + window, F.col("n")) - 1
    return (
        picked.where("a.often > 0")
        .groupBy(
            "item", F.col("a.j").alias("first"), F.col("a.term_id").alias("first_term"),
            F.col("b.j").alias("second"), F.col("b.term_id").alias("second_term"),
        )
        .agg(F.min("j").alias("lo"), F.max(last).alias("hi"))
    )


def phrase_matches(index: PositionalIndex, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """Stretches of documents that equal a stretch of an item, a window long or longer.

    (doc_id, copy, item_id, start, end): both ends inside, in words of the document.
    """
    words = written(item_words(items).join(index.terms, "term"), "items")
    anchors = written(rarest_anchors(index, words.drop("term_id"), window), "anchors")
    # the postings of the two rarest terms, shifted to the place of the item's first word: a pair
    # stays where both lists have the same diagonal
    pair = ["item", "first", "second", "lo", "hi"]
    alone = F.col("first") == F.col("second")
    sides = anchors.select(
        *pair, F.col("first_term").alias("term_id"), F.col("first").alias("j"), F.when(alone, 3).otherwise(1).alias("side")
    ).unionAll(anchors.where(~alone).select(*pair, "second_term", "second", F.lit(2)))
    shifted = index.postings.join(broadcast_if_small(sides), "term_id").withColumn("diag", F.col("pos") - F.col("j"))
    met = shifted.groupBy("doc_id", "copy", "diag", *pair).agg(F.bit_or("side").alias("sides"))
    # (a document may begin within an item: the first windows of a pair may lie before it, later ones in it)
    found = met.where("sides = 3")
    # intersect with all other lists: what each diagonal would need, and the postings that meet it
    needs = written(
        found.join(broadcast_if_small(words.select("item", "item_id", "n", "j", "term_id")), "item")
        .where(F.col("j").between(F.col("lo"), F.col("hi")) & (F.col("diag") + F.col("j") >= 0))
        .select("doc_id", "copy", "item", "item_id", "n", "diag", "j", "term_id", (F.col("diag") + F.col("j")).alias("pos"))
        .distinct(),
        "needs",
    )
    near = needs.select("doc_id", "copy").distinct()
    postings = index.postings.join(broadcast_if_small(near), _same(index.postings, near), "left_semi")
    seen = needs.join(postings, _same(needs, postings) & (needs.pos == postings.pos) & (needs.term_id == postings.term_id), "left_semi")
    # runs of neighbouring places on one diagonal
    line = Window.partitionBy("doc_id", "copy", "item", "diag").orderBy("j")
    runs = (
        seen.withColumn("run", F.col("j") - F.row_number().over(line))
        .groupBy("doc_id", "copy", "item", "item_id", "n", "diag", "run")
        .agg(F.min("pos").alias("start"), F.max("pos").alias("end"))
    )
    return runs.where(F.col("end") - F.col("start") + 1 >= F.least(F.lit(window), F.col("n"))).select(
        "doc_id", "copy", "item_id", "start", "end"
    )


def near_matches(index: PositionalIndex, items: DataFrame, within: int) -> DataFrame:
    """Documents where all different words of an item stand inside ``within`` consecutive words, in any order.

    (doc_id, copy, item_id, start, end): one row for each posting that completes such a stretch, from
    the item's first posting in it. An item with a word that the corpus lacks matches nothing.
    Postings are followed only in documents that hold the item's rarest term.
    """
    words = written(item_words(items).join(index.terms, "term").select("item", "item_id", "term_id").distinct(), "near")
    often = index.postings.groupBy("term_id").agg(F.count(F.lit(1)).alias("often"))
    asked = item_words(items).groupBy("item").agg(F.count_distinct("term").alias("asked"))
    known = words.join(often, "term_id", "left").na.fill(0, ["often"])
    rare = known.groupBy("item").agg(F.min(F.struct("often", "term_id")).alias("a"))
    rare = rare.where("a.often > 0").select("item", F.col("a.term_id").alias("term_id"))
    cand = index.postings.join(broadcast_if_small(rare), "term_id").select("doc_id", "copy", "item").distinct()
    wanted = cand.join(broadcast_if_small(words), "item").join(broadcast_if_small(asked), "item")
    hits = wanted.join(
        index.postings,
        _same(wanted, index.postings) & (wanted.term_id == index.postings.term_id),
    ).select(wanted.doc_id, wanted["copy"], "item", "item_id", wanted.term_id, "asked", "pos")
    back = Window.partitionBy("doc_id", "copy", "item").orderBy("pos").rangeBetween(-(within - 1), 0)
    seen = hits.withColumn("kinds", F.size(F.collect_set("term_id").over(back))).withColumn("first", F.min("pos").over(back))
    return seen.where("kinds = asked").select("doc_id", "copy", "item_id", F.col("first").alias("start"), F.col("pos").alias("end"))


def _same(a: DataFrame, b: DataFrame):
    return a.doc_id.eqNullSafe(b.doc_id) & (a["copy"] == b["copy"])


def report(index: PositionalIndex, matches: DataFrame) -> DataFrame:
    """Per document: words, words inside any match, items matched, their digest, and the verdict."""
    by_start = Window.partitionBy("doc_id", "copy").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.max("end").over(by_start), F.lit(-1))
    fresh = F.greatest(F.lit(0), F.col("end") - F.greatest(F.col("start") - 1, before))
    found = matches.withColumn("fresh", fresh).groupBy("doc_id", "copy").agg(
        F.sum("fresh").alias("n_hit"), F.collect_set(F.col("item_id").cast("string")).alias("items")
    )
    items = F.coalesce(F.col("items"), F.array().cast("array<string>"))
    return index.docs.join(found, _same(index.docs, found), "left").select(
        index.docs.doc_id,
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort(items), ","), 256).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
        index.docs["copy"],
    )


def decontaminate(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """The report over ``docs`` (doc_id, text) for the test ``items`` (item_id, text)."""
    docs, items = docs.select("doc_id", "text"), items.select("item_id", "text")
    index = build_index(docs, item_words(items))
    return report(index, phrase_matches(index, items, window))


def keep_clean(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` without any match, all columns unchanged."""
    index = build_index(docs.select("doc_id", "text"), item_words(items))
    key, copy = unused(docs.columns, "_id", "_copy")
    found = written(phrase_matches(index, items, window).select(F.col("doc_id").alias(key), F.col("copy").alias(copy)).distinct(), "contaminated")
    same = docs["doc_id"].eqNullSafe(found[key]) & (F.xxhash64(docs["text"]) == found[copy])
    return docs.join(broadcast_if_small(found), same, "left_anti")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("copy")


ORACLE = r"""
WITH docw AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
itemw AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
spans AS (
  SELECT item_id, w, least(len(w), 10) AS k, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS s FROM itemw WHERE len(w) > 0),
win AS (SELECT DISTINCT item_id, k, array_to_string(w[s:s + k - 1], ' ') AS phrase FROM spans),
sizes AS (SELECT DISTINCT k FROM win),
place AS (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS s FROM docw, sizes WHERE len(w) >= k),
hit AS (
  SELECT place.doc_id, place.s, place.k, win.item_id
  FROM place JOIN win ON win.k = place.k AND win.phrase = array_to_string(place.w[place.s:place.s + place.k - 1], ' ')),
places AS (SELECT DISTINCT doc_id, unnest(range(s, s + k)) AS p FROM hit),
n AS (SELECT doc_id, count(*) AS n_hit FROM places GROUP BY doc_id),
i AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids FROM hit GROUP BY doc_id)
SELECT docw.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docw LEFT JOIN n USING (doc_id) LEFT JOIN i USING (doc_id)
"""
