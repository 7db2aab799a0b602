"""Near copies by the exact Jaccard similarity of word shingles, without comparing all with all.

A text is the set of its ``SHINGLE``-word shingles. Texts of equal sets collapse first, by an aggregate
that combines before the shuffle. Two sets of similarity ``SIMILAR`` or more share one of their first
shingles, in whatever order all shingles stand (the prefix filter): of n shingles the first
``n - ceil(SIMILAR * n) + 1`` are enough, about a fifth. So only those are dealt out, and no similar pair is
missed. Shingles that many documents of a sample share stand last, the others by their hash;
the sample decides how much is compared, never what is found.

Texts that share such a shingle are compared on their whole sets, once a pair, unless length or place
already tell that too little is left to share. Where many share one (a group of near copies), pivots come first:
one text is compared with all that share the shingle, and what is linked by then needs no comparison among
itself. So a group of alike texts takes work in line with its size.

Defined results: a text with fewer words than a shingle is one shingle of what it has; texts without words
are alike; links go on from text to text, as connected components.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hushmark.llm.common import broadcast_if_small, per_batch, ship, written
from hushmark.llm.simhash import SEED, components, named

SHINGLE = 5
#: The least similarity as a fraction, so that no rounding decides.
SIMILAR = (4, 5)
#: Documents looked at for common shingles; how many of them must hold one; how many such shingles are kept.
SAMPLE, COMMON, MOST_COMMON = 20_000, 5, 200_000
#: Rounds of pivots at most, and the comparisons for each posting from which on they are made.
ROUNDS, PER_POSTING = 6, 4


def shingles(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """The sorted hashes of a text's different shingles, as signed longs."""
    import xxhash

    words = (text or "").encode().lower().split()  # bytes: only A-Z and the ASCII blanks
    if not words:
        return np.zeros(0, np.int64)
    digest = xxhash.xxh64_intdigest
    grams = map(b" ".join, zip(*(words[i:] for i in range(size)), strict=False)) if len(words) >= size else [b" ".join(words)]
    return np.unique(np.fromiter((digest(g, SEED) for g in grams), np.uint64).view(np.int64))


def digest_of(found: np.ndarray) -> int:
    """One signed long for a whole set."""
    import xxhash

    return int(np.uint64(xxhash.xxh64_intdigest(found.tobytes(), SEED)).view(np.int64))


def prefix(found: np.ndarray, common: np.ndarray, similar: tuple[int, int] = SIMILAR) -> np.ndarray:
    """The first shingles of a set, of which two similar sets share one. Common shingles stand last."""
    n = len(found)
    if len(common) and n:
        last = common[np.minimum(np.searchsorted(common, found), len(common) - 1)] == found
        found = np.concatenate([found[~last], found[last]])
    return found[: n + similar[0] * n // -similar[1] + 1] if n else found


def common_shingles(docs: DataFrame, size: int = SHINGLE) -> np.ndarray:
    """Shingles that several documents of a sample hold, sorted."""
    total, wide = docs.count(), 1 << 30
    share = int(min(1.0, SAMPLE / max(1, total)) * wide)
    drawn = docs.where(F.pmod(F.shiftright(F.xxhash64(F.lit("near"), "text"), 20), F.lit(wide)) < share).select("text").distinct()

    def run(x: dict[str, list]) -> dict[str, list]:
        return {"found": [shingles(t, size) for t in x["text"]]}

    spread = per_batch(drawn, run, "found array<long>").select(F.explode("found").alias("s"))
    often = spread.groupBy("s").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= COMMON)
    return np.sort(np.array([r[0] for r in often.orderBy(F.desc("n"), "s").limit(MOST_COMMON).collect()], dtype=np.int64))


def postings(docs: DataFrame, common: np.ndarray, size: int = SHINGLE, similar: tuple[int, int] = SIMILAR) -> DataFrame:
    """(s, node, n, i): the prefix shingles of each text, its set's digest and size, and the place in order."""
    ship(docs.sparkSession)
    out = pa.schema([("s", pa.int64()), ("node", pa.int64()), ("n", pa.int32()), ("i", pa.int32())])

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                parts = []
                for text in batch.column(0).slice(at, 64).to_pylist():
                    found = shingles(text, size)
                    first = prefix(found, common, similar)
                    parts.append((first, np.full(len(first), digest_of(found)), np.full(len(first), len(found), np.int32), np.arange(len(first), dtype=np.int32)))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*parts, strict=True)], schema=out)

    return docs.select("text").mapInArrow(run, "s long, node long, n int, i int")


def _may_be_similar(n: Column, i: Column, m: Column, j: Column, similar: tuple[int, int]) -> Column:
    """Whether what is left of both sets, from the first shingle they share, can be enough."""
    num, den = similar
    left = F.least(n - i, m - j).cast("long")
    return left * (num + den) >= (n.cast("long") + m) * num


def verified(pairs: DataFrame, sets: DataFrame, similar: tuple[int, int] = SIMILAR) -> DataFrame:
    """The ``pairs`` (a, b) of similar sets; ``sets`` (node, found)."""
    num, den = similar
    both = pairs.join(sets.select(F.col("node").alias("a"), F.col("found").alias("x")), "a").join(sets.select(F.col("node").alias("b"), F.col("found").alias("y")), "b")
    shared = F.size(F.array_intersect("x", "y")).cast("long")
    return both.where(shared * (num + den) >= (F.size("x") + F.size("y")).cast("long") * num).select("a", "b")


def links(docs: DataFrame, kinds: DataFrame, size: int = SHINGLE, similar: tuple[int, int] = SIMILAR) -> DataFrame:
    """(a, b): pairs of set digests that connect all similar sets of the texts ``docs`` (text).

    ``kinds`` (node, copy) has the hash of one text for each set.
    """
    found = written(postings(docs, common_shingles(docs, size), size, similar), "prefixes")
    shared = found.groupBy("s").agg(F.min("node").alias("a"), F.max("node").alias("b")).where("a <> b").select("s")
    shared = written(shared, "shared-prefixes")
    live = written(found.join(broadcast_if_small(shared), "s", "left_semi").distinct(), "live")

    def run(x: dict[str, list]) -> dict[str, list]:
        sets = [shingles(t, size) for t in x["text"]]
        return {"node": [digest_of(s) for s in sets], "found": sets}

    def compared(pairs: DataFrame, name: str) -> DataFrame:
        """The similar ones of ``pairs``; the sets of the texts in them are made again."""
        pairs = written(pairs.distinct(), f"{name}-pairs")
        wanted = pairs.select(F.col("a").alias("node")).unionAll(pairs.select(F.col("b").alias("node"))).distinct()
        wanted = written(kinds.join(broadcast_if_small(wanted), "node", "left_semi").select("copy"), f"{name}-texts")
        texts = docs.select("text").join(broadcast_if_small(wanted), F.xxhash64("text") == F.col("copy"), "left_semi").distinct()
        sets = per_batch(texts, run, "node long, found array<long>").dropDuplicates(["node"])
        return written(verified(pairs, written(sets, f"{name}-sets"), similar), f"{name}-links")

    ends = lambda: (F.least("node", "node2").alias("a"), F.greatest("node", "node2").alias("b"))
    fits = _may_be_similar(F.col("n"), F.col("i"), F.col("n2"), F.col("j"), similar)
    edges, named_live = None, live.withColumn("label", F.col("node"))
    for turn in range(ROUNDS + 1):
        # in each group the label that most hold: what is left to compare has another one on a side
        held = named_live.groupBy("s", "label").agg(F.count(F.lit(1)).alias("k"))
        main = held.groupBy("s").agg(F.max_by("label", F.struct("k", "label")).alias("main"), F.max("k").alias("most"), F.sum("k").alias("of")).where("of > most")
        main = written(main, "groups")
        cost, n_live = main.agg(F.sum((F.col("of") - F.col("most")) * F.col("of"))).first()[0], live.count()
        if not cost:
            return edges if edges is not None else live.select(F.col("node").alias("a"), F.col("node").alias("b")).limit(0)
        side = named_live.join(broadcast_if_small(main.select("s", "main")), "s")
        odd = side.where("label <> main")
        if cost <= PER_POSTING * n_live or turn == ROUNDS:
            break
        pick = F.min_by(F.struct("node", "n", "i", "label"), F.struct(F.xxhash64("node", F.lit(turn)), "node"))
        pivot = (side if not turn else odd).groupBy("s").agg(pick.alias("p"))
        pivot = pivot.select("s", F.col("p.node").alias("node2"), F.col("p.n").alias("n2"), F.col("p.i").alias("j"), F.col("p.label").alias("label2"))
        more = compared(side.join(broadcast_if_small(pivot), "s").where((F.col("label") != F.col("label2")) & fits).select(*ends()), "pivot")
        edges = more if edges is None else edges.unionAll(more)
        roots = written(components(edges), "roots").withColumnRenamed("root", "label")
        named_live = written(live.join(broadcast_if_small(roots), "node", "left").select("s", "node", "n", "i", F.coalesce("label", "node").alias("label")), "labelled")
    other = side.select("s", F.col("node").alias("node2"), F.col("n").alias("n2"), F.col("i").alias("j"), F.col("label").alias("label2"))
    more = compared(odd.join(other, "s").where((F.col("label") != F.col("label2")) & fits).select(*ends()), "rest")
    return more if edges is None else edges.unionAll(more)


def near_duplicates(docs: DataFrame, size: int = SHINGLE, similar: tuple[int, int] = SIMILAR) -> DataFrame:
    """(doc_id, fp, component_id) for every row of ``docs`` (doc_id, text); ``fp`` is the digest of the set.

    ``component_id`` is the smallest doc_id that links of similar texts reach.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(x: dict[str, list]) -> dict[str, list]:
        return {"doc_id": x["doc_id"], "copy": x["copy"], "fp": [digest_of(shingles(t, size)) for t in x["text"]]}

    copied = docs.select("doc_id", "text", F.xxhash64("text").alias("copy"))
    marked = written(per_batch(copied, run, f"doc_id {kind}, copy long, fp long"), "sets")
    kinds = written(marked.groupBy("fp").agg(F.min("doc_id").alias("least"), F.min("copy").alias("copy")), "kinds")
    roots = components(links(docs, kinds.select(F.col("fp").alias("node"), "copy"), size, similar))
    return named(marked.drop("copy"), kinds.select("fp", "least"), roots).select("doc_id", "fp", "component_id")
