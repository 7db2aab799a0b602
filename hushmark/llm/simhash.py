"""SimHash near-duplicates by anchor points of a covering code.

Fingerprints are 64 bits, each the majority over the hashes of a text's word shingles. Equal
fingerprints collapse first, by an aggregate that combines before the shuffle, so a group of
copies of any size goes on as one row.

Two fingerprints within two bits differ by at most one bit in one of their halves. In each
half, 31 bits are covered by the perfect Hamming code: every value lies within one bit (the
covering radius) of exactly one code word, its home anchor. Every fingerprint is replicated to
all anchors within radius plus threshold, two bits: 16 of the 2^26 anchors of a half (one if it
is a code word). A pair within one bit in that half meets at the home anchor of either.
Per anchor, those at home are compared with the replicas, once for each pair, on all 64 bits.

The links go into connected components (large-star / small-star), whose rounds are written
tables. A fingerprint has no more than 2,080 neighbours within two bits, so the links between
different fingerprints cannot grow with the square of a group of copies.

Defined results: a text with fewer words than a shingle is one shingle of what it has; one without
words has fingerprint zero, linked like any other; repeated rows are in one component; a
component whose ids are all null has a null id.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hushmark.llm.common import broadcast_if_small, per_batch, table, unused, written

SHINGLE = 3
SEED = 42


def fingerprint(text: str | None, size: int = SHINGLE) -> int:
    """The unsigned fingerprint of one text. Shingles are hashed 65,536 at a time."""
    import xxhash

    words = (text or "").encode().lower().split()  # bytes: only A-Z and the ASCII blanks
    if not words:
        return 0
    n = max(1, len(words) - size + 1)
    ones, digest = np.zeros(64, np.int64), xxhash.xxh64_intdigest
    for at in range(0, n, 1 << 16):
        some = words[at : min(n, at + (1 << 16)) + size - 1]
        shingles = map(b" ".join, zip(*(some[i:] for i in range(size)), strict=False)) if len(some) >= size else [b" ".join(some)]
        h = np.array([digest(s, SEED) for s in shingles], dtype=">u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprints(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """(doc_id, fp) with the fingerprint as a signed long, for docs (doc_id, text)."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(x: dict[str, list]) -> dict[str, list]:
        values = np.array([fingerprint(t, size) for t in x["text"]], dtype=np.uint64)
        return {"doc_id": x["doc_id"], "fp": values.view(np.int64).tolist()}

    return per_batch(docs.select("doc_id", "text"), run, f"doc_id {kind}, fp long")


def _parity(x: Column, mask: int) -> Column:
    return F.bit_count(x.bitwiseAND(F.lit(mask))) % 2


def _flips(syndrome: int) -> list[int]:
    """The patterns of at most two of 31 bits whose places (from 1; 0 for none) give this syndrome."""
    bit = lambda place: 1 << (place - 1) if place else 0
    if not syndrome:
        return [0]
    return [bit(i) | bit(i ^ syndrome) for i in range(32) if i < i ^ syndrome]


def _block(fp: Column, block: int) -> Column:
    """31 bits of the upper (0) or lower (1) half."""
    return F.shiftrightunsigned(fp, 33) if block == 0 else fp.bitwiseAND(F.lit((1 << 31) - 1))


def anchored(fps: DataFrame) -> DataFrame:
    """(anchor, home, fp): each fingerprint at every anchor within two bits, in both halves.

    ``home`` marks the anchor within the covering radius of one bit. Anchors are numbered so
    that those of the two halves differ.
    """
    table_of = F.array(*[F.array(*map(F.lit, map(int, _flips(s)))) for s in range(32)]).cast("array<array<bigint>>")
    parts = []
    for block in (0, 1):
        masks = [sum(1 << (place - 1) for place in range(1, 32) if place >> k & 1) for k in range(5)]
        bits = fps.select("fp", _block(F.col("fp"), block).alias("bits"))
        syndrome = sum((_parity(F.col("bits"), m) * (1 << k) for k, m in enumerate(masks)), F.lit(0))
        spread = bits.select("fp", "bits", F.explode(F.element_at(table_of, (syndrome + 1).cast("int"))).alias("flip"))
        parts.append(
            spread.select(
                (F.col("bits").bitwiseXOR(F.col("flip")) + F.lit(block << 32)).alias("anchor"),
                (F.bit_count("flip") <= 1).alias("home"),
                "fp",
            )
        )
    return parts[0].unionAll(parts[1])


def links(fps: DataFrame, most: int = 2) -> DataFrame:
    """(a, b), a < b: every pair of the different fingerprints ``fps`` (fp) within ``most`` bits, once."""
    if not 0 <= most <= 2:
        raise ValueError("the anchors cover at most two bits")
    spread = anchored(fps)
    # Spark sizes replicas as if they were the fingerprints, a thirtieth of what they hold, and would broadcast them
    home = spread.where("home").select("anchor", F.col("fp").alias("a")).hint("merge")
    near = spread.select("anchor", F.col("fp").alias("b"))
    differ = F.col("a").bitwiseXOR(F.col("b"))
    upper = F.bit_count(_block(F.col("a"), 0).bitwiseXOR(_block(F.col("b"), 0)))
    # what meets in the upper half isn't told again in the lower one
    once = (F.col("anchor") < F.lit(1 << 32)) & (upper <= 1) | (F.col("anchor") >= F.lit(1 << 32)) & (upper > 1)
    return home.join(near, "anchor").where((F.col("a") < F.col("b")) & (F.bit_count(differ) <= most) & once).select("a", "b")


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node of each connected component, for all nodes of ``edges`` (a, b).

    Alternates large-star and small-star until nothing changes. Neighbourhoods are only ever
    reduced to their minimum, an aggregate that combines before the shuffle, and joined back,
    so a node with very many links is split by skew handling like any other hot key.
    """
    now = written(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "links")
    before = None
    while (state := now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()) != before:
        before = state
        both = now.unionAll(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = written(large, "large-star")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        hung = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = written(hung.unionAll(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct(), "small-star")
    nodes = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return nodes.unionAll(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def near_duplicates(docs: DataFrame, size: int = SHINGLE, most: int = 2, marks: Callable[[DataFrame, int], DataFrame] = fingerprints) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of ``docs`` (doc_id, text).

    ``component_id`` is the smallest doc_id that links of at most ``most`` bits reach.
    """
    marked = written(marks(docs, size), "fingerprints")
    kinds = written(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "kinds")
    return named(marked, kinds, components(links(kinds.select("fp"), most))).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def named(marked: DataFrame, kinds: DataFrame, roots: DataFrame) -> DataFrame:
    """``marked`` (doc_id, fp) with its component_id: the least id of ``kinds`` (fp, least) below its root (node, root)."""
    linked = kinds.join(roots, kinds.fp == roots.node).select("fp", "least", "root")
    first = linked.groupBy("root").agg(F.min("least").alias("component_id"))
    moved = linked.join(first, "root").select("fp", "component_id")
    told = kinds.join(moved, "fp", "left").select("fp", F.coalesce("component_id", "least").alias("component_id"))
    # marked has a row for each document: small in a compressed file, but several times that in a broadcast
    return marked.hint("merge").join(told, "fp")


def keep_one(docs: DataFrame, find: Callable[[DataFrame], DataFrame] = near_duplicates) -> DataFrame:
    """One row of each component stays, that with the smallest id (of equal ids, the smallest text hash).

    All columns stay as they are. The rows that go are told by id and text hash, so null and repeated
    ids do no harm; of rows that are alike in both, one stays. ``find`` names the components.
    """
    keyed = docs.select(F.struct(F.col("doc_id").alias("id"), F.xxhash64("text").alias("copy")).alias("doc_id"), "text")
    found = written(find(keyed).select("doc_id", (F.col("doc_id") == F.col("component_id")).alias("first")), "components")
    states = found.groupBy("doc_id").agg(F.max("first").alias("first"), F.count(F.lit(1)).alias("n"))
    key, copy, first = unused(docs.columns, "_id", "_copy", "_first")
    odd = written(states.where("not first or n > 1").select(F.col("doc_id.id").alias(key), F.col("doc_id.copy").alias(copy), F.col("first").alias(first)), "not-single")
    same = docs["doc_id"].eqNullSafe(odd[key]) & (F.xxhash64(docs["text"]) == odd[copy])
    single = docs.join(broadcast_if_small(odd), same, "left_anti")
    again = docs.join(broadcast_if_small(odd.where(F.col(first))), same, "left_semi")
    once = again.withColumn(copy, F.xxhash64("text")).dropDuplicates(["doc_id", copy]).drop(copy)
    return single.unionAll(once.select(*docs.columns))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
