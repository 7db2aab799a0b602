"""Hierarchical multi-length packing of tokenized documents into training sequences.

A document longer than the context is cut into full windows; what is left is one piece. Pieces
are routed to tiers by their length (256, 512, 1024, 2048 tokens). Tiers are packed from the
longest down: each piece of a tier (or as many alike as fit) opens a window, and the gap is filled
from its own and the shorter tiers, the longest piece that fits first.

Which pieces share a window depends on their lengths alone, so packing is planned on the counts
per length, at most one number for each length up to the context, whatever the corpus holds.
The plan gives every rank within a length its sequence and offset. Ranks come from counts per
task and length, so no length is ever gathered, and documents never leave the row they are in.
Sequences of one pattern are dealt out over the step groups, which therefore hold the same
mixture of tiers and nearly the same number of tokens.

The ids are made once, in place; only lengths and checksums are kept. Where whole pieces leave too
much padding (a corpus without short pieces to fill gaps with), the pieces are made anew, cut at the
tiers' lengths, and the better plan is taken.

Defined results: a null text is an empty one, a single end token; repeated rows are packed each;
ties go to the earlier task and row; runs of blanks may be of any length.
"""

from __future__ import annotations

import functools
import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hushmark.llm.common import ship, table, written
from hushmark.llm.token_counts import PATTERN, byte_letters

CONTEXT = 2048
TIERS = (256, 512, 1024, 2048)
END = 1
STEP = 256
FILLED = 0.97
#: The blanks of the pattern, and from how many on a run is cut out by hand once the pattern engine has given up.
BLANKS = re.compile(r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")
LONG_RUN = 100_000


@functools.lru_cache(maxsize=4)
def encoder(path: str):
    """An encoder over the vocabulary of a byte-level tokenizer file; equal ids, several times faster."""
    import tiktoken

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    letters = {ord(k): v for k, v in byte_letters().items()}
    special = {x["content"]: x["id"] for x in spec["added_tokens"]}
    ranks = {k.translate(letters).encode("latin-1"): v for k, v in spec["model"]["vocab"].items() if k not in special}
    return tiktoken.Encoding("vocabulary", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)


@functools.lru_cache(maxsize=4)
def _specials(path: str) -> re.Pattern:
    names = sorted(encoder(path).special_tokens_set, key=len, reverse=True)
    return re.compile(f"({'|'.join(map(re.escape, names))})" if names else r"(?!)")


def ids_of(text: str, path: str) -> np.ndarray:
    """The ids of a text. Where the pattern engine gives up, at runs of over a million blanks, those are cut out by hand.

    The pattern takes a run of blanks as one word, but for its last blank if more text follows.
    """
    made = encoder(path)
    try:
        return made.encode_to_numpy(text, allowed_special="all")
    except ValueError:
        parts = []
    for segment in _specials(path).split(text):
        at = 0
        for m in BLANKS.finditer(segment):
            end = m.end() if m.end() == len(segment) else m.end() - 1
            if end - m.start() >= LONG_RUN:
                parts.append(made.encode_to_numpy(segment[at : m.start()], allowed_special="all"))
                parts.append(np.array(made._encode_single_piece(segment[m.start() : end]), dtype=np.uint32))
                at = end
        parts.append(made.encode_to_numpy(segment[at:], allowed_special="all"))
    return np.concatenate(parts)


def cuts(n: int, tiers: tuple[int, ...], whole: bool) -> list[int]:
    """The lengths of the pieces of a document of ``n`` tokens.

    Full windows and one rest, or, if it needn't stay whole, the rest cut into the lengths of tiers.
    """
    context, found = max(tiers), []
    for size in (context,) if whole else sorted(tiers, reverse=True):
        found += [size] * (n // size)
        n %= size
    return found + [n] * bool(n)


def pieces(docs: DataFrame, path: str, tiers: tuple[int, ...] = TIERS, end: int = END, whole: bool = True) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, task, local) of every piece of every document.

    ``local`` numbers the pieces of one length in one task. Written once, so that both keep.
    """
    context = max(tiers)
    kind = docs.schema["doc_id"].dataType
    from pyspark.sql.pandas.types import to_arrow_type

    out = pa.schema(
        [("doc_id", to_arrow_type(kind)), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("task", pa.int32()), ("local", pa.int64())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, seen = TaskContext.get().partitionId(), np.zeros(context + 1, np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part, rows = batch.slice(at, 256), []
                for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    ids = np.append(ids_of(text or "", path), end).astype("<u4")
                    start = 0
                    for length in cuts(len(ids), tiers, whole):
                        piece = ids[start : start + length]
                        rows.append((doc_id, start, len(piece), zlib.crc32(piece.tobytes()), len(ids), task, int(seen[len(piece)])))
                        seen[length] += 1
                        start += length
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), out, strict=True)], schema=out)

    ship(docs.sparkSession)
    schema = f"doc_id {kind.simpleString()}, start long, length long, ids_crc32 long, doc_tokens long, task int, local long"
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def tier_of(length: int, tiers: tuple[int, ...] = TIERS) -> int:
    return next(t for t in sorted(tiers) if length <= t)


def plan(counts: dict[int, int], tiers: tuple[int, ...] = TIERS) -> list[tuple[int, int, int, int, int, int]]:
    """Rows (length, first rank, times, copies, first sequence, offset), from how often each length occurs.

    ``times`` sequences from the first one on each take ``copies`` pieces of that length, side by side
    from the offset. Each turn exhausts a length or fills a whole group of equal windows, so the number
    of rows depends on the number of lengths, not on the number of pieces.
    """
    context, left = max(tiers), {k: v for k, v in sorted(counts.items()) if v}
    used, rows, sequence = dict.fromkeys(left, 0), [], 0
    order = sorted(left)

    def fitting(gap: int) -> int | None:
        import bisect

        at = bisect.bisect_right(order, gap) - 1
        return order[at] if at >= 0 else None

    def take(length: int, n: int) -> int:
        first = used[length]
        used[length] += n
        left[length] -= n
        if not left[length]:
            order.remove(length)
        return first

    for tier in sorted(tiers, reverse=True):
        while order and tier_of(order[-1], tiers) == tier:
            length = order[-1]
            copies = min(context // length, left[length])
            n = left[length] // copies  # what doesn't make up another such window opens one in the next turn
            groups = [(n, copies * length, [(length, take(length, n * copies), copies, 0)])]  # windows, filled, (length, first rank, copies, offset)
            while groups:
                windows, filled, parts = groups.pop()
                best = fitting(context - filled)
                if best is None:
                    rows += [(size, first, windows, copies, sequence, offset) for size, first, copies, offset in parts]
                    sequence += windows
                    continue
                copies = min((context - filled) // best, max(1, left[best] // windows))
                served = min(windows, left[best] // copies)
                rest = windows - served
                if rest:  # the first of the group are served; the others look for a shorter piece
                    groups.append((rest, filled, [(size, first + served * k, k, offset) for size, first, k, offset in parts]))
                groups.append((served, filled + copies * best, [*parts, (best, take(best, served * copies), copies, filled)]))
    return rows


def counted(cut: DataFrame) -> tuple[DataFrame, dict[int, int]]:
    """Pieces per task and length as a table, and per length (one number a length at most) for the plan."""
    per_task = written(cut.groupBy("task", "length").agg(F.count(F.lit(1)).alias("n")), "lengths")
    return per_task, {r[0]: r[1] for r in per_task.groupBy("length").agg(F.sum("n")).collect()}


def filled(rows: list[tuple[int, int, int, int, int, int]], context: int) -> float:
    """The share of a plan's windows that holds tokens."""
    windows = max((row[4] + row[2] for row in rows), default=0)
    return sum(length * times * copies for length, _, times, copies, _, _ in rows) / (windows * context) if windows else 1.0


def pack(docs: DataFrame, path: str, tiers: tuple[int, ...] = TIERS, end: int = END, step: int = STEP) -> DataFrame:
    """Every piece of every row of ``docs`` (doc_id, text) with its place.

    (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, tier, step_group)
    """
    context = max(tiers)
    cut = written(pieces(docs, path, tiers, end), "pieces")
    per_task, counts = counted(cut)
    rows = plan(counts, tiers)
    if filled(rows, context) < FILLED:
        other = written(pieces(docs, path, tiers, end, whole=False), "pieces")
        other_tasks, counts = counted(other)
        if filled(again := plan(counts, tiers), context) > filled(rows, context):
            cut, per_task, rows = other, other_tasks, again
    planned = np.array(sorted(rows), dtype=np.int64).reshape(-1, 6)
    total = int((planned[:, 4] + planned[:, 2]).max()) if len(planned) else 0
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    base = per_task.select("task", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    ranked = cut.join(base, ["task", "length"]).withColumn("rank", F.col("base") + F.col("local")).drop("base", "task", "local")
    key = planned[:, 0] << 44 | planned[:, 1]  # sorted by length, then rank
    out_kind = docs.schema["doc_id"].dataType.simpleString()

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            _, first, _, copies, sequence, offset = planned[np.searchsorted(key, length << 44 | rank, side="right") - 1].T
            turn = rank - first
            columns = [batch.column(c) for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")]
            columns += [pa.array(sequence + turn // copies), pa.array(offset + turn % copies * length)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

    schema = f"doc_id {out_kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    tier = functools.reduce(lambda rest, t: F.when(F.col("length") <= t, t).otherwise(rest), sorted(tiers, reverse=True)[1:], F.lit(context))
    return (
        ranked.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "rank")
        .mapInArrow(place, schema)
        .withColumn("tier", tier)
        .withColumn("step_group", F.col("sequence_id") % F.lit(max(1, -(-total // step))))
    )


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
