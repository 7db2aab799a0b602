"""Positions and followers in ordered groups by range partitioning with boundary carry.

``row_number`` and ``lead`` over ``Window.partitionBy(keys)`` put a whole group into one task; a
conversation with most of the rows, or a user whose events share one timestamp, is then one task.
Here the rows are range-partitioned on (keys, order, tiebreak) instead, where the tiebreak is a row id
taken before the shuffle: equal and null order values (nulls come last) are cut across tasks too.

One pass per partition, in sorted order, numbers each row inside its group from the partition's
start and takes the follower inside the partition. Only the first group of a partition can have begun
before it, and only the last row can have its follower after it: the first and last row of every
partition (two rows per partition, a bound set by the partition count, not the data) go to the
driver, which hands counts and heads on from partition to partition, and a broadcast of one row per
partition corrects those rows. One shuffle of the rows; no group is gathered anywhere.

Among equal order values the row id decides, so the order of ties is fixed by the input's layout.
Rows with null keys form one group of their own.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, IntegerType, LongType, StructField, StructType


def _same(a: pd.DataFrame, b: pd.DataFrame) -> np.ndarray:
    """Row by row: whether all columns are equal, nulls equal to nulls."""
    same = np.ones(len(a), bool)
    for c in a.columns:
        x, y = a[c], b[c]
        same &= ((x == y).fillna(False).astype(bool) | (x.isna() & y.isna())).to_numpy()
    return same


def _emit(pdf: pd.DataFrame) -> Iterator[pa.RecordBatch]:
    yield from pa.Table.from_pandas(pdf, preserve_index=False).combine_chunks().to_batches()


def _local(keys: Sequence[str], carry: Sequence[str]):
    """Per partition, in sorted order: position counted from the partition's start, follower inside it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, last_key, run_at, in_first, first_batch = None, None, 0, True, True
        for batch in batches:
            n = batch.num_rows
            if n == 0:
                continue
            pdf = batch.to_pandas(types_mapper=pd.ArrowDtype).reset_index(drop=True)
            k = pdf[list(keys)]
            before = k.shift(1)
            if last_key is not None:
                before = pd.concat([last_key, k.iloc[:-1]], ignore_index=True)
            same = _same(k, before)
            if first_batch:
                same[0] = False
            group = np.cumsum(~same)
            idx = np.arange(n)
            starts = np.maximum.accumulate(np.where(~same, idx, -1))
            pos = np.where(group == 0, run_at + idx, idx - starts)
            first_group = ((group == 0) & in_first) | ((group == 1) & first_batch)
            follows = np.append(same[1:], False)
            pdf["_pos"] = pos.astype(np.int64)
            pdf["_first_group"] = first_group
            pdf["_has_next"] = follows
            for c in carry:
                pdf[f"_next_{c}"] = pdf[c].shift(-1).where(follows)
            pdf["_is_first"] = (idx == 0) & first_batch
            pdf["_is_last"] = False
            if held is not None:
                if same[0]:
                    held.loc[len(held) - 1, "_has_next"] = True
                    for c in carry:
                        held.loc[len(held) - 1, f"_next_{c}"] = pdf.loc[0, c]
                yield from _emit(held)
            held, first_batch = pdf, False
            last_key = k.iloc[[n - 1]].reset_index(drop=True)
            run_at, in_first = int(pos[-1]) + 1, bool(first_group[-1])
        if held is not None:
            held.loc[len(held) - 1, "_is_last"] = True
            yield from _emit(held)

    return run


def _checkpoints(spark) -> None:
    """Checkpoints go where the session names (``spark.checkpoint.dir``); only a local session may go without."""
    context = spark.sparkContext
    if context.getCheckpointDir():
        return
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        context.setCheckpointDir(named)
    elif context.master.startswith("local"):
        context.setCheckpointDir(tempfile.mkdtemp(prefix="hushmark-checkpoints-"))
    else:
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")


def ordered_rows(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], carry: Sequence[str] = (), partitions: int | None = None
) -> DataFrame:
    """``df`` with ``position`` (0-based in its group by ``order``) and ``next_<c>`` of the follower (null for the last)."""
    spark = df.sparkSession
    _checkpoints(spark)
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    sort = [*[F.col(k).asc_nulls_last() for k in keys], *[F.col(o).asc_nulls_last() for o in order], F.col("_tie")]
    cut = df.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(n, *sort).sortWithinPartitions(*sort)
    cut = cut.withColumn("_pid", F.spark_partition_id())
    fields = [*cut.schema.fields, StructField("_pos", LongType()), StructField("_first_group", BooleanType()), StructField("_has_next", BooleanType())]
    fields += [StructField(f"_next_{c}", cut.schema[c].dataType) for c in carry]
    fields += [StructField("_is_first", BooleanType()), StructField("_is_last", BooleanType())]
    # written once: the ends below and the rows are read from the same checkpoint (spark.checkpoint.dir)
    local = cut.mapInArrow(_local(keys, carry), StructType(fields)).checkpoint(eager=True)
    # two rows per partition: bounded by the partition count
    ends = local.where("_is_first or _is_last").select("_pid", "_is_first", "_is_last", "_pos", "_first_group", *keys, *carry).collect()
    schema = StructType(
        [StructField("_pid", IntegerType()), StructField("_offset", LongType()), StructField("_tail_next", BooleanType())]
        + [StructField(f"_tail_{c}", local.schema[c].dataType) for c in carry]
    )
    fixes = spark.createDataFrame(_carried(ends, keys, carry), schema)
    joined = local.join(F.broadcast(fixes), "_pid", "left")
    position = F.col("_pos") + F.when(F.col("_first_group"), F.coalesce(F.col("_offset"), F.lit(0))).otherwise(0)
    tail = F.col("_is_last") & F.coalesce(F.col("_tail_next"), F.lit(False))
    nexts = [F.when(F.col("_has_next"), F.col(f"_next_{c}")).when(tail, F.col(f"_tail_{c}")).alias(f"next_{c}") for c in carry]
    return joined.select(*df.columns, position.cast("bigint").alias("position"), *nexts)


def _carried(ends, keys: Sequence[str], carry: Sequence[str]) -> list[tuple]:
    """Per partition: the offset of its first group and the follower of its last row, handed on in order."""
    parts: dict[int, dict] = {}
    for r in ends:
        p = parts.setdefault(r["_pid"], {})
        if r["_is_first"]:
            p["first"] = r
        if r["_is_last"]:
            p["last"] = r
    out, prev_key, prev_end = [], None, -1
    order = sorted(parts)
    for i, pid in enumerate(order):
        first, last = parts[pid]["first"], parts[pid]["last"]
        key = tuple(first[k] for k in keys)
        offset = prev_end + 1 if prev_key is not None and key == prev_key else 0
        prev_end = last["_pos"] + (offset if last["_first_group"] else 0)
        prev_key = tuple(last[k] for k in keys)
        following = parts[order[i + 1]]["first"] if i + 1 < len(order) else None
        linked = following is not None and tuple(following[k] for k in keys) == prev_key
        out.append((pid, offset, linked, *[following[c] if linked else None for c in carry]))
    return out
