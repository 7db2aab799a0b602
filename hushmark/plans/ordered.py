"""Order-dependent results over groups of any size.

``lead`` and ``row_number`` put a whole group into one task.  A conversation can hold
a large part of all rows, so the group is cut into chunks that follow the order (an
hour of the timeline, a thousand turns, a hash prefix).  The window runs per chunk,
and a table of one row per chunk links the chunks together.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hushmark.plans.ranged import ordered_rows

#: Pass as ``chunk`` to cut groups by range partitioning with boundary carry (``hushmark.plans.ranged``):
#: no chunk column needed, and null or equal order values are split across tasks too.
RANGED = object()


def _never_null(chunk: Column) -> Column:
    """A missing chunk comes last."""
    return F.coalesce(chunk.cast("bigint"), F.lit(2**62))


def chunk_by_position(position: str, size: int = 100_000) -> Column:
    """Chunks of a dense position such as a turn number."""
    return F.floor(F.col(position) / size)


def chunk_by_time(df: DataFrame, ts: str, seconds: int = 86_400) -> Column:
    """Chunks of a timeline.  Wide enough for most groups to fit into a few.

    A timestamp without zone is read field by field: turned into an instant it would
    not keep its order where clocks change.
    """
    if isinstance(df.schema[ts].dataType, T.TimestampNTZType):
        day = F.unix_date(F.to_date(ts)).cast("bigint")
        at = day * 86_400 + F.hour(ts) * 3_600 + F.minute(ts) * 60 + F.second(ts)
    else:
        at = F.unix_seconds(ts)
    return F.floor(at / seconds)


def chunk_by_hash(digest: Column, prefix: int = 4) -> Column:
    """Chunks of a hex digest order: ``16 ** prefix`` of them, evenly filled."""
    return F.conv(F.substring(digest, 1, prefix), 16, 10).cast("bigint")


def _along(keys: Sequence[str], order: Sequence[str]) -> WindowSpec:
    return Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_last() for c in order])


def number_rows(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], chunk: Column, name: str = "position"
) -> DataFrame:
    """0-based position of each row in its group, by ``order``.

    ``chunk`` must not decrease along ``order``; nulls come last.  Groups are defined by
    ``keys``; none means the whole table.
    """
    if chunk is RANGED:
        return ordered_rows(df, keys, order).withColumnRenamed("position", name)
    parts = [*keys, "_chunk"]
    cut = df.withColumn("_chunk", _never_null(chunk))
    slots = cut.withColumn(
        "_slot", F.row_number().over(_along(parts, order)) - 1
    )
    before = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = (
        cut.groupBy(*parts)
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(*parts, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    )
    return (
        slots.join(offsets, parts)
        .withColumn(name, (F.col("_slot") + F.col("_offset")).cast("bigint"))
        .drop("_chunk", "_slot", "_offset")
    )


def adjacent_pairs(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    carry: Sequence[str],
    chunk: Column | None,
) -> DataFrame:
    """Each row that has a follower, with ``next_<column>`` and its 0-based ``position``.

    ``chunk`` must not decrease along ``order``; nulls come last.  Rows with a null key
    have no group and drop out.  ``None`` is for groups of known small size, as after a
    length filter: one window, at about half the cost.
    """
    if chunk is None:
        return _adjacent_in_small_groups(df, keys, order, carry)
    if chunk is RANGED:
        marked = df.dropna(subset=list(keys)).withColumn("_more", F.lit(True))
        found = ordered_rows(marked, keys, order, [*carry, "_more"])
        return found.where(F.col("next__more").isNotNull()).select(*df.columns, "position", *[f"next_{c}" for c in carry])
    parts = [*keys, "_chunk"]
    cut = df.dropna(subset=list(keys)).withColumn("_chunk", _never_null(chunk))
    within = _along(parts, order)
    slot = F.row_number().over(within) - 1

    rows = cut.withColumns(
        {
            "_slot": slot,
            "_more": F.lead(F.lit(True)).over(within),
            **{f"_lead_{c}": F.lead(c).over(within) for c in carry},
        }
    )
    # The heads come from the same shuffled rows: same columns, so the exchange is reused.
    heads = (
        cut.withColumns(
            {"_slot": slot, "_n": F.count(F.lit(1)).over(Window.partitionBy(*parts))}
        )
        .where(F.col("_slot") == 0)
        .select(*parts, "_n", *[F.col(c).alias(f"_head_{c}") for c in carry])
    )
    along = Window.partitionBy(*keys).orderBy("_chunk")
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    links = heads.select(
        *parts,
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"),
        F.lead(F.lit(True)).over(along).alias("_linked"),
        *[F.lead(f"_head_{c}").over(along).alias(f"_head_{c}") for c in carry],
    )
    more, linked = F.col("_more").isNotNull(), F.col("_linked").isNotNull()
    return (
        rows.join(links, parts)
        .where(more | linked)
        .select(
            *df.columns,
            (F.col("_slot") + F.col("_offset")).cast("bigint").alias("position"),
            *[
                F.when(more, F.col(f"_lead_{c}")).otherwise(F.col(f"_head_{c}")).alias(f"next_{c}")
                for c in carry
            ],
        )
    )


def _adjacent_in_small_groups(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], carry: Sequence[str]
) -> DataFrame:
    within = _along(keys, order)
    rows = df.dropna(subset=list(keys)).withColumns(
        {
            "position": (F.row_number().over(within) - 1).cast("bigint"),
            "_more": F.lead(F.lit(True)).over(within),
            **{f"next_{c}": F.lead(c).over(within) for c in carry},
        }
    )
    return rows.where(F.col("_more").isNotNull()).drop("_more")


def trailing_count(
    df: DataFrame, keys: Sequence[str], seconds_col: str, span: int, name: str = "recent"
) -> DataFrame:
    """Rows of the group in the ``span`` seconds up to and including each row.

    The timeline is cut into buckets of one span; a row is also copied into the next
    bucket, where it can only be looked back at.  A look-back never reaches further,
    so the count is exact and no task sees more than two spans of a group.  A row without
    a time has nothing to look back from: it stays, with a null count.
    """
    bucket = F.floor(F.col(seconds_col) / span)
    timeless = df.where(F.col(seconds_col).isNull()).withColumn(name, F.lit(None).cast("bigint"))
    copies = df.where(F.col(seconds_col).isNotNull()).withColumn("_own", bucket).withColumn(
        "_bucket", F.explode(F.array(F.col("_own"), F.col("_own") + 1))
    )
    recent = Window.partitionBy(*keys, "_bucket").orderBy(seconds_col).rangeBetween(-span, 0)
    return (
        copies.withColumn(name, F.count(F.lit(1)).over(recent))
        .where(F.col("_own") == F.col("_bucket"))
        .drop("_own", "_bucket")
        .unionByName(timeless)
    )
