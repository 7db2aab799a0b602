"""Label distributions, domain checks and conflicts."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hushmark.functions import matches_labels
from hushmark.rules import labels as rules

Conditions = Mapping[str, Mapping[str, Iterable[str]]]


def present_dimensions(df: DataFrame, dimensions: Iterable[str]) -> list[str]:
    return [d for d in dimensions if d in df.columns]


def long_labels(df: DataFrame, dimensions: Sequence[str], *keep: str) -> DataFrame:
    """One row per record and dimension: the kept columns, ``dimension`` and ``label``."""
    return df.select(*keep, *dimensions).unpivot(
        list(keep), list(dimensions), "dimension", "label"
    )


def label_counts(df: DataFrame, dimensions: Sequence[str]) -> DataFrame:
    """Records per dimension and label, null labels included."""
    return (
        long_labels(df, dimensions)
        .groupBy("dimension", "label")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def distribution(
    df: DataFrame,
    dimensions: Sequence[str] = rules.LABEL_DIMENSIONS,
    all_records: bool = False,
) -> DataFrame:
    """Share of each label in its dimension.

    The base is the labelled records, or with ``all_records`` every record.  Shares
    are taken on the counts, so only one row per label reaches the window.
    """
    counts = label_counts(df, present_dimensions(df, dimensions))
    base = Window.partitionBy("dimension")
    if not all_records:
        counts = counts.where(F.col("label").isNotNull())
    shares = counts.withColumn("share", F.col("n") / F.sum("n").over(base))
    return shares.where(F.col("label").isNotNull())


def sorted_distribution(shares: DataFrame) -> DataFrame:
    return shares.orderBy("dimension", F.desc("share"), "label")


def domain_violations(
    df: DataFrame,
    *keep: str,
    taxonomy: Mapping[str, Iterable[str]] = rules.TAXONOMY,
) -> DataFrame:
    """Labels that their dimension does not allow.  A missing label is no violation."""
    dimensions = present_dimensions(df, taxonomy)
    allowed = F.lit(False)
    for dimension in dimensions:
        member = (F.col("dimension") == dimension) & F.col("label").isin(*taxonomy[dimension])
        allowed = allowed | member
    return long_labels(df, dimensions, *keep).where(F.col("label").isNotNull() & ~allowed)


def conflicts(
    df: DataFrame, *keep: str, conflict_rules: Conditions = rules.CONFLICT_RULES
) -> DataFrame:
    """One row per record and rule that it breaks; a record may break several."""
    usable = {
        code: condition
        for code, condition in conflict_rules.items()
        if all(column in df.columns for column in condition)
    }
    codes = F.array_compact(
        F.array(*[F.when(matches_labels(c), F.lit(code)) for code, c in usable.items()])
    )
    return df.select(*keep, F.explode(codes).alias("rule"))


def conflict_counts(
    df: DataFrame, conflict_rules: Conditions = rules.CONFLICT_RULES
) -> DataFrame:
    """Records per broken rule.  The ids are the rows of ``conflicts``: a list of them has no bound."""
    return (
        conflicts(df, conflict_rules=conflict_rules)
        .groupBy("rule")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def mixed_profiles(
    df: DataFrame, conversation: str = "conversation_id", profile: str = "profile_id"
) -> DataFrame:
    """Conversations that carry more than one profile."""
    return (
        df.groupBy(conversation)
        .agg(F.count_distinct(profile).alias("profiles"))
        .where(F.col("profiles") > 1)
    )
