"""Quality gates over a tally of reviewed records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hushmark.rules import labels as rules

SAFE, _, _, LEVEL3 = rules.TAXONOMY["safety_level"]


def _gate(name: str, value: Column, threshold: float, ok: Column) -> Column:
    return F.struct(
        F.lit(name).alias("gate"),
        value.cast("double").alias("value"),
        F.lit(float(threshold)).alias("threshold"),
        F.coalesce(ok, F.lit(False)).alias("ok"),
    )


def tally_gates(counts: DataFrame) -> DataFrame:
    """OTHER share, risk share, level-3 examples and review rate, from ``reports.tally``."""

    def n(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0))

    def at(section: str, item: str) -> Column:
        return (F.col("section") == section) & (F.col("item") == item)

    risky = (F.col("section") == "safety_level") & (F.col("item") != SAFE)
    one_row = counts.agg(
        n(at("summary", "total")).alias("total"),
        n(at("summary", "to_review")).alias("review"),
        n(at("primary_intent", rules.OTHER_LABEL)).alias("other"),
        n(risky).alias("risk"),
        n(at("safety_level", LEVEL3)).alias("level3"),
    )

    def share(column: str) -> Column:
        return F.when(F.col("total") > 0, F.col(column) / F.col("total"))

    other, risk, rate, level3 = share("other"), share("risk"), share("review"), F.col("level3")
    return one_row.select(
        F.inline(
            F.array(
                _gate("other_share", other, rules.OTHER_SHARE_GATE, other < rules.OTHER_SHARE_GATE),
                _gate("risk_share", risk, rules.RISK_SHARE_GATE, risk >= rules.RISK_SHARE_GATE),
                _gate(
                    "level3_examples", level3, rules.MIN_LEVEL3_EXAMPLES,
                    level3 >= rules.MIN_LEVEL3_EXAMPLES,
                ),
                _gate("review_rate", rate, rules.REVIEW_RATE_GATE, rate < rules.REVIEW_RATE_GATE),
            )
        )
    )


def balance_gates(counts: DataFrame, dimensions: Sequence[str] = rules.SESSION_DIMENSIONS) -> DataFrame:
    """Largest label share per dimension, from rows ``(section, item, n)``."""
    known = counts.where(F.col("section").isin(*dimensions) & F.col("item").isNotNull())
    largest = known.groupBy("section").agg((F.max("n") / F.sum("n")).alias("value"))
    return largest.select(
        F.concat(F.lit("largest_share_"), "section").alias("gate"),
        "value",
        F.lit(rules.LARGEST_SHARE_GATE).alias("threshold"),
        (F.col("value") <= rules.LARGEST_SHARE_GATE).alias("ok"),
    )


def agreement_gate(agreement: DataFrame) -> DataFrame:
    """``agreement`` as ``agreement.session_agreement`` gives it; no data fails."""
    value = F.max(F.when(F.col("dimension") == "overall", F.col("score")))
    return agreement.agg(value.alias("score")).select(
        F.inline(
            F.array(
                _gate(
                    "calibration_agreement", F.col("score"), rules.AGREEMENT_GATE,
                    F.col("score") >= rules.AGREEMENT_GATE,
                )
            )
        )
    )


def quality_gates(counts: DataFrame, agreement: DataFrame) -> DataFrame:
    """All gates as rows: one pass over the reviewed records (``reports.tally``), one over the sessions."""
    return (
        tally_gates(counts)
        .unionByName(balance_gates(counts))
        .unionByName(agreement_gate(agreement))
    )
