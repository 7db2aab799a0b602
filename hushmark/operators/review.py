"""Which machine annotations a human should look at, and why."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hushmark.functions import (
    emoji_count,
    issue_type,
    matches_labels,
    question_marks,
    sentence_count,
)
from hushmark.operators.labels import distribution
from hushmark.plans.once import evaluate_once
from hushmark.rules import labels as label_rules
from hushmark.rules import review as rules

DIMENSIONS = label_rules.SESSION_DIMENSIONS


def _reason(hit: Column, code: str, detail: Column | None = None) -> Column:
    detail = F.lit(None) if detail is None else detail
    return F.when(
        F.coalesce(hit, F.lit(False)),
        F.struct(F.lit(code).alias("code"), detail.cast("double").alias("detail")),
    )


def flat_annotations(records: DataFrame) -> DataFrame:
    """Nested annotation records to columns; a missing text or response gets its default."""
    return records.select(
        "message_id",
        F.coalesce("original_text", F.lit(rules.MISSING_TEXT)).alias("text"),
        "annotations.*",
        F.coalesce("ideal_response.text", F.lit("")).alias("response"),
    )


def consistency_reasons(confidence: str = "confidence") -> list[Column]:
    """Label combinations that contradict each other."""
    found = [_reason(matches_labels(c), code) for code, c in rules.CONSISTENCY_RULES.items()]
    unsure = (F.col("primary_intent") == rules.TRANSACTIONAL_INTENT) & (
        F.coalesce(confidence, F.lit(1.0)) < rules.CONFIDENCE_TRANSACTIONAL
    )
    found.append(_reason(unsure, rules.LOW_CONFIDENCE_TRANSACTIONAL, F.col(confidence)))
    return found


def response_reasons(response: Column) -> list[Column]:
    """Length, emoji, wording and questions of a proposed response."""
    low = F.lower(response)
    sentences, emoji = sentence_count(response), emoji_count(response)
    found = [
        _reason(sentences > rules.MAX_SENTENCES, rules.RESPONSE_TOO_LONG, sentences),
        _reason(emoji > rules.MAX_EMOJI, rules.TOO_MANY_EMOJI, emoji),
    ]
    found += [
        _reason(F.regexp_like(low, F.lit(pattern)), code)
        for code, pattern in rules.WORDING_RULES.items()
    ]
    questions = question_marks(response)
    asks = F.endswith(response, F.lit("?")) & (questions > rules.MAX_QUESTIONS)
    found.append(_reason(asks, rules.TOO_MANY_QUESTIONS, questions))
    return found


def with_consistency(df: DataFrame) -> DataFrame:
    return df.withColumn("reasons", F.array_compact(F.array(*consistency_reasons())))


def with_response_quality(df: DataFrame, response: str = "response") -> DataFrame:
    text = F.coalesce(F.col(response), F.lit(""))
    return df.withColumn("reasons", F.array_compact(F.array(*response_reasons(text))))


def review(df: DataFrame, response: str = "response") -> DataFrame:
    """Add ``reasons`` (code, detail) in rule order and their number; all rows stay.

    A missing confidence counts as certain, a missing response as empty.
    """
    confidence = F.coalesce("confidence", F.lit(1.0))
    found = [
        _reason(confidence < rules.CONFIDENCE_REVIEW, rules.LOW_CONFIDENCE, confidence),
        *consistency_reasons(),
        *response_reasons(F.coalesce(F.col(response), F.lit(""))),
        _reason(F.col("safety_level").isin(*rules.RISKY_LEVELS), rules.SAFETY_REVIEW),
        _reason(F.col("primary_intent").isin(*rules.SENSITIVE_INTENTS), rules.SENSITIVE_INTENT),
    ]
    reasons = F.array_compact(F.array(*found)).alias("reasons")
    return evaluate_once(df, reasons).withColumn("n_reasons", F.array_size("reasons"))


def candidates(reviewed: DataFrame) -> DataFrame:
    return reviewed.where(F.col("n_reasons") > 0)


def ranked_candidates(
    reviewed: DataFrame, order: str = "message_id", settle: bool = True
) -> DataFrame:
    """Review candidates, most reasons first, then in input order.

    A global sort reads its input twice, once for a sample.  ``settle`` puts a shuffle
    before it, so that the second reading finds finished rows and the rules run once;
    leave it out when ``reviewed`` is a table already.
    """
    found = candidates(reviewed)
    if settle:
        found = found.repartition(order)
    return found.orderBy(F.desc("n_reasons"), order)


def top_candidates(
    reviewed: DataFrame, n: int = rules.TOP_CANDIDATES, order: str = "message_id"
) -> DataFrame:
    return candidates(reviewed).orderBy(F.desc("n_reasons"), order).limit(n)


def issue_histogram(reviewed: DataFrame) -> DataFrame:
    """Reasons per issue type over all candidates."""
    codes = candidates(reviewed).select(F.explode("reasons.code").alias("code"))
    return codes.groupBy(issue_type(F.col("code")).alias("issue")).agg(
        F.count(F.lit(1)).alias("n")
    )


def examples_by_issue(
    reviewed: DataFrame,
    top: int = rules.TOP_CANDIDATES,
    per_issue: int = rules.EXAMPLES_PER_ISSUE,
    order: str = "message_id",
) -> DataFrame:
    """The first few of the top candidates per issue type, one row per reason."""
    best = top_candidates(reviewed, top, order)
    rows = best.select("*", F.posexplode("reasons").alias("reason_no", "reason"))
    rows = rows.withColumn("issue", issue_type(F.col("reason.code")))
    first = Window.partitionBy("issue").orderBy(F.desc("n_reasons"), order, "reason_no")
    return rows.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= per_issue)


def review_rate(reviewed: DataFrame) -> DataFrame:
    """One row: all records, those to review, and their share (null when empty)."""
    to_review = F.count_if(F.col("n_reasons") > 0)
    everything = F.count(F.lit(1))
    return reviewed.agg(
        everything.alias("total"),
        to_review.alias("to_review"),
        F.when(everything > 0, to_review / everything).alias("rate"),
    )


def record_distribution(df: DataFrame) -> DataFrame:
    """Label shares over all records, labelled or not."""
    return distribution(df, DIMENSIONS, all_records=True)


def distribution_anomalies(df: DataFrame) -> DataFrame:
    """One row per anomaly test with its value, threshold and whether it fires."""
    total = F.count(F.lit(1))

    def share(condition: Column) -> Column:
        return F.when(total > 0, F.count_if(condition) / total)

    one_row = df.agg(
        share(F.col("primary_intent") == label_rules.OTHER_LABEL).alias("other"),
        F.count_distinct("primary_intent").cast("double").alias("intents"),
        share(F.col("safety_level") == label_rules.TAXONOMY["safety_level"][0]).alias("safe"),
    )
    other, intents, safe = F.col("other"), F.col("intents"), F.col("safe")
    tests = [
        ("other_share_high", other, label_rules.OTHER_SHARE_GATE, other > label_rules.OTHER_SHARE_GATE),
        (
            "few_intents", intents, float(label_rules.MIN_DISTINCT_INTENTS),
            intents < label_rules.MIN_DISTINCT_INTENTS,
        ),
        ("safe_share_high", safe, label_rules.SAFE_SHARE_ALERT, safe > label_rules.SAFE_SHARE_ALERT),
    ]
    return one_row.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(name).alias("anomaly"),
                        value.alias("value"),
                        F.lit(limit).alias("threshold"),
                        F.coalesce(fires, F.lit(False)).alias("fires"),
                    )
                    for name, value, limit, fires in tests
                ]
            )
        )
    )


def correction_records(
    reviewed: DataFrame, order: str = "message_id", settle: bool = True
) -> DataFrame:
    """Ranked candidates in the shape a person fills in; empty fields stay as nulls."""
    empty = F.lit(None).cast("string")
    return ranked_candidates(reviewed, order, settle).select(
        "message_id",
        F.coalesce("text", F.lit(rules.MISSING_TEXT)).alias("text"),
        F.struct(*DIMENSIONS, "confidence").alias("llm_annotations"),
        F.coalesce("response", F.lit("")).alias("llm_response"),
        F.col("reasons").alias("issues"),
        F.struct(*[empty.alias(c) for c in rules.CORRECTION_FIELDS]).alias("human_corrections"),
    )


def reason_codes(reasons: str = "reasons") -> Column:
    """The codes as one text, in rule order."""
    return F.array_join(F.col(f"{reasons}.code"), "|")

