"""Reports as rows ``(section, item, value, text)``: one shape for every sink."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hushmark.functions import bar, issue_type, percent
from hushmark.operators import agreement, labels, review, transitions
from hushmark.rules import labels as label_rules


def _entry(section: Column, item: Column, value: Column, text: Column | None = None) -> Column:
    note = F.lit(None) if text is None else text
    return F.struct(
        section.cast("string").alias("section"),
        item.cast("string").alias("item"),
        value.cast("double").alias("value"),
        note.cast("string").alias("text"),
    )


def _rows(
    df: DataFrame, section: Column | str, item: Column | str, value: Column | str,
    text: Column | str | None = None,
) -> DataFrame:
    def column(x: Column | str) -> Column:
        return F.col(x) if isinstance(x, str) else x

    note = None if text is None else column(text)
    row = _entry(column(section), column(item), column(value), note)
    return df.select(row.alias("_row")).select("_row.*")


def label_report(
    df: DataFrame, group: str, order: Sequence[str], chunk: Column | None, first: int = 5
) -> DataFrame:
    """Distributions, conflict counts, and where stages exist the invalid transitions."""
    shares = labels.distribution(df)
    report = _rows(
        shares, F.concat(F.lit("distribution:"), "dimension"), "label", "share",
        percent(F.col("share")),
    ).unionByName(_rows(labels.conflict_counts(df), F.lit("conflicts"), "rule", "n"))
    if "rapport_stage" in df.columns and group in df.columns:
        invalid = transitions.invalid_transitions(df, group, "rapport_stage", order, chunk)
        total = invalid.agg(F.count(F.lit(1)).alias("n"))
        shown = transitions.first_transitions(invalid, group, first)
        report = report.unionByName(
            _rows(total, F.lit("transitions"), F.lit("invalid"), "n")
        ).unionByName(
            _rows(
                shown, F.lit("transition_examples"), F.concat_ws(":", F.col(group), "position"),
                F.lit(None), "transition",
            )
        )
    return report


def calibration_report(
    records: DataFrame, first: str, second: str, control: DataFrame | None = None, shown: int = 5
) -> DataFrame:
    """Messages evaluated, scores, verdict, and a few disagreements."""
    scores = agreement.gate_scores(agreement.session_agreement(records, first, second))
    evaluated = records.where(F.col("session") == first).agg(
        F.count_distinct("message_id").alias("n")
    )
    mark = F.when(F.col("approved"), "pass").otherwise("fail")
    verdict = F.when(F.col("approved"), "approved").otherwise("needs_refinement")
    overall = F.col("dimension") == "overall"
    score_rows = scores.select(
        F.inline(
            F.array_compact(
                F.array(
                    _entry(F.lit("agreement"), F.col("dimension"), F.col("score"), mark),
                    F.when(
                        overall,
                        _entry(F.lit("summary"), F.lit("verdict"), F.col("score"), verdict),
                    ),
                )
            )
        )
    )
    cases = agreement.disagreements(records, first, second, control=control)
    changes = F.array_sort(
        F.collect_set(F.concat("dimension", F.lit(": "), "label1", F.lit(" → "), "label2"))
    )  # one entry per dimension at most
    listed = cases.groupBy("message_id").agg(F.array_join(changes, "; ").alias("changes"))
    number = listed.agg(F.count(F.lit(1)).alias("n"))
    some = listed.orderBy("message_id").limit(shown)
    return (
        _rows(evaluated, F.lit("summary"), F.lit("evaluated"), "n")
        .unionByName(score_rows)
        .unionByName(_rows(number, F.lit("summary"), F.lit("inconsistent_messages"), "n"))
        .unionByName(_rows(some, F.lit("cases"), "message_id", F.lit(None), "changes"))
    )


def tally(reviewed: DataFrame) -> DataFrame:
    """Every count the review reports need, from one pass: ``section, item, n``.

    Each record adds itself, its labels and its issue types; what leaves a task is one
    row per distinct item.  Filters stay above the counts (they would be pushed below, and
    each section would count anew), so that all sections share one exchange.
    """

    def entry(section: str, item: Column) -> Column:
        return F.struct(F.lit(section).alias("section"), item.alias("item"))

    flagged = F.col("n_reasons") > 0
    fixed = F.array(
        entry("summary", F.lit("total")),
        entry("summary", F.when(flagged, F.lit("to_review"))),
        *[entry(d, F.col(d)) for d in review.DIMENSIONS],
    )
    issues = F.transform("reasons", lambda r: entry("issues", issue_type(r["code"])))
    items = reviewed.select(F.inline(F.concat(fixed, issues)))
    counts = items.groupBy("section", "item").agg(F.count(F.lit(1)).alias("n"))
    return counts.select(F.inline(F.array(F.struct("section", "item", "n"))))


def _totals(counts: DataFrame) -> DataFrame:
    """One row of the figures that rates, anomalies and advice are made of."""

    def count_of(section: str, item: str) -> Column:
        hit = (F.col("section") == section) & (F.col("item") == item)
        return F.coalesce(F.sum(F.when(hit, F.col("n"))), F.lit(0))

    intents = (F.col("section") == "primary_intent") & F.col("item").isNotNull()
    figures = counts.agg(
        count_of("summary", "total").alias("total"),
        count_of("summary", "to_review").alias("to_review"),
        count_of("primary_intent", label_rules.OTHER_LABEL).alias("others"),
        count_of("safety_level", label_rules.TAXONOMY["safety_level"][0]).alias("safes"),
        F.count_if(intents).alias("intents"),
    )

    def share(column: str) -> Column:
        return F.when(F.col("total") > 0, F.col(column) / F.col("total"))

    return figures.select(
        "total", "to_review", share("to_review").alias("rate"),
        share("others").alias("other"), share("safes").alias("safe"), "intents",
    )


def recommendations(counts: DataFrame) -> DataFrame:
    """Up to three advices from a ``tally``: review rate, OTHER share, safe share."""

    def advice(rank: int, name: str, value: str, limit: float) -> Column:
        row = F.struct(
            F.lit(rank).alias("rank"), F.lit(name).alias("advice"), F.col(value).alias("value")
        )
        return F.when(F.col(value) > limit, row)

    rows = F.array(
        advice(1, "refine_annotation_prompt", "rate", label_rules.REVIEW_RATE_GATE),
        advice(2, "split_other_category", "other", label_rules.OTHER_SHARE_GATE),
        advice(3, "check_safety_labels", "safe", label_rules.SAFE_SHARE_ALERT),
    )
    return _totals(counts).select(F.inline(F.array_compact(rows)))


def _summary_rows(counts: DataFrame, with_advice: bool) -> DataFrame:
    summary, anomalies, advice = F.lit("summary"), F.lit("anomalies"), F.lit("recommendations")
    rate, other, safe, intents = (F.col(c) for c in ("rate", "other", "safe", "intents"))
    many_others = other > label_rules.OTHER_SHARE_GATE
    too_safe = safe > label_rules.SAFE_SHARE_ALERT
    few = intents < label_rules.MIN_DISTINCT_INTENTS
    rows = [
        _entry(summary, F.lit("total_messages"), F.col("total")),
        _entry(summary, F.lit("messages_needing_review"), F.col("to_review")),
        _entry(summary, F.lit("review_rate"), rate),
        F.when(many_others, _entry(anomalies, F.lit("other_share_high"), other)),
        F.when(few, _entry(anomalies, F.lit("few_intents"), intents)),
        F.when(too_safe, _entry(anomalies, F.lit("safe_share_high"), safe)),
    ]
    if with_advice:
        frequent = rate > label_rules.REVIEW_RATE_GATE
        rows += [
            F.when(frequent, _entry(advice, F.lit("refine_annotation_prompt"), rate)),
            F.when(many_others, _entry(advice, F.lit("split_other_category"), other)),
            F.when(too_safe, _entry(advice, F.lit("check_safety_labels"), safe)),
        ]
    return _totals(counts).select(F.inline(F.array_compact(F.array(*rows))))


def _share_rows(counts: DataFrame) -> DataFrame:
    labels_only = counts.where(F.col("section").isin(*review.DIMENSIONS))
    base = Window.partitionBy("section")
    shares = labels_only.withColumn("share", F.col("n") / F.sum("n").over(base)).where(
        F.col("item").isNotNull()
    )
    drawn = F.concat_ws(" ", bar(F.col("share")), percent(F.col("share")))
    return _rows(shares, F.concat(F.lit("distribution:"), "section"), "item", "share", drawn)


def quick_stats(reviewed: DataFrame) -> DataFrame:
    """Totals, review rate, distributions and the anomalies that fire."""
    counts = tally(reviewed)  # both sections read the one exchange that the tally ends in
    return _summary_rows(counts, with_advice=False).unionByName(_share_rows(counts))


def review_report(
    reviewed: DataFrame, order: str = "message_id", text: str = "text", response: str = "response"
) -> DataFrame:
    """Quick statistics, issue counts, examples per issue, and recommendations.

    An example shows its labels, reason codes, message and proposed response.

    Two passes over the records: one for all counts, one for the top candidates.
    """
    counts = tally(reviewed)  # every section reads the one exchange that the tally ends in
    examples = review.examples_by_issue(reviewed, order=order)
    example_text = F.concat_ws(
        " | ", "primary_intent", "message_tone", "safety_level", review.reason_codes(), text, response
    )
    issues = counts.where(F.col("section") == "issues")
    return (
        _summary_rows(counts, with_advice=True)
        .unionByName(_share_rows(counts))
        .unionByName(_rows(issues, "section", "item", "n"))
        .unionByName(
            _rows(
                examples, F.concat(F.lit("examples:"), "issue"), F.col(order), "rank", example_text
            )
        )
    )
