"""What redaction left behind: residual scans, recall and structure checks."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hushmark.functions import text_array
from hushmark.operators.redact import TEST_COLUMN, may_match, redact_text
from hushmark.operators.seed import only_seeded, per_value
from hushmark.plans.once import evaluate_once
from hushmark.rules.pii import AUDIT_NAMES, PII_RULES, PiiRule

SCANNED = ("email", "phone", "social")


def residuals(
    df: DataFrame,
    text: str = "text",
    names: Sequence[str] = AUDIT_NAMES,
    rules: tuple[PiiRule, ...] = PII_RULES,
) -> DataFrame:
    """Add arrays of what the scan finds: ``emails``, ``phones``, ``socials``, ``names``.

    Each pattern reads the text as it stands; a known name is found anywhere, in any case.
    """
    by_category = {r.category: r for r in rules}
    low = F.lower(F.coalesce(F.col(text), F.lit("")))

    def found(category: str) -> Column:
        rule, where = by_category[category], F.coalesce(F.col(text), F.lit(""))
        everything = F.regexp_extract_all(where, F.lit(rule.pattern), F.lit(0))
        cheap = may_match(where, rule)  # most texts fail a simple test and skip the pattern
        if cheap is not None:
            everything = F.when(cheap, everything).otherwise(F.array().cast("array<string>"))
        return everything.alias(f"{category}s")

    known = F.filter(text_array(names), lambda n: F.contains(low, F.lower(n)))
    return evaluate_once(df, *[found(c) for c in SCANNED], known.alias("names"))


def residual_details(df: DataFrame, *keep: str, text: str = "text") -> DataFrame:
    """Only the messages where something was found, without their text."""
    arrays = ("emails", "phones", "socials", "names")
    hit = reduce(or_, [F.array_size(a) > 0 for a in arrays])
    return residuals(df, text).where(hit).select(*keep, *arrays)


def residual_summary(df: DataFrame, *by: str, text: str = "text") -> DataFrame:
    """Messages with anything left, and how much per kind, per group."""
    arrays = ("emails", "phones", "socials", "names")
    hit = reduce(or_, [F.array_size(a) > 0 for a in arrays])
    return residuals(df, text).groupBy(*by).agg(
        F.count(F.lit(1)).alias("messages"),
        F.count_if(hit).alias("messages_with_pii"),
        *[F.coalesce(F.sum(F.array_size(a)), F.lit(0)).alias(a) for a in arrays],
    )


def before_and_after(
    df: DataFrame, *keep: str, text: str = "text", rules: tuple[PiiRule, ...] = PII_RULES
) -> DataFrame:
    """Each message twice, as ``stage`` before and after redaction: one pass, one scan."""
    done = redact_text(df, text, rules)
    stages = [F.struct(F.lit(s).alias("stage"), F.col(c).alias(text)) for s, c in (("before", "_before"), ("after", text))]
    return done.select(*keep, F.inline(F.array(*stages)))


def recall_rows(
    seeded: DataFrame, *keep: str, text: str = "text", rules: tuple[PiiRule, ...] = PII_RULES
) -> DataFrame:
    """One row per seeded value with ``removed``: whether redaction made it disappear.

    The test is made inside the message row, before values are unpacked, so no text
    is copied or shuffled.
    """
    redacted = redact_text(only_seeded(seeded), text, rules)
    fields = seeded.schema[TEST_COLUMN].dataType.fieldNames()

    def entry(field: str) -> Callable[[Column], Column]:
        return lambda value: F.struct(
            F.lit(field).alias("category"),
            value.alias("value"),
            (~F.contains(F.col(text), value)).alias("removed"),
        )

    return redacted.select(*keep, F.inline(per_value(fields, entry)))


def recall(seeded: DataFrame, *by: str, text: str = "text") -> DataFrame:
    """Share of seeded values that redaction removed, per ``category``, ``value`` or kept column."""
    kept = [c for c in by if c not in ("category", "value")]
    return recall_rows(seeded, *kept, text=text).groupBy(*by).agg(
        F.count(F.lit(1)).alias("seeded"),
        F.count_if("removed").alias("removed"),
        (F.count_if("removed") / F.count(F.lit(1))).alias("recall"),
    )


def structure_differences(
    original: DataFrame, redacted: DataFrame, keys: Sequence[str], fields: Sequence[str]
) -> DataFrame:
    """One row per message and field that differs; a missing or extra message shows as such."""
    left = original.select(*keys, F.struct(*fields).alias("_a"))
    right = redacted.select(*keys, F.struct(*fields).alias("_b"))
    gone, extra = F.col("_b").isNull(), F.col("_a").isNull()
    codes = F.array_compact(
        F.array(
            F.when(gone, "missing_message"),
            F.when(extra, "extra_message"),
            *[
                F.when(~gone & ~extra & ~F.col(f"_a.{f}").eqNullSafe(F.col(f"_b.{f}")), f)
                for f in fields
            ],
        )
    )
    joined = left.join(right, list(keys), "full_outer")
    return joined.select(*keys, F.explode(codes).alias("difference"))


def structure_counts(
    original: DataFrame, redacted: DataFrame, conversation: str
) -> DataFrame:
    """Conversations whose number of messages differs between the two tables."""

    def tagged(df: DataFrame, side: str) -> DataFrame:
        return df.select(
            conversation,
            F.lit(int(side == "original")).alias("o"),
            F.lit(int(side == "redacted")).alias("r"),
        )

    both = tagged(original, "original").unionByName(tagged(redacted, "redacted"))
    return (
        both.groupBy(conversation)
        .agg(F.sum("o").alias("original_messages"), F.sum("r").alias("redacted_messages"))
        .where(F.col("original_messages") != F.col("redacted_messages"))
    )


def rows_changed(original: DataFrame, redacted: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows in one table and not the other on the given columns, duplicates counted.

    Adds ``side`` and by how many rows it has more, ``n``.  One aggregate over both tables.
    """
    both = original.select(*columns, F.lit(1).alias("_d")).unionByName(
        redacted.select(*columns, F.lit(-1).alias("_d"))
    )
    differ = both.groupBy(*columns).agg(F.sum("_d").alias("_d")).where(F.col("_d") != 0)
    side = F.when(F.col("_d") > 0, "original").otherwise("redacted")
    return differ.select(*columns, side.alias("side"), F.abs("_d").alias("n"))


def marked_lines(
    df: DataFrame, *keep: str, text: str = "text", marker: str = "sk-", allowed: str = "(?s)YOUR_.*_KEY"
) -> DataFrame:
    """Lines that hold a secret marker, unless they match the placeholder pattern."""
    lines = df.where(F.contains(F.col(text), F.lit(marker))).select(
        *keep, F.posexplode(F.split(text, "\n")).alias("line_no", "line")
    )
    return lines.where(
        F.contains("line", F.lit(marker)) & ~F.regexp_like("line", F.lit(allowed))
    )
