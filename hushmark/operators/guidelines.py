"""Keyword labels and lifecycle rules from the labelling guidelines."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hushmark.functions import whole_words
from hushmark.plans.ordered import number_rows, trailing_count
from hushmark.rules import guidelines as rules
from hushmark.rules import labels as label_rules
from hushmark.rules.pii import CLOSE, FLAGS, any_of


def keyword_safety(
    df: DataFrame,
    text: str = "text",
    words: Mapping[str, Iterable[str]] = rules.SAFETY_WORDS,
    default: str = label_rules.TAXONOMY["safety_level"][0],
) -> DataFrame:
    """Add ``keyword_level``: the highest level one of whose words occurs."""
    ranked = sorted(words)  # level names sort by level
    level = F.lit(default)
    for name in ranked:
        level = F.when(whole_words(F.col(text), words[name]), F.lit(name)).otherwise(level)
    return df.withColumn("keyword_level", level)


def heuristic_intent(
    df: DataFrame,
    text: str = "text",
    words: Mapping[str, Iterable[str]] = rules.INTENT_WORDS,
) -> DataFrame:
    """Add ``heuristic_intent``: the first list with a hit in priority order, else null."""
    hits = [F.when(whole_words(F.col(text), w), F.lit(name)) for name, w in words.items()]
    return df.withColumn("heuristic_intent", F.coalesce(*hits))


def short_replies(
    df: DataFrame, *keep: str, text: str = "text", replies: Sequence[str] = rules.SHORT_REPLIES
) -> DataFrame:
    """Messages that are nothing but a short reply: their tone is DISMISSIVE."""
    plain = F.lower(F.regexp_replace(F.col(text), F.lit(r"^[\s.!…]+|[\s.!…]+$"), F.lit("")))
    return df.where(plain.isin(*replies)).select(*keep, F.lit("DISMISSIVE").alias("suggested"))


def repeated_greetings(
    df: DataFrame,
    conversation: str,
    order: Sequence[str],
    chunk: Column,
    *keep: str,
    text: str = "text",
    words: Sequence[str] = rules.GREETING_WORDS,
) -> DataFrame:
    """Messages opening with a greeting after an earlier one did: SMALL_TALK, not GREETING."""
    opening = FLAGS + r"^[\s¡]*" + any_of(words) + CLOSE
    columns = list(dict.fromkeys([conversation, *order, *keep]))
    greetings = df.where(F.regexp_like(F.col(text), F.lit(opening))).select(*columns)
    numbered = number_rows(greetings, [conversation], order, chunk, "_nth")
    return numbered.where(F.col("_nth") > 0).select(*keep, F.lit("SMALL_TALK").alias("suggested"))


def safety_escalation(
    df: DataFrame,
    conversation: str,
    seconds: str,
    at_least: int = 3,
    span: int = 600,
    level: str = "safety_level",
) -> DataFrame:
    """Level-1 messages with ``at_least`` of them in the last ``span`` seconds: treat as level 2."""
    flirt = label_rules.TAXONOMY["safety_level"][1]
    counted = trailing_count(df.where(F.col(level) == flirt), [conversation], seconds, span)
    return counted.where(F.col("recent") >= at_least)


def exhausted_leads(activity: DataFrame, user: str = "user_id") -> DataFrame:
    """Users that keep talking but never respond to an offer.

    ``activity`` has one row per user: ``status, offers, positive_answers,
    interactions, days_since_offer, soft_rejections``.
    """
    quiet = F.coalesce(F.col("days_since_offer") > rules.MAX_QUIET_DAYS, F.lit(False))
    return activity.where(
        (F.col("status") == rules.QUALIFIED_STATUS)
        & (F.col("offers") >= rules.MIN_OFFERS)
        & (F.col("positive_answers") == 0)
        & (F.col("interactions") > rules.MIN_INTERACTIONS)
        & (quiet | (F.col("soft_rejections") >= rules.MIN_SOFT_REJECTIONS))
    )


def lead_activity(
    events: DataFrame,
    user: str = "user_id",
    ts: str = "ts",
    kind: str = "event_type",
    kinds: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """Counts per user that the exhausted-lead rule needs, in one aggregate.

    ``kinds`` maps ``offer``, ``positive`` and ``rejection`` to event types.
    """
    kinds = kinds or {"offer": ["offer"], "positive": ["positive"], "rejection": ["rejection"]}

    def of(name: str) -> Column:
        return F.col(kind).isin(*kinds[name])

    last_offer = F.max(F.when(of("offer"), F.col(ts)))
    return events.groupBy(user).agg(
        F.count(F.lit(1)).alias("interactions"),
        F.count_if(of("offer")).alias("offers"),
        F.count_if(of("positive")).alias("positive_answers"),
        F.count_if(of("rejection")).alias("soft_rejections"),
        F.datediff(F.max(ts), last_offer).alias("days_since_offer"),
    )


def user_attributes(
    history: DataFrame,
    attributes: Sequence[str],
    user: str = "user_id",
    recorded: Sequence[str] = ("ts", "seq"),
) -> DataFrame:
    """The latest known value of each attribute per user."""
    at = F.struct(*recorded)
    return history.groupBy(user).agg(
        *[
            F.max_by(F.col(a), F.when(F.col(a).isNotNull(), at)).alias(a)
            for a in attributes
        ]
    )


def vocabulary(df: DataFrame, text: str = "text", n: int = rules.VOCABULARY_LIMIT) -> DataFrame:
    """The ``n`` most frequent words, split at ASCII whitespace; ties by word."""
    words = df.select(F.explode(F.split(text, "[ \t\n\r\f\\x0B]+")).alias("word"))
    counts = words.where("word <> ''").groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), "word").limit(n)
