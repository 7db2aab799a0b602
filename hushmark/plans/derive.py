"""Label, session and corpus tables derived from the given tables.

The given tables hold conversations and events, but no labels.  Labels, sessions and
responses are drawn by hash from the row keys, so they grow with the tables and come
out the same in any engine.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hushmark.functions import draw, pick, text_array
from hushmark.operators.seed import seed_messages
from hushmark.rules import labels as rules

KEYS = ("conv_id", "turn")
INTENTS = rules.TAXONOMY["primary_intent"] + ("OTHER", None)
TONES = rules.TAXONOMY["message_tone"]
LEVELS = rules.TAXONOMY["safety_level"]
STAGES = rules.TAXONOMY["rapport_stage"] + (None,)
STATUSES = rules.GUIDELINE_TAXONOMY["customer_status"]
PROFILES = rules.TAXONOMY["profile_id"]
ANNOTATORS = ("ann", "ben", "cleo", "dan")
SNIPPETS = (
    "", "", "", "only $25", "\U0001F60A\U0001F60A\U0001F495", "see onlyfans", "te lo prometo",
    "mi amor", "really? yes?", "ok",
)
PHRASES = (
    "eres sexy", "ok", "Ya.", "Hola, qué tal", "¿Cuánto cuesta?", "no sé si vale la pena",
    "Hey hermosa", "pero el precio", "juntos en la cama", "hello there", "me gusta el cine", "paso",
)
LINES = (
    "plain line", "token sk-demo", "key sk-YOUR_API_KEY", "sk-one and sk-two", "ask-me",
)


SPREAD = "hushmark.spread"


def load(spark: SparkSession, folder: str, name: str, *key: str) -> DataFrame:
    """A given table, read as it is: no shuffle.

    A file of one row group is one task, however many cores there are.  Who knows that the
    tables come like that names a number of partitions in ``hushmark.spread``; rows are then
    dealt out by key first.  Nothing about the data decides it.
    """
    df = spark.read.parquet(f"{folder}/{name}.parquet")
    parts = spark.conf.get(SPREAD, None)
    return df.repartition(int(parts), *key) if parts and key else df


def messages(spark: SparkSession, folder: str) -> DataFrame:
    """Conversation turns with a text ``message_id`` that is unique at any size."""
    df = load(spark, folder, "conversations", *KEYS)
    return df.withColumn("message_id", F.concat_ws(":", "conv_id", "turn"))


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return load(spark, folder, "documents", "doc_id")


def seeded(spark: SparkSession, folder: str) -> DataFrame:
    return seed_messages(messages(spark, folder), KEYS)


def _label(values: tuple[str | None, ...], salt: str) -> Column:
    return pick(values, draw(len(values), salt, *KEYS))


def annotations(spark: SparkSession, folder: str) -> DataFrame:
    """One labelled row per message, with a response and a place on a timeline."""
    return with_labels(messages(spark, folder)).withColumn(
        "response", F.concat_ws(" ", "text", pick(SNIPPETS, draw(len(SNIPPETS), "snippet", *KEYS)))
    )


def with_labels(df: DataFrame) -> DataFrame:
    seconds = F.col("turn") * 600 + draw(900, "delay", *KEYS)
    return df.withColumns(
        {
            "primary_intent": _label(INTENTS, "intent"),
            "message_tone": _label(TONES, "tone"),
            "safety_level": _label(LEVELS, "safety"),
            "rapport_stage": _label(STAGES, "stage"),
            "customer_status": _label(STATUSES, "status"),
            "profile_id": pick(
                PROFILES,
                F.when(draw(10, "profile_change", *KEYS) == 0, draw(3, "profile2", *KEYS)).otherwise(
                    draw(3, "profile", "conv_id")
                ),
            ),
            "confidence": draw(100, "confidence", *KEYS) / 100.0,
            "seconds": seconds,
        }
    )


VALUES = {"primary_intent": INTENTS, "message_tone": TONES, "safety_level": LEVELS}


def _relabelled(column: str, who: str, percent: int = 15) -> Column:
    """The label, or for a share of the rows another draw that depends on ``who``."""
    values = VALUES[column]
    changed = draw(100, f"relabel_{column}", *KEYS, who) < percent
    other = pick(values, draw(len(values), f"second_{column}", *KEYS, who))
    return F.when(changed, other).otherwise(F.col(column)).alias(column)


def session_records(spark: SparkSession, folder: str) -> DataFrame:
    """Calibration recordings: two sessions, and second recordings of some messages.

    ``seq`` orders the recordings; a later one replaces an earlier one.
    """
    base = with_labels(messages(spark, folder))
    recordings = base.select(
        *KEYS, "message_id", *VALUES, F.explode(text_array(("day1-0", "day1-1", "day2-0", "day2-1"))).alias("who")
    )
    recordings = recordings.withColumns(
        {"session": F.split_part("who", F.lit("-"), F.lit(1)), "seq": F.expr("cast(right(who, 1) as bigint)")}
    )
    # a tenth of the messages is missing in a session, a fifth is recorded twice
    there = draw(10, "in_session", *KEYS, "session") > 0
    twice = draw(5, "twice", *KEYS, "session") == 0
    kept = recordings.where(there & ((F.col("seq") == 0) | twice))
    return kept.select(
        "session", "message_id", F.expr("0L as recorded_at"), "seq",
        *[_relabelled(d, "who") for d in VALUES],
    )


def annotator_labels(spark: SparkSession, folder: str) -> DataFrame:
    """Each message labelled by the annotators that a draw assigns to it."""
    base = with_labels(messages(spark, folder))
    each = base.withColumn("annotator", F.explode(text_array(ANNOTATORS)))
    assigned = each.where(draw(2, "assigned", *KEYS, "annotator") == 0)
    return assigned.select(
        "message_id", "annotator", *[_relabelled(d, "annotator") for d in VALUES]
    )


def utterances(spark: SparkSession, folder: str) -> DataFrame:
    """All messages, and for each one more that is, or ends in, one of a few telling phrases."""
    given = messages(spark, folder)
    phrase = pick(PHRASES, draw(len(PHRASES), "phrase", *KEYS))
    alone = draw(2, "alone", *KEYS) == 0
    text = F.when(alone, phrase).otherwise(F.concat_ws(" ", "text", phrase))
    added = given.withColumns({"text": text, "message_id": F.concat("message_id", F.lit(":more"))})
    return with_labels(given.unionByName(added))


def entity_mentions(spark: SparkSession, folder: str) -> DataFrame:
    """Person mentions per message: words of the text that a draw takes for names."""
    words = messages(spark, folder).select(
        *KEYS, "message_id", F.posexplode(F.split("text", " ")).alias("at", "word")
    )
    word = F.regexp_replace("word", F.lit("[.,\n]+"), F.lit(""))
    named = words.withColumn("entity", word).where(F.length("entity") >= 4)
    return named.where(draw(20, "person", *KEYS, "at") == 0).select("message_id", "entity")


def lined_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Documents with one more line, which for some holds a secret marker."""
    line = pick(LINES, draw(len(LINES), "line", "doc_id"))
    return documents(spark, folder).withColumn("text", F.concat_ws("\n", "text", line))


def events(spark: SparkSession, folder: str) -> DataFrame:
    return load(spark, folder, "events")


def event_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Events as JSON documents of several shapes around the given ``props``."""
    shape = draw(4, "shape", "event_id")
    props, kind = F.col("props"), F.col("event_type")
    body = (
        F.when(shape == 0, props)
        .when(shape == 1, F.concat(F.lit('{"kind":"'), kind, F.lit('","props":'), props, F.lit("}")))
        .when(
            shape == 2,
            F.concat(F.lit('{"items":['), props, F.lit(","), props, F.lit('],"kind":null}')),
        )
        .otherwise(F.concat(F.lit("["), props, F.lit("]")))
    )
    return load(spark, folder, "events", "event_id").select("event_id", body.alias("json"))


def user_history(spark: SparkSession, folder: str) -> DataFrame:
    """Attribute observations per user; many are missing."""
    countries = (None, "MX", "ES", "US")
    jobs = (None, None, "teacher", "driver", "nurse")
    return events(spark, folder).select(
        "user_id", "ts", F.col("event_id").alias("seq"),
        pick(countries, draw(4, "country", "event_id")).alias("user_country"),
        pick(jobs, draw(5, "job", "event_id")).alias("user_occupation"),
        pick(STATUSES, draw(5, "status", "event_id")).alias("customer_status"),
    )
