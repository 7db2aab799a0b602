"""Redaction of message streams: the batch projection, unchanged."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from hushmark.operators.redact import redact_messages
from hushmark.rules.pii import PII_RULES, PiiRule


def checkpoint_path(spark: SparkSession, name: str) -> str:
    """A folder below the one the cluster names in ``spark.checkpoint.dir``."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        raise ValueError("spark.checkpoint.dir is not set")
    return f"{base.rstrip('/')}/{name}"


def redact_stream(
    messages: DataFrame,
    text: str = "text",
    rules: tuple[PiiRule, ...] = PII_RULES,
    entities: str | None = None,
) -> DataFrame:
    """No state and no shuffle: each micro-batch is one narrow stage.

    ``entities`` names an array column of person names that come with the messages.
    """
    return redact_messages(messages, text, rules, entities)


def start_redaction(
    messages: DataFrame,
    out: str,
    name: str,
    text: str = "text",
    available_now: bool = True,
    rules: tuple[PiiRule, ...] = PII_RULES,
    entities: str | None = None,
) -> StreamingQuery:
    """Write a redacted stream to parquet, remembering its progress in the shared folder."""
    writer = (
        redact_stream(messages, text, rules, entities)
        .writeStream.format("parquet")
        .queryName(name)
        .option("path", out)
        .option("checkpointLocation", checkpoint_path(messages.sparkSession, name))
        .outputMode("append")
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
