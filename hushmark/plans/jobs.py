"""Whole jobs: corpus in, redacted corpus and reports out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hushmark.config import JobConfig
from hushmark.operators import review
from hushmark.operators.guidelines import vocabulary
from hushmark.operators.messages import flatten, nested_within_length
from hushmark.operators.redact import (
    TEST_COLUMN,
    message_fields,
    redact_nested,
    statistics,
)
from hushmark.operators.seed import seed_nested, seeding_details, seeding_totals
from hushmark.plans import reports
from hushmark.rules.pii import PII_RULES, PiiRule, select_rules
from hushmark.sources.corpus import (
    SOURCE,
    files_without_messages,
    read_corpus,
    read_corpus_by_file,
    write_corrections,
    write_json,
    write_label_tasks,
)


def checked_corpus(
    spark: SparkSession,
    source: str,
    out: str,
    schema: T.StructType | None,
    multi_line: bool,
    on_bad: str,
    mode: str,
    pattern: str = "*.json",
) -> DataFrame:
    """The corpus of a job.

    A file that is malformed or in which nothing has messages is an error, or with
    ``on_bad="reject"`` a row ``path, reason`` in ``<out>/rejected`` while the others go on.
    """
    if on_bad == "reject":
        corpus, rejected = read_corpus_by_file(spark, source, pattern, schema, multi_line)
        write_json(rejected, f"{out}/rejected", mode=mode)
        return corpus
    if on_bad != "fail":
        raise ValueError(f"on_bad: {on_bad}; known: fail, reject")
    corpus = read_corpus(spark, source, pattern, schema, multi_line)
    odd = [r[SOURCE] for r in files_without_messages(corpus).limit(5).collect()]
    if odd:
        raise ValueError(f"no conversation with messages in {', '.join(odd)}")
    return corpus


def message_rows(conversations: DataFrame) -> DataFrame:
    """Messages of a nested corpus as flat rows: the conversation's fields, ``pos``, and the
    message's fields, which win where names clash."""
    fields = message_fields(conversations)
    flat = flatten(conversations).where(F.col("pos").isNotNull())
    outer = [c for c in flat.columns if c != "message" and c not in fields]
    return flat.select(*outer, *[F.col(f"message.{f}").alias(f) for f in fields])


def redact_corpus(
    spark: SparkSession,
    source: str,
    out: str,
    rules: tuple[PiiRule, ...] = PII_RULES,
    schema: T.StructType | None = None,
    multi_line: bool = True,
    mode: str = "errorifexists",
    entities: str | None = None,
    on_bad: str = "fail",
) -> DataFrame:
    """Redact every file of a corpus; returns the per-file summary.

    The patterns run once: into ``<out>/redacted`` (parquet, with counts).  From there
    come ``<out>/conversations``, JSON lines in the input's nested shape, and
    ``<out>/summary``, which reads the count columns alone.  ``entities`` is a message field
    with person names; ``on_bad`` as in ``checked_corpus``.
    """
    corpus = checked_corpus(spark, source, out, schema, multi_line, on_bad, mode)
    done = redact_nested(corpus, rules=rules, counts=True, entities=entities)
    done.write.mode(mode).parquet(f"{out}/redacted")
    written = spark.read.parquet(f"{out}/redacted")
    kept = [c for c in corpus.columns if c != SOURCE]
    write_json(written.select(*kept), f"{out}/conversations", mode=mode)
    summary = statistics(written, SOURCE, rules=rules).withColumn("output", F.lit(f"{out}/conversations"))
    write_json(summary, f"{out}/summary", keep_nulls=True, mode=mode)
    return summary


def seed_corpus(
    spark: SparkSession,
    source: str,
    out: str,
    schema: T.StructType | None = None,
    multi_line: bool = True,
    mode: str = "errorifexists",
    on_bad: str = "fail",
) -> tuple[DataFrame, DataFrame]:
    """Seed the messages of a corpus in place; returns the totals and the seeded values per file.

    ``<out>/conversations`` has the input's rows and fields plus the truth, ready for
    ``redact_corpus(..., multi_line=False)``.  ``<out>/totals`` and ``<out>/values`` are per file,
    ``<out>/report`` is one record over all files.
    """
    corpus = checked_corpus(spark, source, out, schema, multi_line, on_bad, mode)
    if "text" not in message_fields(corpus):
        raise ValueError(f"no message with text in {source}")
    seed_nested(corpus).write.mode(mode).parquet(f"{out}/seeded")
    written = spark.read.parquet(f"{out}/seeded")
    write_json(written.drop(SOURCE), f"{out}/conversations", mode=mode)

    flat = flatten(written.select(SOURCE, "messages")).select(
        SOURCE, "pos", F.col(f"message.{TEST_COLUMN}").alias(TEST_COLUMN)
    )
    totals = seeding_totals(flat, SOURCE, position="pos").withColumn(
        "seeded_at", F.current_timestamp()
    )
    details = seeding_details(flat, SOURCE)
    write_json(totals, f"{out}/totals", keep_nulls=True, mode=mode)
    write_json(details, f"{out}/values", mode=mode)
    write_json(seeding_report(totals), f"{out}/report", keep_nulls=True, mode=mode)
    return totals, details


def seeding_report(totals: DataFrame) -> DataFrame:
    """One record over the per-file totals: files, conversations, messages, those seeded and their share."""
    messages, seeded = F.sum("messages"), F.sum("messages_seeded")
    return totals.agg(
        F.count(F.lit(1)).alias("files_processed"),
        F.sum("conversations").alias("conversations"),
        messages.alias("messages"),
        seeded.alias("messages_seeded"),
        F.when(messages > 0, seeded * 100.0 / messages).alias("percent_seeded"),
        F.max("seeded_at").alias("seeded_at"),
    )


def review_annotations(
    spark: SparkSession, annotations: DataFrame, out: str, mode: str = "errorifexists"
) -> DataFrame:
    """Review flat annotations (``review.flat_annotations``) and write every report.

    The rules run once, into ``<out>/reviewed``; ``report``, ``stats`` and the ranked
    ``corrections`` read that table, so the sort samples a scan and not the rules.
    """
    review.review(annotations).write.mode(mode).parquet(f"{out}/reviewed")
    reviewed = spark.read.parquet(f"{out}/reviewed")
    write_json(reports.review_report(reviewed), f"{out}/report", keep_nulls=True, mode=mode)
    write_json(reports.quick_stats(reviewed), f"{out}/stats", keep_nulls=True, mode=mode)
    corrections = review.correction_records(reviewed, settle=False)
    write_corrections(corrections, f"{out}/corrections", mode=mode)
    return reviewed


def prepare_corpus(
    spark: SparkSession,
    config: JobConfig,
    out: str,
    schema: T.StructType | None = None,
    multi_line: bool = True,
    mode: str = "errorifexists",
    on_bad: str = "fail",
) -> DataFrame:
    """Redact the configured categories in conversations of the configured length.

    Writes ``<out>/redacted``, and from it the labelling tasks, the vocabulary and the
    run record; returns the run record.
    """
    corpus = checked_corpus(
        spark, config.raw_data_path, out, schema, multi_line, on_bad, mode, config.file_pattern
    )
    kept = nested_within_length(corpus, config.min_messages, config.max_messages)
    rules = select_rules(config.categories)
    redact_nested(kept, rules=rules, counts=True).write.mode(mode).parquet(f"{out}/redacted")
    written = spark.read.parquet(f"{out}/redacted")
    if config.label_tasks:
        tasks = written.select(*corpus.columns)
        write_label_tasks(tasks, f"{out}/tasks", config.include_metadata, mode)
    words = vocabulary(message_rows(written), n=config.vocabulary_limit)
    write_json(words, f"{out}/vocabulary", mode=mode)
    record = run_record(written, config.version)
    write_json(record, f"{out}/run", mode=mode)
    return record


def run_record(
    conversations: DataFrame, version: str, source: str = SOURCE, stamp: bool = True
) -> DataFrame:
    """One row about a finished run: files and conversations, and when.

    On the rows of ``messages.nest`` a conversation is counted by its first part.
    """
    whole = F.count_if(F.col("part") == 0) if "part" in conversations.columns else F.count(F.lit(1))
    record = conversations.agg(
        F.count_distinct(source).alias("files_processed"),
        whole.alias("conversations"),
    ).select(
        F.lit(version).alias("version"),
        F.lit("completed").alias("status"),
        "files_processed",
        "conversations",
    )
    return record.withColumn("finished_at", F.current_timestamp()) if stamp else record
