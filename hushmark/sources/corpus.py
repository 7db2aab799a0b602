"""JSON corpora in and out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SOURCE = "source_file"

MESSAGE = T.StructType(
    [
        T.StructField("message_id", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("author", T.StringType()),
        T.StructField("has_emoji", T.BooleanType()),
        T.StructField("has_photo", T.BooleanType()),
        T.StructField("has_gif", T.BooleanType()),
    ]
)
CORPUS = T.StructType(
    [
        T.StructField("conversation_id", T.StringType()),
        T.StructField("messages", T.ArrayType(MESSAGE)),
    ]
)
ANNOTATION = T.StructType(
    [
        T.StructField("message_id", T.StringType()),
        T.StructField("original_text", T.StringType()),
        T.StructField(
            "annotations",
            T.StructType(
                [
                    T.StructField("primary_intent", T.StringType()),
                    T.StructField("message_tone", T.StringType()),
                    T.StructField("safety_level", T.StringType()),
                    T.StructField("confidence", T.DoubleType()),
                    T.StructField("reasoning", T.StringType()),
                ]
            ),
        ),
        T.StructField(
            "ideal_response",
            T.StructType(
                [T.StructField("text", T.StringType()), T.StructField("strategy", T.StringType())]
            ),
        ),
    ]
)


def infer_corpus_schema(
    spark: SparkSession, paths: str | list[str], pattern: str = "*.json", multi_line: bool = True
) -> T.StructType:
    """The schema with every key that occurs.

    This reads everything once.  Keep the result (``schema.json()``) and hand it to
    ``read_corpus`` on the next runs.
    """
    frame = (
        spark.read.option("multiLine", multi_line)
        .option("pathGlobFilter", pattern)
        .option("mode", "FAILFAST")
        .json(paths)
    )
    return frame.schema


def read_corpus(
    spark: SparkSession,
    paths: str | list[str],
    pattern: str = "*.json",
    schema: T.StructType | None = None,
    multi_line: bool = True,
) -> DataFrame:
    """Conversations from UTF-8 JSON files, with the file in ``source_file``.

    With ``multi_line`` a file is one root array of conversations or one conversation,
    and is read by one task; without it every line is a conversation and files split.
    Without ``schema`` it is inferred, so unknown keys survive.  Malformed files fail
    the read; a corpus in which nothing has ``messages`` is an error.
    """
    if schema is None:
        schema = infer_corpus_schema(spark, paths, pattern, multi_line)
    if "messages" not in schema.fieldNames():
        raise ValueError(f"no conversation with messages in {paths}")
    return (
        spark.read.schema(schema)
        .option("multiLine", multi_line)
        .option("pathGlobFilter", pattern)
        .option("mode", "FAILFAST")
        .json(paths)
        .select("*", F.col("_metadata.file_path").alias(SOURCE))
    )


def files_without_messages(conversations: DataFrame) -> DataFrame:
    """Source files in which no row has messages: their root has an unexpected shape."""
    return (
        conversations.groupBy(SOURCE)
        .agg(F.count(F.lit(1)).alias("rows"), F.count("messages").alias("with_messages"))
        .where("with_messages = 0")
        .select(SOURCE, "rows")
    )


CORRUPT = "_corrupt_record"


def read_corpus_by_file(
    spark: SparkSession,
    paths: str | list[str],
    pattern: str = "*.json",
    schema: T.StructType | None = None,
    multi_line: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """The conversations of well-shaped files, and the other files as ``(path, reason)``.

    A file with a malformed record is ``malformed``; one in which nothing has messages has
    ``no messages``.  Such a file is left out as a whole, and the rest is read on.
    """
    reader = spark.read.option("multiLine", multi_line).option("pathGlobFilter", pattern).option("mode", "PERMISSIVE")
    if schema is None:
        schema = reader.option("columnNameOfCorruptRecord", CORRUPT).json(paths).schema
    fields = [f for f in schema.fields if f.name != CORRUPT]
    if "messages" not in [f.name for f in fields]:
        fields = [*fields, T.StructField("messages", T.ArrayType(MESSAGE))]  # no file has any: all are told
    whole = T.StructType([*fields, T.StructField(CORRUPT, T.StringType())])
    rows = (
        reader.schema(whole)
        .option("columnNameOfCorruptRecord", CORRUPT)
        .json(paths)
        .select("*", F.col("_metadata.file_path").alias(SOURCE))
    )
    shape = rows.groupBy(SOURCE).agg(F.count(CORRUPT).alias("_bad"), F.count("messages").alias("_with"))
    reason = F.when(F.col("_bad") > 0, "malformed").when(F.col("_with") == 0, "no messages")
    rejected = shape.select(F.col(SOURCE).alias("path"), reason.alias("reason")).where("reason is not null")
    good = rows.drop(CORRUPT).join(rejected, F.col(SOURCE) == F.col("path"), "left_anti")
    return good, rejected


def read_annotations(
    spark: SparkSession, paths: str | list[str], multi_line: bool = True
) -> DataFrame:
    """Annotation records; the optional parts are null where absent."""
    return spark.read.schema(ANNOTATION).option("multiLine", multi_line).json(paths)


def write_json(df: DataFrame, path: str, keep_nulls: bool = False, mode: str = "errorifexists") -> None:
    """JSON lines in UTF-8.  Absent keys stay absent unless ``keep_nulls``."""
    df.write.mode(mode).option("ignoreNullFields", not keep_nulls).json(path)


def write_corrections(corrections: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Correction records with their empty fields spelled out as null."""
    write_json(corrections, path, keep_nulls=True, mode=mode)


def label_tasks(conversations: DataFrame, with_metadata: bool = True) -> DataFrame:
    """One labelling task per conversation row: ``data`` and, if wanted, all other columns as ``meta``.

    A corpus need not name its conversations.
    """
    data = [c for c in ("conversation_id", "messages") if c in conversations.columns]
    meta = [c for c in conversations.columns if c not in data]
    columns = [F.struct(*data).alias("data")]
    if with_metadata and meta:
        columns.append(F.struct(*meta).alias("meta"))
    return conversations.select(*columns)


def write_label_tasks(
    conversations: DataFrame, path: str, with_metadata: bool = True, mode: str = "errorifexists"
) -> None:
    write_json(label_tasks(conversations, with_metadata), path, mode=mode)
