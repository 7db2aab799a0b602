"""What the training-data operators share: tables, words, written intermediates, samples.

Rules that hold for every operator here, unless its own docstring says otherwise:

* a null text counts as an empty text; a null id is an id like any other;
* repeated rows are kept, one result row for each input row;
* only the named columns are read, so further columns of any name do no harm;
* empty tables give empty results of the same schema.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()

#: What separates words: ASCII without letters and digits.
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: ASCII blanks, for operators whose words are what stands between blanks.
BLANKS = r"[\x20\x09-\x0D]+"

#: Most rows, and most characters in their keys, of a table that is broadcast by hint.
BROADCAST_ROWS = 200_000
BROADCAST_CHARS = 4_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only. Pure ASCII takes the quick way."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def lower_words(text: Column) -> Column:
    """The lower-cased words of a text as an array; none for null."""
    return F.coalesce(F.array_remove(F.split(ascii_lower(text), NOT_WORD), ""), F.array().cast("array<string>"))


def shared_folder(spark: SparkSession) -> str:
    """The folder for intermediate tables, which driver and executors share.

    The session names it in ``spark.checkpoint.dir``. Only a local session may go without.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    made = os.path.join(tempfile.gettempdir(), f"hushmark-{os.getuid()}")
    return f"file://{made}"


def ship(spark: SparkSession) -> None:
    """Give the library's code to the executors' Python workers, once in a Spark application."""
    context = spark.sparkContext
    if getattr(context, "_hushmark_shipped", False):
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="hushmark-code-")), "hushmark.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(package)))
    context.addPyFile(archive)
    context._hushmark_shipped = True


def written(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it again: cuts lineage, survives lost executors.

    A failed attempt leaves nothing that a reader sees, as the folder is new on each call.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def unused(columns: list[str], *wanted: str) -> list[str]:
    """Names like ``wanted`` that none of ``columns`` has (case-insensitive), for helper columns of a join."""
    taken, out = {c.lower() for c in columns}, []
    for name in wanted:
        made = name
        while made.lower() in taken:
            made = f"_{made}"
        taken.add(made.lower())
        out.append(made)
    return out


def small(df: DataFrame, *chars: str) -> bool:
    """Whether a table is small enough to broadcast: rows and characters of the named columns."""
    size = [F.coalesce(F.sum(F.char_length(c)), F.lit(0)) for c in chars]
    row = df.agg(F.count(F.lit(1)), *size).first()
    return row[0] <= BROADCAST_ROWS and sum(row[1:]) <= BROADCAST_CHARS


def broadcast_if_small(df: DataFrame, *chars: str) -> DataFrame:
    """Hint a broadcast after counting; larger tables are left to Spark's shuffled joins."""
    return F.broadcast(df) if small(df, *chars) else df


def per_batch(
    df: DataFrame, fn: Callable[[dict[str, list]], dict[str, list]], schema: str, rows: int = 256
) -> DataFrame:
    """Apply ``fn`` to lists of column values, a few hundred rows at a time, without a shuffle.

    Arrow hands over up to 10,000 rows; slices keep what is held as Python objects small.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    ship(df.sparkSession)
    out = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                part = batch.slice(at, rows)
                made = fn({name: part.column(i).to_pylist() for i, name in enumerate(part.schema.names)})
                yield pa.RecordBatch.from_arrays([pa.array(made[f.name], f.type) for f in out], schema=out)

    return df.mapInArrow(run, schema)


def id_remainder(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``; null ids count as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % n


def bounded_sample(df: DataFrame, group: str, most: int, *by: str) -> DataFrame:
    """At most ``most`` rows of each group, drawn by a hash of the columns ``by``.

    Groups are counted, which combines before the shuffle; then every row decides alone
    whether its hash is below its group's share, so no group is ever gathered. The expected
    size is ``most``; a last limit by hash, over the few rows left, makes it exact.
    The number of groups must be small (labels, languages): it is checked.
    """
    counts = {r[0]: r[1] for r in df.groupBy(group).count().limit(1001).collect()}
    if len(counts) > 1000:
        raise ValueError(f"more than 1000 values in {group}")
    wide = 1 << 30
    # the other half of the hash than that by which Spark deals rows out
    draw = F.pmod(F.shiftright(F.xxhash64(F.lit("sample"), *by), 20), F.lit(wide))
    shares = [F.when(F.col(group) == F.lit(k), F.lit(int(min(1.0, 1.25 * most / n + 40 / n) * wide))) for k, n in counts.items() if k is not None]
    share = F.coalesce(*shares, F.lit(0)) if shares else F.lit(0)
    return df.where(draw < share).withColumn("_draw", draw)
