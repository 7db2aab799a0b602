"""Shape of a corpus of JSON documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hushmark.plans.once import evaluate_once

ROOT = "$"


def kind(value: Column) -> Column:
    """object, array, string, int, float, bool or null, for a variant value."""
    name = F.schema_of_variant(value)
    return (
        F.when(name.isNull() | (name == "VOID"), "null")
        .when(F.startswith(name, F.lit("OBJECT")), "object")
        .when(F.startswith(name, F.lit("ARRAY")), "array")
        .when(name == "STRING", "string")
        .when(name == "BIGINT", "int")
        .when(name == "BOOLEAN", "bool")
        .otherwise("float")
    )


def _elements(value: Column) -> Column:
    return F.try_variant_get(value, "$", "array<variant>")


def _members(value: Column) -> Column:
    return F.try_variant_get(value, "$", "map<string,variant>")


def parsed(df: DataFrame, json: str, *keep: str) -> DataFrame:
    """Kept columns, ``root`` as variant and ``root_kind``; malformed text is ``invalid``."""
    docs = evaluate_once(df.select(*keep, json), F.try_parse_json(json).alias("root"))
    found = F.when(F.col("root").isNull(), "invalid").otherwise(kind(F.col("root")))
    return docs.select(*keep, "root", found.alias("root_kind"))


def members(df: DataFrame, json: str, *keep: str) -> DataFrame:
    """One row per top-level key of an object, or one row ``$`` for any other root.

    With the kind of its value, and for lists the ``length``, the kind of the first
    element, and for objects the ``inner_keys``.
    """
    docs = parsed(df, json, *keep).where("root is not null")
    own = F.when(F.col("root_kind") == "object", _members(F.col("root"))).otherwise(
        F.create_map(F.lit(ROOT), F.col("root"))
    )
    rows = docs.select(*keep, F.explode(own).alias("key", "value"))
    rows = evaluate_once(rows, kind(F.col("value")).alias("kind"))
    rows = evaluate_once(
        rows, F.when(F.col("kind") == "array", _elements(F.col("value"))).alias("_items")
    )
    first = F.try_element_at("_items", F.lit(1))
    inner = F.when(F.col("kind") == "object", F.col("value")).when(F.array_size("_items") > 0, first)
    return rows.select(
        *keep, "key", "value", "kind",
        F.array_size("_items").alias("length"),
        F.when(F.array_size("_items") > 0, kind(first)).alias("first_kind"),
        F.map_keys(_members(inner)).alias("inner_keys"),
    )


def root_profile(df: DataFrame, json: str) -> DataFrame:
    """Documents per kind of root."""
    return parsed(df, json).groupBy("root_kind").agg(F.count(F.lit(1)).alias("n"))


def key_profile(df: DataFrame, json: str) -> DataFrame:
    """Per key and kind of value: documents, list lengths, and kind of the first element."""
    return members(df, json).groupBy("key", "kind", "first_kind").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("length").alias("min_length"),
        F.max("length").alias("max_length"),
    )


def inner_key_profile(df: DataFrame, json: str) -> DataFrame:
    """Keys of nested objects, and of the first element of lists of objects."""
    return (
        members(df, json)
        .select("key", F.explode("inner_keys").alias("inner_key"))
        .groupBy("key", "inner_key")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def key_samples(df: DataFrame, json: str, order: str, n: int = 2) -> DataFrame:
    """The first ``n`` values of each key, as JSON text, by an order column."""
    first = Window.partitionBy("key").orderBy(order)
    ranked = (
        members(df, json, order)
        .select(order, "key", "value")
        .withColumn("sample", F.row_number().over(first))
        .where(F.col("sample") <= n)
    )
    return ranked.withColumn("value", F.to_json("value"))
