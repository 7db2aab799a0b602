"""From nested conversations to message rows and back."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hushmark.functions import blank
from hushmark.rules import guidelines


def flatten(conversations: DataFrame, messages: str = "messages") -> DataFrame:
    """One row per message with its 0-based ``pos`` in the whole conversation.

    Conversations without messages stay as one row with a null ``message``.  On the rows
    of ``nest`` the positions run on from part to part.
    """
    others = [c for c in conversations.columns if c not in (messages, "pos_offset")]
    first = F.col("pos_offset") if "pos_offset" in conversations.columns else F.lit(0)
    flat = conversations.select(
        *others, first.alias("_first"), F.posexplode_outer(messages).alias("pos", "message")
    )
    return flat.withColumn("pos", F.col("pos").cast("bigint") + F.col("_first")).drop("_first")


def nest(
    messages: DataFrame,
    keys: list[str],
    order: str = "pos",
    message: str = "message",
    part_size: int = 10_000,
) -> DataFrame:
    """Message rows back to conversations, at most ``part_size`` messages a row.

    ``order`` is the position in the conversation.  A longer conversation continues
    in rows with ``part`` 1, 2, ..., so no task ever gathers a whole hot one.  Parts are
    a layout and change no result: each row tells the conversation's ``n_messages`` and, as
    ``pos_offset``, how many stand in earlier parts.  ``part = 0`` is there once for each.
    """
    part = F.floor(F.coalesce(F.col(order), F.lit(0)) / part_size).cast("int")
    slots = F.array_sort(F.collect_list(F.when(F.col(order).isNotNull(), F.struct(order, message))))
    cut = messages.select(*keys, order, message, part.alias("part"))
    parts = cut.groupBy(*keys, "part").agg(slots.alias("_slots"))
    # one small row per part tells what stands around it
    whole = Window.partitionBy(*keys)
    before = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = cut.groupBy(*keys, "part").agg(F.count(order).alias("_n")).select(
        *[F.col(k).alias(f"_key_{k}") for k in keys],
        F.col("part").alias("_part"),
        F.sum("_n").over(whole).alias("n_messages"),
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("pos_offset"),
    )
    same = reduce(
        and_, [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys], F.col("part") == F.col("_part")
    )
    return parts.join(sizes, same).select(
        *keys, "part", "n_messages", "pos_offset", F.col(f"_slots.{message}").alias("messages")
    )


def with_text(messages: DataFrame, text: str = "text") -> DataFrame:
    """Only messages that have text."""
    return messages.where(~blank(F.col(text)))


def within_length(
    messages: DataFrame,
    key: str,
    low: int = guidelines.MIN_MESSAGES,
    high: int = guidelines.MAX_MESSAGES,
) -> DataFrame:
    """Messages of conversations that have ``low`` to ``high`` messages.

    Conversations are counted, which combines before the shuffle, and the messages of
    those that pass are kept by a semi join.  Rows without a key drop out.
    """
    fitting = (
        messages.groupBy(F.col(key).alias("_key"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .where(F.col("_key").isNotNull() & F.col("_n").between(low, high))
    )
    return messages.join(fitting, F.col(key) == F.col("_key"), "left_semi")


def nested_within_length(
    conversations: DataFrame,
    low: int = guidelines.MIN_MESSAGES,
    high: int = guidelines.MAX_MESSAGES,
    messages: str = "messages",
) -> DataFrame:
    """The same test on nested conversations: a plain filter on the whole conversation's length."""
    return conversations.where(n_messages(conversations, messages).between(low, high))


def n_messages(conversations: DataFrame, messages: str = "messages") -> Column:
    """Messages of the whole conversation, whichever part of it a row holds."""
    return F.col("n_messages") if "n_messages" in conversations.columns else F.array_size(messages)


def first_samples(messages: Column | str, n: int = 2) -> Column:
    """The first ``n`` elements of an array."""
    return F.slice(messages, 1, n)
