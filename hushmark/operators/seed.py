"""Seeding messages with fake personal data of known truth."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hushmark.functions import blank, digits_of, draw_of, guess_language, let, pick
from hushmark.operators.redact import TEST_COLUMN, message_fields
from hushmark.plans.once import evaluate_once
from hushmark.rules import seeding
from hushmark.rules.pii import NAME_BANK

MEDIA = ("has_photo", "has_gif")
#: From a row's language and key to a value.
Generator = Callable[[Column, Column], Column]


def eligible(df: DataFrame, text: str = "text") -> Column:
    """Text is there, and the message carries neither photo nor animation."""
    return _eligible(F.col(text), [F.col(flag) for flag in MEDIA if flag in df.columns])


def _eligible(text: Column, media: Sequence[Column]) -> Column:
    free = ~blank(text)
    for flag in media:
        free = free & ~F.coalesce(flag, F.lit(False))
    return free


def fill(form: str, salt: str, key: Column) -> Column:
    """A form with its digits and words drawn."""
    digits, at, words, parts = digits_of(salt, key), 1, 0, []
    for part in re.findall(r"#+|\{word\}|[^#{]+", form):
        if part[0] == "#":
            parts.append(F.substring(digits, at, len(part)))
            at += len(part)
        elif part == "{word}":
            parts.append(pick(seeding.WORDS, draw_of(len(seeding.WORDS), f"{salt}-word{words}", key)))
            words += 1
        else:
            parts.append(F.lit(part))
    return F.concat(*parts)


def from_forms(slot: str, forms: Sequence[str]) -> Generator:
    """A drawn one of the forms, filled."""

    def value(lang: Column, key: Column) -> Column:
        which = draw_of(len(forms), slot, key)
        return F.coalesce(*[F.when(which == i, fill(f, slot, key)) for i, f in enumerate(forms)])

    return value


def _name(lang: Column, key: Column) -> Column:
    one = [pick(NAME_BANK, draw_of(len(NAME_BANK), f"name{i}", key)) for i in (1, 2)]
    return F.concat(one[0], F.lit(" "), one[1])


def _address(lang: Column, key: Column) -> Column:
    forms = seeding.ADDRESS_FORMS.items()
    return F.coalesce(*[F.when(lang == code, from_forms("address", f)(lang, key)) for code, f in forms])


GENERATORS: dict[str, Generator] = {
    "name": _name,
    **{slot: from_forms(slot, forms) for slot, forms in seeding.FORMS.items()},
    "address": _address,
}


def _choices(text: Column, key: Column) -> list[Column]:
    """Language and template of a message that is seeded."""
    template = draw_of(len(seeding.TEMPLATES), "template", key)
    return [guess_language(text).alias("seed_lang"), template.alias("seed_template")]


def _values(lang: Column, template: Column, key: Column, generators: Mapping[str, Generator]) -> list[Column]:
    """A value for each slot that the template has, else null."""
    found = []
    for slot in seeding.TRUTH_FIELDS:
        having = [i for i, chosen in enumerate(seeding.TEMPLATES) if slot in chosen]
        found.append(F.when(template.isin(having), generators[slot](lang, key)).alias(slot))
    return found


def _written(text: Column, lang: Column, key: Column, value: Callable[[str], Column]) -> Column:
    """The text with its values, before or after."""
    carried = []
    for slot in seeding.TRUTH_FIELDS:
        phrase = F.coalesce(*[F.when(lang == code, c[slot]) for code, c in seeding.CARRIERS.items()])
        carried.append(F.concat(phrase, value(slot)))
    added = F.concat_ws(seeding.JOIN, *carried)
    before = draw_of(2, "side", key) == 0
    return F.when(before, F.concat(added, F.lit(". "), text)).otherwise(F.concat(text, F.lit(" "), added))


def _truth(value: Callable[[str], Column]) -> Column:
    fields = seeding.TRUTH_FIELDS.items()
    return F.struct(*[F.array_compact(F.array(value(slot))).alias(field) for slot, field in fields])


def seed_messages(
    df: DataFrame,
    keys: Sequence[str],
    text: str = "text",
    percent: int = seeding.SEED_PERCENT,
    generators: Mapping[str, Generator] = GENERATORS,
) -> DataFrame:
    """Add fake personal data to ``percent`` of the eligible messages.

    A drawn template says which slots are filled; each gets a generated value behind its
    carrier phrase in the message's language, before or after the text.
    ``_test_pii_added`` records what was added, null elsewhere; ``seeded``,
    ``seed_lang`` and ``seed_template`` say where and how.  All choices are drawn from
    ``keys``, so they do not change when a task runs again.
    """
    key = F.concat_ws("|", *[F.col(k).cast("string") for k in keys])
    hit = eligible(df, text) & (draw_of(100, "hit", key) < percent)
    step = df.withColumn("seeded", hit)
    step = evaluate_once(
        step,
        *[F.when(F.col("seeded"), c).alias(n) for c, n in zip(_choices(F.col(text), key), ("seed_lang", "seed_template"), strict=True)],
    )
    lang = F.col("seed_lang")
    values = _values(lang, F.col("seed_template"), key, generators)
    step = evaluate_once(step, F.struct(*values).alias("_values"))

    def value(slot: str) -> Column:
        return F.col(f"_values.{slot}")

    others = [c for c in df.columns if c not in (text, TEST_COLUMN)]
    written = _written(F.col(text), lang, key, value)
    return step.select(
        *others,
        F.when(F.col("seeded"), written).otherwise(F.col(text)).alias(text),
        F.when(F.col("seeded"), _truth(value)).alias(TEST_COLUMN),
        "seeded",
        "seed_lang",
        "seed_template",
    )


def seed_nested(
    conversations: DataFrame,
    keys: Sequence[str] | None = None,
    messages: str = "messages",
    percent: int = seeding.SEED_PERCENT,
    generators: Mapping[str, Generator] = GENERATORS,
) -> DataFrame:
    """Seed nested conversations in place: same rows, same fields, and the truth in each message.

    Draws come from ``keys`` and the message's position; without keys, from the whole content
    of the conversation, so conversations need no id.  Nothing is shuffled.
    """
    fields = message_fields(conversations, messages)
    if "text" not in fields:
        raise ValueError(f"no text in {messages}")
    own = [F.col(k).cast("string") for k in keys] if keys else [F.md5(F.to_json(F.struct(*conversations.columns)))]
    step = conversations.withColumn("_key", F.concat_ws("|", *own))
    first = F.col("pos_offset") if "pos_offset" in conversations.columns else F.lit(0)
    truth_type = "struct<" + ",".join(f"{f}:array<string>" for f in seeding.TRUTH_FIELDS.values()) + ">"

    def one(message: Column, i: Column) -> Column:
        text, key = message["text"], F.concat_ws("|", F.col("_key"), (i + first).cast("string"))
        hit = _eligible(text, [message[f] for f in MEDIA if f in fields]) & (draw_of(100, "hit", key) < percent)

        def filled(c: Column) -> Column:
            lang = c["seed_lang"]

            def put(v: Column) -> Column:
                written = _written(text, lang, key, lambda slot: v[slot])
                return message.withField("text", written).withField(TEST_COLUMN, _truth(lambda slot: v[slot]).cast(truth_type))

            return let(F.struct(*_values(lang, c["seed_template"], key, generators)), put)

        return F.when(hit, let(F.struct(*_choices(text, key)), filled)).otherwise(
            message.withField(TEST_COLUMN, F.lit(None).cast(truth_type))
        )

    return step.withColumn(messages, F.transform(messages, one)).drop("_key")


def only_seeded(df: DataFrame) -> DataFrame:
    """Seeded rows; by the flag where it is kept, else by the recorded truth."""
    return df.where(F.col("seeded") if "seeded" in df.columns else F.col(TEST_COLUMN).isNotNull())


def per_value(
    fields: Sequence[str], entry: Callable[[str], Callable[[Column], Column]]
) -> Column:
    """One array over all seeded values of a row, each turned into a struct."""
    arrays = [F.transform(F.col(f"{TEST_COLUMN}.{f}"), entry(f)) for f in fields]
    return F.flatten(F.array(*arrays))


def seeded_values(df: DataFrame, *keep: str) -> DataFrame:
    """One row per seeded value: the kept columns, ``category`` and ``value``."""
    fields = df.schema[TEST_COLUMN].dataType.fieldNames()

    def entry(field: str) -> Callable[[Column], Column]:
        return lambda v: F.struct(F.lit(field).alias("category"), v.alias("value"))

    return only_seeded(df).select(*keep, F.inline(per_value(fields, entry)))


def seeding_totals(
    df: DataFrame,
    by: str,
    *more: str,
    conversation: str | None = None,
    position: str | None = None,
) -> DataFrame:
    """Conversations, messages, seeded messages and their share, and distinct values, per group.

    Conversations are counted by distinct ``conversation`` ids, or, on the rows of
    ``messages.flatten``, by their first ``position`` (no ids needed; a row without
    position is a conversation without messages).
    """
    groups = [by, *more]
    fields = df.schema[TEST_COLUMN].dataType.fieldNames()
    seeded = F.count_if(F.col(TEST_COLUMN).isNotNull())
    if position is not None:
        conversations = F.count_if(F.coalesce(F.col(position), F.lit(0)) == 0)
        number = F.count(position)
    else:
        conversations = F.count_distinct(conversation)
        number = F.count(F.lit(1))
    totals = df.groupBy(*groups).agg(
        conversations.alias("conversations"),
        number.alias("messages"),
        seeded.alias("messages_seeded"),
        F.when(number > 0, seeded * 100.0 / number).alias("percent_seeded"),
    )
    distinct = seeding_details(df, *groups).groupBy(*groups).agg(
        *[F.count_if(F.col("category") == f).alias(f"distinct_{f}") for f in fields]
    )
    return totals.join(distinct, groups, "left").select(
        *totals.columns, *[F.coalesce(f"distinct_{f}", F.lit(0)).alias(f"distinct_{f}") for f in fields]
    )


def seeding_details(df: DataFrame, *by: str) -> DataFrame:
    """The distinct seeded values and how often each was used, per group."""
    return (
        seeded_values(df, *by)
        .groupBy(*by, "category", "value")
        .agg(F.count(F.lit(1)).alias("uses"))
    )
