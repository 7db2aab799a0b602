"""Pattern redaction: narrow projections, no shuffle and no Python in the plan."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce
from operator import add, or_

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hushmark.functions import blank, text_array
from hushmark.rules.pii import DEFAULT_TOKEN, PII_RULES, TOKENS, PiiRule

TEST_COLUMN = "_test_pii_added"


def _replacement(token: str) -> Column:
    """The token, safe as a regex replacement."""
    return F.lit((token or DEFAULT_TOKEN).replace("\\", "\\\\").replace("$", "\\$"))


def may_match(text: Column, rule: PiiRule) -> Column | None:
    """A cheap test that every text with a match passes, where the rule states one."""
    cheap = [F.contains(text, F.lit(s)) for s in rule.needs]
    if rule.needs_digit:
        cheap.append(F.regexp_like(text, F.lit(r"(?U)\d")))
    return reduce(or_, cheap) if cheap else None


def count_matches(text: Column, rule: PiiRule) -> Column:
    """Matches of one rule, behind a cheap test that most texts fail."""
    found = F.regexp_count(text, F.lit(rule.pattern))
    cheap = may_match(text, rule)
    return F.coalesce(found if cheap is None else F.when(cheap, found), F.lit(0))


def replace_matches(text: Column, rule: PiiRule, count: Column) -> Column:
    rewritten = F.regexp_replace(text, F.lit(rule.pattern), _replacement(rule.token))
    return F.when(count > 0, rewritten).otherwise(text)


def count_column(category: str) -> str:
    return f"n_{category}"


def counted_categories(rules: tuple[PiiRule, ...], entities: bool = False) -> list[str]:
    """The categories that totals are made of; entities count as names."""
    found = [r.category for r in rules if r.counted]
    return found if not entities or "name" in found else ["name", *found]


def redact_text(
    df: DataFrame, text: str = "text", rules: tuple[PiiRule, ...] = PII_RULES
) -> DataFrame:
    """Rewrite ``text`` rule by rule and add one ``n_<category>`` count per rule.

    A count is taken on the text as the earlier rules left it.
    """
    others = [c for c in df.columns if c != text]
    step = df.withColumn("_before", F.col(text))
    for rule in rules:
        name = count_column(rule.category)
        step = step.withColumn(name, count_matches(F.col(text), rule))
        step = step.withColumn(text, replace_matches(F.col(text), rule, F.col(name)))
    return step.select(*others, text, "_before", *[count_column(r.category) for r in rules])


def redact_messages(
    df: DataFrame,
    text: str = "text",
    rules: tuple[PiiRule, ...] = PII_RULES,
    entities: str | None = None,
    mentions: str | None = None,
) -> DataFrame:
    """Redact flat messages.

    Adds the per-category counts, ``_anonymized`` (true or null) and
    ``_pii_removed_count`` (over all counted rules, so without url; null when nothing changed).  ``entities``
    names an array of person names found by a model; they are replaced after the
    patterns and counted as names.  Seeded truth is dropped where there was text.
    """
    done = redact_text(df, text, rules)
    if entities is not None:
        done = redact_entities(done, entities, text, "n_entities", mentions)
        name = F.col(count_column("name")) if "n_name" in done.columns else F.lit(0)
        done = done.withColumn("n_name", name + F.col("n_entities")).drop("n_entities")
    counted = [F.col(count_column(c)) for c in counted_categories(rules, entities is not None)]
    changed = F.coalesce(F.col(text) != F.col("_before"), F.lit(False))
    done = done.withColumns(
        {
            "_anonymized": F.when(changed, F.lit(True)),
            "_pii_removed_count": F.when(changed, reduce(add, counted, F.lit(0)).cast("int")),
        }
    )
    if TEST_COLUMN in done.columns:
        done = done.withColumn(TEST_COLUMN, F.when(blank(F.col("_before")), F.col(TEST_COLUMN)))
    return done.drop("_before")


def redact_entities(
    df: DataFrame,
    entities: str,
    text: str = "text",
    count: str = "n_entities",
    mentions: str | None = None,
) -> DataFrame:
    """Replace the names in an array column, longest first.

    ``count`` gets the number of mentions: the ``mentions`` column where the array
    holds distinct names, else the length of the array.
    """
    rewritten = replace_entities(F.col(text), F.col(entities))
    present = F.col(entities).isNotNull() & ~blank(F.col(text))
    seen = F.array_size(entities) if mentions is None else F.col(mentions)
    return df.withColumns(
        {
            count: F.when(present, seen).otherwise(0).cast("int"),
            text: F.when(present, rewritten).otherwise(F.col(text)),
        }
    )


def replace_entities(text: Column, entities: Column) -> Column:
    """The text with every given name replaced, the longest first."""
    longest_first = F.array_sort(entities, lambda a, b: F.length(b) - F.length(a))
    token = F.lit(TOKENS["name"])
    return F.aggregate(
        longest_first,
        text,
        lambda acc, name: F.when(name == "", acc).otherwise(F.replace(acc, name, token)),
    )


def listed_entities(text: str, names: Iterable[str]) -> Column:
    """Those of a fixed list of names that occur in the text: an array for ``redact_entities``."""
    return F.filter(text_array(names), lambda name: F.contains(F.col(text), name))


def attach_entities(
    messages: DataFrame, found: DataFrame, key: str, entity: str = "entity"
) -> DataFrame:
    """Add ``entities`` (distinct names) and ``n_mentions`` from (key, entity) mentions.

    Mentions are counted per distinct name before names are gathered.  Names come
    from the message's own text, so a list holds no more than its text does.
    """
    per_name = (
        found.where(F.col(entity).isNotNull())
        .groupBy(key, entity)
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    lists = per_name.groupBy(key).agg(
        F.array_sort(F.collect_list(entity)).alias("entities"),
        F.sum("_n").cast("int").alias("n_mentions"),
    )
    return messages.join(lists, key, "left")


def redact_nested(
    conversations: DataFrame,
    messages: str = "messages",
    rules: tuple[PiiRule, ...] = PII_RULES,
    counts: bool = False,
    entities: str | None = None,
) -> DataFrame:
    """Redact nested conversations in place; every other field stays as it is.

    Each pattern runs once per message, and rows stay where they are.  ``entities`` names
    a message field with an array of person names; they are replaced after the patterns and
    counted as names.  ``counts`` adds ``n_<category>`` and ``_pii_removed_count`` per conversation.
    """
    names = [count_column(rule.category) for rule in rules]
    fields = message_fields(conversations, messages)
    if entities is not None and entities not in fields:
        raise ValueError(f"messages have no field {entities}")
    if entities is not None and "n_name" not in names:
        names = ["n_name", *names]
    if "text" not in fields:
        zeros = [*names, "_pii_removed_count"] if counts else []
        return conversations.withColumns({c: F.lit(0) for c in zeros})

    # the steps carry text and counts alone; the messages come back in once, at the end
    state = F.transform(F.col(messages), lambda m: F.struct(m["text"].alias("text")))
    done: list[str] = []
    for rule in rules:
        name = count_column(rule.category)
        state = F.transform(state, _nested_count(rule, tuple(done)))
        done.append(name)
        state = F.transform(state, _nested_replace(rule, tuple(done)))
    if entities is not None:
        state = F.zip_with(F.col(messages), state, _nested_entities(entities, tuple(done)))
        done = names

    step = conversations.withColumn("_state", state)
    counted = [count_column(c) for c in counted_categories(rules, entities is not None)]
    step = step.withColumn(
        messages,
        F.zip_with(F.col(messages), F.col("_state"), lambda m, s: _nested_result(m, s, fields, counted)),
    )
    if counts:
        for name in done:
            step = step.withColumn(name, _array_sum(F.col(f"_state.{name}")))
        total = reduce(add, [F.col(c) for c in counted], F.lit(0))
        step = step.withColumn("_pii_removed_count", total)
    return step.drop("_state")


def _nested_entities(entities: str, done: tuple[str, ...]) -> Callable[[Column, Column], Column]:
    def step(message: Column, s: Column) -> Column:
        names, text = message[entities], s["text"]
        present = names.isNotNull() & ~blank(text)
        own = F.when(present, F.size(names)).otherwise(0)
        before = s["n_name"] if "n_name" in done else F.lit(0)
        others = [s[c].alias(c) for c in done if c != "n_name"]
        return F.struct(
            F.when(present, replace_entities(text, names)).otherwise(text).alias("text"),
            (before + own).alias("n_name"),
            *others,
        )

    return step


def _array_sum(values: Column) -> Column:
    added = F.aggregate(values, F.lit(0), lambda total, n: total + n)
    return F.coalesce(added, F.lit(0))


def _nested_count(rule: PiiRule, done: tuple[str, ...]) -> Callable[[Column], Column]:
    def step(s: Column) -> Column:
        found = count_matches(s["text"], rule).alias(count_column(rule.category))
        return F.struct(*[s[c].alias(c) for c in ("text", *done)], found)

    return step


def _nested_replace(rule: PiiRule, done: tuple[str, ...]) -> Callable[[Column], Column]:
    def step(s: Column) -> Column:
        text = replace_matches(s["text"], rule, s[count_column(rule.category)])
        counts = [s[c].alias(c) for c in done]
        return F.struct(text.alias("text"), *counts)

    return step


def _nested_result(message: Column, s: Column, fields: list[str], counted: list[str]) -> Column:
    changed = F.coalesce(s["text"] != message["text"], F.lit(False))
    total = reduce(add, [s[c] for c in counted], F.lit(0))
    result = (
        message.withField("text", s["text"])
        .withField("_anonymized", F.when(changed, F.lit(True)))
        .withField("_pii_removed_count", F.when(changed, total))
    )
    if TEST_COLUMN in fields:
        kept = F.when(blank(message["text"]), message[TEST_COLUMN])
        result = result.withField(TEST_COLUMN, kept)
    return result


def statistics(redacted: DataFrame, *by: str, rules: tuple[PiiRule, ...] = PII_RULES) -> DataFrame:
    """Removed items per category and in total, per group, over the counted ones of ``rules``."""
    present = [c for c in counted_categories(rules, True) if count_column(c) in redacted.columns]
    sums = {c: F.coalesce(F.sum(count_column(c)), F.lit(0)).cast("bigint") for c in present}
    total = F.coalesce(F.sum("_pii_removed_count"), F.lit(0)).cast("bigint")
    return redacted.groupBy(*by).agg(
        *[sums[c].alias(f"{c}_removed") for c in present], total.alias("total_removed")
    )


def observe_statistics(
    redacted: DataFrame, name: str = "redaction", rules: tuple[PiiRule, ...] = PII_RULES
) -> tuple[DataFrame, Observation]:
    """The same totals over the whole run, measured while the result is written."""
    seen = Observation(name)
    present = [c for c in counted_categories(rules, True) if count_column(c) in redacted.columns]
    observed = redacted.observe(
        seen,
        F.count(F.lit(1)).alias("messages"),
        *[F.sum(count_column(c)).alias(f"{c}_removed") for c in present],
        F.sum("_pii_removed_count").alias("total_removed"),
    )
    return observed, seen


def message_fields(conversations: DataFrame, messages: str = "messages") -> list[str]:
    """Field names of the messages; none when the array holds no structs (all empty)."""
    kind = conversations.schema[messages].dataType
    element = kind.elementType if isinstance(kind, T.ArrayType) else None
    return element.fieldNames() if isinstance(element, T.StructType) else []
