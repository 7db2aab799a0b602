"""Small text expressions shared by the operators."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from hushmark.rules import pii, review, seeding


def blank(text: Column) -> Column:
    """True for null or empty text."""
    return F.coalesce(text, F.lit("")) == ""


def contains_any(text: Column, needles: Iterable[str]) -> Column:
    return reduce(or_, [F.contains(text, F.lit(n)) for n in needles], F.lit(False))


def whole_words(text: Column, words: Iterable[str]) -> Column:
    """True when one of the words or phrases occurs as whole words, in any case."""
    words = tuple(words)
    if not words:
        return F.lit(False)
    pattern = pii.FLAGS + pii.OPEN + pii.any_of(words) + pii.CLOSE
    return F.coalesce(F.regexp_like(text, F.lit(pattern)), F.lit(False))


def matches_labels(condition: Mapping[str, Iterable[str]]) -> Column:
    """True when every named column holds one of its labels; null never matches."""
    tests = [F.col(column).isin(*labels) for column, labels in condition.items()]
    return F.coalesce(reduce(and_, tests), F.lit(False))


def guess_language(text: Column) -> Column:
    """``es`` when at least two indicator substrings occur, else ``en``."""
    low = F.lower(text)
    hits = [F.contains(low, F.lit(w)).cast("int") for w in seeding.SPANISH_INDICATORS]
    return F.when(sum(hits[1:], hits[0]) >= seeding.SPANISH_AT_LEAST, "es").otherwise("en")


def sentence_count(text: Column) -> Column:
    """Pieces between sentence marks; an empty last piece counts, as in ``A. B.`` -> 3."""
    return F.array_size(F.split(text, review.SENTENCE_BREAK, -1))


def emoji_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(review.EMOJI))


def question_marks(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit("?"), F.lit("")))


def issue_type(code: Column) -> Column:
    """The part of a reason code before the first colon."""
    return F.split_part(code, F.lit(":"), F.lit(1))


def percent(share: Column) -> Column:
    """A share as text with one decimal, ties to even."""
    return F.format_string("%.1f%%", F.bround(share * 100, 1))


def bar(share: Column) -> Column:
    """Up to 20 blocks for a share between 0 and 1."""
    return F.repeat(F.lit("█"), (share * 20).cast("int"))
