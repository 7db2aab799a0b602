"""Repeatable draws.

``rand()`` changes when a lost task is run again; a draw hashed from the row's own
key gives the same answer on every attempt, on every layout.

Fixed lists go in as one SQL expression: built value by value, a long list costs more
driver time than the query.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def quoted(value: str | None) -> str:
    """A SQL string literal."""
    if value is None:
        return "cast(null as string)"
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def text_array(values: Iterable[str | None]) -> Column:
    """An array of constants."""
    return F.expr("array(" + ", ".join(quoted(v) for v in values) + ")")


def draw(n: int, salt: str, *keys: str) -> Column:
    """Uniform integer in ``[0, n)`` from the key columns and a salt."""
    parts = ", ".join([f"cast(`{k}` as string)" for k in keys] + [quoted(salt)])
    return F.expr(f"cast(conv(substring(md5(concat_ws('|', {parts})), 1, 8), 16, 10) as bigint) % {n}")


def draw_of(n: int, salt: str, key: Column) -> Column:
    """The same draw from a key that is one column of text, its parts joined by bars."""
    digest = F.md5(F.concat_ws("|", key, F.lit(salt)))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % n


def digits_of(salt: str, key: Column) -> Column:
    """32 drawn digits."""
    return F.translate(F.md5(F.concat_ws("|", key, F.lit(salt))), "abcdef", "012345")


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, for places where no column can be added."""
    return F.element_at(F.transform(F.array(value), use), 1)


def pick(values: Sequence[str | None], index: Column) -> Column:
    """The value at a 0-based index of a fixed list."""
    return F.element_at(text_array(values), (index + 1).cast("int"))
