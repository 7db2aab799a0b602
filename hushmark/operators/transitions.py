"""State machines over the messages of a conversation or the history of a user."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hushmark.plans.ordered import adjacent_pairs
from hushmark.rules import labels as rules

MISSING = "<null>"
ARROW = " → "


def _move(current: Column, following: Column) -> Column:
    return F.concat(
        F.coalesce(current, F.lit(MISSING)), F.lit(ARROW), F.coalesce(following, F.lit(MISSING))
    )


def _moves(edges: Iterable[tuple[str, str]]) -> list[str]:
    return [a + ARROW + b for a, b in edges]


def state_pairs(
    df: DataFrame,
    group: str,
    state: str,
    order: Sequence[str],
    chunk: Column | None,
    with_next_order: bool = False,
) -> DataFrame:
    """Consecutive states: the row, ``position`` and ``next_<state>``.

    ``with_next_order`` also carries ``next_`` of the order columns.
    """
    columns = list(dict.fromkeys([group, *order, state]))
    carry = [state, *order] if with_next_order else [state]
    return adjacent_pairs(df.select(*columns), [group], order, carry, chunk)


def invalid_transitions(
    df: DataFrame,
    group: str,
    state: str,
    order: Sequence[str],
    chunk: Column | None,
    edges: Mapping[str, Iterable[str]] = rules.STAGE_EDGES,
    allow_self: bool = False,
    gap: tuple[Iterable[tuple[str, str]], Column] | None = None,
) -> DataFrame:
    """Consecutive states without an edge between them.

    Staying in a state needs an edge too, unless ``allow_self``.  A missing state has
    no edges.  ``gap`` names edges that hold only where a condition on the pair does,
    for example ``next_seconds - seconds >= 86400``.  The edge list is part of the
    expression: no join.
    """
    pairs = state_pairs(df, group, state, order, chunk, with_next_order=gap is not None)
    current, following = F.col(state), F.col(f"next_{state}")
    move = _move(current, following)
    allowed = move.isin(*_moves((a, b) for a, targets in edges.items() for b in targets))
    if gap is not None:
        gated, condition = gap
        allowed = allowed & (~move.isin(*_moves(gated)) | F.coalesce(condition, F.lit(False)))
    if allow_self:
        allowed = allowed | F.coalesce(current == following, F.lit(False))
    return pairs.where(~allowed).select(group, "position", move.alias("transition"))


def first_transitions(invalid: DataFrame, group: str, n: int = 5) -> DataFrame:
    """The first few by group and position, for a report."""
    return invalid.orderBy(group, "position").limit(n)
