"""Column expressions over touch phases."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_phase(*names: str, column: str = "touchPhase") -> Column:
    """True for these phases; a missing phase is none of them."""
    return F.coalesce(F.col(column).isin(*names), F.lit(False))


def any_phase(*names: str) -> Column:
    """Aggregate: does the group hold one of these phases?"""
    return F.max(is_phase(*names))


def count_phase(*names: str) -> Column:
    return F.count_if(is_phase(*names))


def pattern_parts(order: Column) -> dict[str, Column]:
    """Aggregates that decide both pattern checks; all of them combine map-side."""
    return {
        "_n": F.count(F.lit(1)),
        "_first": F.min_by("touchPhase", order),
        "_last": F.max_by("touchPhase", order),
        "_moves": count_phase("Moved", "Stationary"),
        "_cancels": count_phase("Canceled"),
        "_last_move": F.max(F.when(is_phase("Moved", "Stationary"), order)),
        "_cancel_at": F.max(F.when(is_phase("Canceled"), order)),
    }


PATTERN_PARTS = ["_n", "_first", "_last", "_moves", "_cancels", "_last_move", "_cancel_at"]


def loose_pattern() -> Column:
    """Began, then moves or stops with at most one cancel anywhere, then Ended."""
    return F.coalesce(
        (F.col("_n") >= 2) & (F.col("_first") == "Began") & (F.col("_last") == "Ended")
        & (F.col("_moves") + F.col("_cancels") == F.col("_n") - 2) & (F.col("_cancels") <= 1),
        F.lit(False))


def strict_pattern() -> Column:
    """As the loose pattern, and a cancel stands directly before the end."""
    cancel_last = ((F.col("_cancels") == 0) | F.col("_last_move").isNull()
                   | (F.col("_last_move") < F.col("_cancel_at")))
    return loose_pattern() & F.coalesce(cancel_last, F.lit(False))


def flag_if(condition: Column, name: str) -> Column:
    return F.when(condition, F.lit(name))


def flag_list(parts: Sequence[Column]) -> Column:
    """Names whose condition holds, in the given order."""
    return F.array_compact(F.array(*parts))
