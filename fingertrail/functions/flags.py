"""Column expressions over flag lists and their comma-joined text form."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Of two contradicting flags the first stays.
CONFLICTS = [
    ("multiple_end_events", "missing_Ended"),
    ("multiple_end_events", "missing_E"),
    ("sequence_interrupted", "multiple_end_events"),
    ("orphaned_events", "missing_Began"),
    ("orphaned_events", "missing_B"),
    ("sequence_interrupted", "missing_Ended"),
    ("sequence_interrupted", "missing_E"),
]
# Pairs named by the contradiction report, in report order.
CONTRADICTIONS = [
    ("missing_Ended", "multiple_end_events"),
    ("missing_E", "multiple_end_events"),
    ("sequence_interrupted", "multiple_end_events"),
    ("orphaned_events", "missing_Began"),
    ("orphaned_events", "missing_B"),
    ("sequence_interrupted", "missing_Ended"),
    ("sequence_interrupted", "missing_E"),
]
# Text fragments that assign a flag to a kind of anomaly.
TECHNICAL_PARTS = ["missing_began", "missing_ended", "improper_sequence_order", "orphaned_events",
                   "multiple_end_events", "unterminated"]
SPATIAL_PARTS = ["zero_distance", "phantom_move", "overlapping_fingerids"]
BEHAVIORAL_PARTS = ["has_canceled", "too_few_points", "short_duration"]


def resolve_conflicts(flags: Column) -> Column:
    """Drop the weaker flag of each contradicting pair.

    No flag that wins a pair has been dropped by an earlier one, so all pairs can be judged on the
    list as it came.
    """
    def loses(flag):
        lost = F.lit(False)
        for keep, drop in CONFLICTS:
            lost = lost | ((flag == drop) & F.array_contains(flags, keep))
        return lost
    return F.filter(flags, lambda flag: ~loses(flag))


def join_flags(flags: Column) -> Column:
    return F.array_join(flags, ",")


def parse_flags(text: Column) -> Column:
    """Flag names of a joined text; null, empty and 'nan' hold none."""
    names = F.transform(F.split(text, ","), lambda name: F.trim(name))
    found = F.filter(names, lambda n: n != "")
    return F.when(text.isNull() | text.isin("", "nan"), F.array().cast("array<string>")).otherwise(found)


def contradictions(flags: Column) -> Column:
    """Names of contradicting pairs, as ``a + b``."""
    return F.array_compact(F.array(*[
        F.when(F.array_contains(flags, a) & F.array_contains(flags, b), F.lit(f"{a} + {b}"))
        for a, b in CONTRADICTIONS]))


def contains_text(text: Column, part: str) -> Column:
    """Plain substring test: ``missing_E`` is also found in ``missing_Ended``."""
    return F.coalesce(F.instr(text, part) > 0, F.lit(False))


def anomaly_kind(text: Column) -> Column:
    """Kind of anomaly behind a flag text."""
    lower = F.lower(text)

    def has(parts):
        found = F.lit(False)
        for part in parts:
            found = found | contains_text(lower, part)
        return found

    return (F.when(F.coalesce(text, F.lit("")) == "", "None")
            .when(has(TECHNICAL_PARTS), "Technical").when(has(SPATIAL_PARTS), "Spatial")
            .when(has(BEHAVIORAL_PARTS), "Behavioral").otherwise("Technical"))
