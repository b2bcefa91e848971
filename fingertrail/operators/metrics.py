"""One row of metrics per sequence, and the pattern checks per touch."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fingertrail.functions.phases import (any_phase, is_phase, loose_pattern, pattern_parts,
                                          strict_pattern)
from fingertrail.operators.groups import Touches
from fingertrail.operators.segment import SEQUENCE
from fingertrail.schema import time_order

TOUCH = ["session_id", "Touchdata_id"]


def compute_sequence_metrics(touches: Touches) -> DataFrame:
    """Coloring metrics by (session, finger, seqId), seqId 0 included.

    The end is the last ``Ended``. A session with ``S`` and no ``Ended`` ends by ``S``; a group
    without ``Ended`` in a session that has both (or neither) falls back to its last ``S``.
    """
    rows = touches.totals(["session_id"], _any_ended=any_phase("Ended"), _any_s=any_phase("S"))
    table = rows.aggregate(
        SEQUENCE,
        startTime=F.min("time"),
        _ended=F.max(F.when(is_phase("Ended"), F.col("time"))),
        _s=F.max(F.when(is_phase("S"), F.col("time"))),
        _only_ended=F.max(F.col("_any_ended") & ~F.col("_any_s")),
        nPoints=F.count(F.lit(1)),
        hasCanceled=any_phase("Canceled"))
    end = F.when(F.col("_only_ended"), F.col("_ended")).otherwise(F.coalesce("_ended", "_s"))
    return table.select(*SEQUENCE, "startTime", end.alias("endTime"),
                        (end - F.col("startTime")).alias("durationSec"), "nPoints", "hasCanceled")


def compute_tracing_metrics(touches: Touches) -> DataFrame:
    """Tracing metrics by (session, finger, seqId)."""
    table = touches.aggregate(
        SEQUENCE,
        startTime=F.min("time"),
        endTime=F.max(F.when(is_phase("E"), F.col("time"))),
        nPoints=F.count(F.lit(1)),
        totalDistance=F.coalesce(F.sum("distance"), F.lit(0.0)),
        hasOrphanedFinger=F.max("ORPHANED_FINGER"),
        isUnterminated=F.max("UNTERMINATED"),
        hasOverlappingFingers=F.max("OVERLAPPING_FINGERIDS"),
        hasPhantomMove=F.max("PHANTOM_MOVE"))
    return table.select(
        *SEQUENCE, "startTime", "endTime", (F.col("endTime") - F.col("startTime")).alias("durationSec"),
        "nPoints", "totalDistance", "hasOrphanedFinger", "isUnterminated", "hasOverlappingFingers",
        "hasPhantomMove")


def _pattern_table(touches: Touches, keys: list[str], order: list[str], rule, name: str) -> DataFrame:
    position = F.struct(*order)
    rows = touches.filter(F.col(keys[-1]).isNotNull())
    return rows.aggregate(keys, **pattern_parts(position)).select(*keys, rule().alias(name))


def validate_touch_patterns(touches: Touches) -> DataFrame:
    """Strict check of every touch, its events ordered by ``event_index``."""
    return _pattern_table(touches, TOUCH, ["event_index"], strict_pattern, "is_valid")


def validate_sequence_patterns(touches: Touches) -> DataFrame:
    """Strict check of every segmented sequence, ordered by time: the form for data without touch ids."""
    rows = touches.filter(F.col("seqId") > 0)
    return _pattern_table(rows, SEQUENCE, time_order(touches.columns), strict_pattern, "is_valid")


def check_loose_patterns(touches: Touches) -> DataFrame:
    """Loose check of every touch: at most one cancel, anywhere in the middle."""
    return _pattern_table(touches, TOUCH, ["event_index"], loose_pattern, "sequence_valid_pattern")
