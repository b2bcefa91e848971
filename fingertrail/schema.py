"""Columns of touch events and the fixed vocabularies of phases, flags and labels."""

from __future__ import annotations

from pyspark.sql import types as T

# Phase names of the two recording types.
COLORING_PHASES = ["Began", "Moved", "Stationary", "Ended", "Canceled"]
TRACING_PHASES = ["B", "M", "S", "E"]

# Flag names.
COLORING_RULE_FLAGS = ["missing_Began", "missing_Ended", "sequence_gap", "short_duration",
                       "too_few_points", "has_canceled"]
TRACING_RULE_FLAGS = ["missing_B", "missing_E", "invalid_TouchPhase", "zero_distance", "time_gap"]
COMPLETENESS_FLAGS = ["sequence_interrupted", "orphaned_events", "multiple_end_events",
                      "improper_sequence_order"]
TRACING_ROW_FLAGS = ["ORPHANED_FINGER", "UNTERMINATED", "OVERLAPPING_FINGERIDS", "PHANTOM_MOVE"]
ALL_FLAGS = COLORING_RULE_FLAGS + TRACING_RULE_FLAGS + COMPLETENESS_FLAGS + TRACING_ROW_FLAGS

# Label vocabularies.
INTERACTION_TYPES = ["Precise", "Quick", "Hesitant", "Erratic", "Unknown"]
ANOMALY_FLAGS = ["None", "Technical", "Behavioral", "Spatial"]
SUITABILITY_TAGS = ["Timing", "Spatial", "Behavioral", "All", "Limited"]

LABEL_COLUMNS = ["quality_score", "interaction_type", "anomaly_flag", "research_suitability"]
TRACKING_COLUMNS = ["sequence_interrupted", "orphaned_events", "multiple_end_events",
                    "improper_sequence_order"]

EPS = 1e-8

_D, _S, _L, _I, _B = (T.DoubleType(), T.StringType(), T.LongType(), T.IntegerType(), T.BooleanType())

# One wide nullable event row for both recording types.
EVENT_FIELDS = [
    ("x", _D), ("y", _D), ("time", _D), ("touchPhase", _S), ("fingerId", _S),
    ("accx", _D), ("accy", _D), ("accz", _D), ("color", _S), ("zone", _S), ("completionPerc", _D),
    ("distance", _D), ("camFrame", _L), ("isDragging", _B),
]

EVENT_STRUCT = T.StructType([T.StructField(name, kind) for name, kind in EVENT_FIELDS] + [
    T.StructField("Touchdata_id", _S), T.StructField("event_index", _L)])

SESSION_DOCUMENT = T.StructType([
    T.StructField("message", _S),
    T.StructField("json", T.StructType([
        T.StructField("dataSet", _S),
        T.StructField("touchData", T.MapType(_S, T.ArrayType(EVENT_STRUCT))),
        T.StructField("startTime", _D),
        T.StructField("maxTapCount", _L),
        T.StructField("partOffset", T.MapType(_S, _L)),  # event_index of a continued touch's first event
    ])),
    T.StructField("_corrupt_record", _S),
])


def time_order(columns: list[str]) -> list[str]:
    """Order by time with a tie-break, so that equal times give the same result on every run."""
    ties = ["event_id"] if "event_id" in columns else ["Touchdata_id", "event_index"]
    return ["time", *[c for c in ties if c in columns]]
