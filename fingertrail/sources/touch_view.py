"""Touch events derived from a generic ``events`` table (mapping: FIXTURES.md, section 8)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fingertrail.operators.groups import Position, RunningSum, Touches, split_sessions

# Event type to phase, for both recording types; X is an invalid phase.
PHASE_OF = {
    "coloring": {"signup": "Began", "click": "Moved", "view": "Stationary", "purchase": "Ended",
                 "error": "Canceled"},
    "tracing": {"signup": "B", "click": "M", "view": "S", "purchase": "E", "error": "X"},
}
COLORS = ["Red", "Green", "Blue"]
ZONES = ["Wall", "Outside", "Roof", "Door"]


def _pick(index: Column, names: list[str]) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in names]), (index + 1).cast("int"))


def events_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def base_touches(events: DataFrame, kind: str = "coloring") -> DataFrame:
    """Event columns without the touch numbering."""
    k = F.get_json_object("props", "$.k").cast("int")
    phase = F.create_map(*[F.lit(v) for pair in PHASE_OF[kind].items() for v in pair])
    still = F.lit(kind == "tracing") & (F.col("event_id") % 5 < 3)  # stays put: phantom moves occur
    columns = {
        "event_id": F.col("event_id"),
        "user_id": F.col("user_id"),
        "session_id": F.expr("user_id div 10"),
        "fingerId": (F.col("user_id") % 10).cast("int"),
        "time": F.unix_micros(F.col("ts").cast("timestamp")) / F.lit(6e8) - F.lit(2840112.0),
        "touchPhase": phase[F.col("event_type")],
        "x": F.when(still, F.col("user_id") % 1920)
              .otherwise(F.col("event_id") * 7919 % 1920).cast("double"),
        "y": F.when(still, F.col("user_id") % 1080).otherwise(k * 10).cast("double"),
        "zone": _pick(k % 4, ZONES),
    }
    if kind == "coloring":
        columns["color"] = _pick(k % 3, COLORS)
        columns["completionPerc"] = F.least(F.lit(100.0), F.col("value") / 5)
    else:
        columns["distance"] = F.col("value")
        columns["camFrame"] = F.col("event_id") % 30
        columns["isDragging"] = F.col("event_type") == "click"
    return events.select(*[c.alias(name) for name, c in columns.items()])


def touch_view(spark: SparkSession, sf_dir: str, kind: str = "coloring",
               hot_rows: int | None = None) -> Touches:
    """Touch events of ``events`` with touches numbered by the begin events of a finger."""
    touches = split_sessions(base_touches(events_table(spark, sf_dir), kind), hot_rows)
    if kind == "tracing":
        return touches.drop("user_id")
    finger = ["session_id", "fingerId"]
    numbered = (touches.arrange(finger, ["time", "event_id"])
                .running(_touch=RunningSum((F.col("touchPhase") == "Began").cast("long")))
                .running(within=[*finger, "_touch"], event_index=Position())
                .with_columns(Touchdata_id=F.col("user_id") * 1000 + F.col("_touch")))
    return numbered.drop("_touch", "user_id")
