"""Recording type of each session, and routing by it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fingertrail.functions.phases import any_phase, count_phase
from fingertrail.schema import COLORING_PHASES, TRACING_PHASES


def _present(df: DataFrame, *names: str) -> Column:
    """All of these columns hold a value somewhere in the session."""
    result = F.lit(True)
    for name in names:
        result = result & (F.max(F.col(name).isNotNull()) if name in df.columns else F.lit(False))
    return result


def detect_data_type(df: DataFrame, name: Column | None = None) -> DataFrame:
    """(session_id, data_type): Coloring, Tracing or Unknown, from name, columns and phases.

    Everything is a combinable aggregate, so a session of any size is reduced before the shuffle.
    """
    if "touchPhase" not in df.columns:
        raise ValueError("touchPhase column is required")
    label = (F.col("session_id").cast("string") if name is None else name)
    table = df.groupBy("session_id").agg(
        F.first(label).alias("_name"),
        _present(df, "distance", "camFrame", "isDragging").alias("_tracing_columns"),
        _present(df, "color", "completionPerc").alias("_coloring_columns"),
        count_phase(*TRACING_PHASES).alias("_short"), count_phase(*COLORING_PHASES).alias("_long"),
        F.count("touchPhase").alias("_phases"),
        (any_phase("B") & any_phase("E")).alias("_short_pair"),
        (any_phase("Began") & any_phase("Ended")).alias("_long_pair"))

    def named(text):
        return F.coalesce(F.instr("_name", text) > 0, F.lit(False))

    marks = (F.when(named("Tracing_"), "Tracing_").when(named("Coloring_"), "Coloring_")
             .when(named("Tracing"), "Tracing").when(named("Coloring"), "Coloring").otherwise(""))
    short = F.coalesce(F.try_divide("_short", "_phases"), F.lit(0.0))
    long = F.coalesce(F.try_divide("_long", "_phases"), F.lit(0.0))
    mixed = (short > 0.1) & (long > 0.1)
    table = table.withColumns({"_mark": marks, "_short_ratio": short, "_long_ratio": long,
                               "_mixed": mixed})
    mark, short, long = F.col("_mark"), F.col("_short_ratio"), F.col("_long_ratio")

    tracing = (F.when(mark == "Tracing_", 0.6).when(mark == "Tracing", 0.4).otherwise(0.0)
               + F.when(F.col("_tracing_columns"), 0.3).otherwise(0.0)
               + F.when(F.col("_mixed") & (short > long), F.lit(0.2) * short)
                  .when(~F.col("_mixed") & (short > 0.5), 0.2).otherwise(0.0)
               + F.when(F.col("_short_pair"), 0.1).otherwise(0.0))
    coloring = (F.when(mark == "Coloring_", 0.6).when(mark == "Coloring", 0.4).otherwise(0.0)
                + F.when(F.col("_coloring_columns") & ~F.col("_tracing_columns"), 0.3).otherwise(0.0)
                + F.when(F.col("_mixed") & (short <= long), F.lit(0.2) * long)
                   .when(~F.col("_mixed") & (short <= 0.5) & (long > 0.5), 0.2).otherwise(0.0)
                + F.when(F.col("_long_pair"), 0.1).otherwise(0.0))
    scored = table.withColumns({"tracing_score": tracing, "coloring_score": coloring})
    # content of 0.3 or more outweighs a name of the other type
    kind = (F.when((mark == "Coloring_") & (F.col("tracing_score") >= 0.3), "Tracing")
            .when((mark == "Tracing_") & (F.col("coloring_score") >= 0.3), "Coloring")
            .when(F.col("tracing_score") > F.col("coloring_score"), "Tracing")
            .when(F.col("coloring_score") > F.col("tracing_score"), "Coloring")
            .otherwise("Unknown"))
    return scored.select("session_id", "tracing_score", "coloring_score", kind.alias("data_type"))


def simple_data_type(df: DataFrame) -> DataFrame:
    """(session_id, data_type): Coloring with color and completionPerc, else Tracing."""
    coloring = _present(df, "color", "completionPerc")
    return df.groupBy("session_id").agg(F.when(coloring, "Coloring").otherwise("Tracing").alias("data_type"))


def route_sessions(df: DataFrame, types: DataFrame) -> DataFrame:
    """Rows of sessions of a known type, with their ``data_type``.

    The type table has one row per session; the optimizer broadcasts it while it is small and
    otherwise joins by session, where AQE splits a large session.
    """
    known = types.filter(F.col("data_type") != "Unknown").select("session_id", "data_type")
    return df.join(known, "session_id")


def detection_statistics(types: DataFrame) -> DataFrame:
    """Sessions per data type."""
    return types.groupBy("data_type").agg(F.count(F.lit(1)).alias("sessions"))
