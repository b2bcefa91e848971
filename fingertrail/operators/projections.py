"""Output column orders and the named subsets of labelled events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fingertrail.schema import LABEL_COLUMNS, TRACKING_COLUMNS

# Column orders of the exports.
COLORING_ORDER = ["Touchdata_id", "event_index", "x", "y", "time", "touchPhase", "fingerId", "color",
                  "completionPerc", "zone", "flags", *LABEL_COLUMNS]
COLORING_LEGACY_ORDER = ["fingerId", "seqId", "x", "y", "time", "touchPhase", "color", "completionPerc",
                         "zone", "flags", *LABEL_COLUMNS]
TRACING_FLAGGED_ORDER = ["fingerId", "seqId", "x", "y", "time", "touchPhase", "distance", "camFrame",
                         "isDragging", "zone", "flags"]
TRACING_ORDER = ["fingerId", "x", "y", "time", "touchPhase", "distance", "camFrame", "isDragging", "zone",
                 "flags", *LABEL_COLUMNS]


def _pick(df: DataFrame, order: list[str]) -> DataFrame:
    keep = [c for c in order if c in df.columns]
    return df.select(*(["session_id"] if "session_id" in df.columns else []), *keep)


def coloring_output(df: DataFrame, data_type: str | None = None) -> DataFrame:
    """Export columns of Coloring data (or of Tracing and untyped data sent down the same path).

    With a ``data_type`` that decides; without one the columns do, which holds only for a table of one type, as
    united tables have the columns of both.
    """
    columns = set(df.columns)
    if data_type != "Coloring" and {"distance", "camFrame"} <= columns:
        return _pick(df, TRACING_FLAGGED_ORDER)
    if {"color", "completionPerc"} <= columns:
        by_touch = {"Touchdata_id", "event_index"} <= columns
        return _pick(df, COLORING_ORDER if by_touch else COLORING_LEGACY_ORDER)
    gone = {"accx", "accy", "accz", "flags", "session_id", *TRACKING_COLUMNS}
    return _pick(df, [c for c in df.columns if c not in gone] + ["flags"])


def tracing_output(df: DataFrame) -> DataFrame:
    """Export columns of Tracing data: no seqId, no metrics."""
    return _pick(df, TRACING_ORDER)


def _at_least(name: str, bound: float) -> Column:
    return F.col(name) >= bound


def subset_rules(saved: bool = False) -> dict[str, Column]:
    """Row conditions of the four named subsets; the saved forms leave out the last conditions."""
    high = _at_least("ml_quality_score", 0.8) & (F.col("quality_tier") == "high")
    research = (_at_least("ml_quality_score", 0.85) & _at_least("temporal_consistency", 0.9)
                & _at_least("spatial_consistency", 0.6) & (F.col("anomaly_type") == "normal"))
    timing = (_at_least("temporal_consistency", 0.8) & (F.col("time_gap_outlier") == 0)
              & _at_least("ml_quality_score", 0.8))
    spatial = (_at_least("spatial_consistency", 0.5) & (F.col("distance_outlier") == 0)
               & (F.col("velocity_outlier") == 0))
    if not saved:
        high = high & (F.col("sequence_valid_pattern") == 1)
        research = research & F.col("behavioral_pattern").isin("drag", "tap", "hold")
        timing = timing & (F.col("time_diff") >= 0)
        spatial = spatial & (F.col("velocity") <= 5000)
    return {"high_quality": high, "research_grade": research, "timing_ready": timing,
            "spatial_ready": spatial}


def named_subset(df: DataFrame, name: str, saved: bool = False) -> DataFrame:
    return df.filter(subset_rules(saved)[name])


def subset_retention(df: DataFrame, saved: bool = False) -> DataFrame:
    """Rows kept by each subset and their share, in one pass over the data."""
    rules = subset_rules(saved)
    counts = df.agg(F.count(F.lit(1)).alias("_all"),
                    *[F.count_if(rule).alias(name) for name, rule in rules.items()])
    return (counts.unpivot(["_all"], list(rules), "subset", "points")
            .select("subset", "points",
                    F.round(F.try_divide(F.col("points") * 100.0, F.col("_all")), 1).alias("retention")))


def show_sequences(rows: DataFrame, flag_sets: DataFrame, keys: list[str], mode: str,
                   active: list[str]) -> DataFrame:
    """Rows of the sequences shown in a mode: all, flagged (has an active flag) or non_flagged."""
    if mode == "all":
        return rows.filter(F.col(keys[-1]).isNotNull())
    has_active = F.arrays_overlap("flag_set", F.array(*[F.lit(f) for f in active]).cast("array<string>"))
    wanted = flag_sets.filter(has_active if mode == "flagged" else ~has_active).select(*keys)
    return rows.join(wanted, keys, "left_semi")

