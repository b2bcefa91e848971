"""One row of features per touch: lags first, then a single grouping."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fingertrail.functions.numeric import inverse, over_eps
from fingertrail.functions.phases import count_phase
from fingertrail.operators.features import arrange_sequences, changed, sequence_keys
from fingertrail.operators.groups import Position, Previous, Quantile, Touches
from fingertrail.schema import COLORING_PHASES

STATISTICS_OF = ["x", "y", "time", "completionPerc"]


def _steps(touches: Touches) -> Touches:
    """Step columns that are null on the first event (there is no step to it)."""
    rows = arrange_sequences(touches).running(
        _pos=Position(), _t=Previous(F.col("time")), _x=Previous(F.col("x")), _y=Previous(F.col("y")),
        _phase=Previous(F.col("touchPhase")),
        **({"_c": Previous(F.col("completionPerc"))} if "completionPerc" in touches.columns else {}),
        **({"_zone": Previous(F.col("zone"))} if "zone" in touches.columns else {}))
    dx, dy = F.col("x") - F.col("_x"), F.col("y") - F.col("_y")
    rows = rows.with_columns(
        _dt=F.col("time") - F.col("_t"), _dist=F.sqrt(dx * dx + dy * dy), _angle=F.atan2(dy, dx),
        _step_name=F.concat("_phase", F.lit("_to_"), "touchPhase"))
    rows = rows.running(_before=Previous(F.col("_angle")))
    turn = F.abs(F.pmod(F.col("_angle") - F.col("_before") + math.pi, F.lit(2 * math.pi)) - math.pi)
    return rows.with_columns(_turn=turn)


def sequence_feature_table(touches: Touches) -> DataFrame:
    """Length, timing, movement, phases, completion, zones and column statistics per touch."""
    keys, _ = sequence_keys(touches.columns)
    columns = touches.columns
    rows = _steps(touches)
    aggregates = {
        "sequence_length": F.count(F.lit(1)), "_t0": F.min("time"), "_t1": F.max("time"),
        "mean_time_interval": F.avg("_dt"), "std_time_interval": F.stddev_samp("_dt"),
        "max_time_gap": F.max("_dt"),
        "total_distance": F.sum("_dist"), "mean_distance": F.avg("_dist"),
        "std_distance": F.stddev_samp("_dist"), "max_distance": F.max("_dist"),
        "_x0": F.min("x"), "_x1": F.max("x"), "_y0": F.min("y"), "_y1": F.max("y"),
        "_turn_std": F.stddev_pop("_turn"),
        # both sets are bounded by the phase vocabulary
        "phase_diversity": F.size(F.collect_set("touchPhase")),
        "unique_transitions": F.size(F.collect_set("_step_name")),
        **{f"{p.lower()}_count": count_phase(p) for p in COLORING_PHASES},
    }
    if "completionPerc" in columns:
        aggregates |= {"_c0": F.min("completionPerc"), "_c1": F.max("completionPerc"),
                       "_c_std": F.stddev_samp(F.col("completionPerc") - F.col("_c"))}
    if "zone" in columns:
        aggregates |= {"zone_diversity": F.size(F.collect_set("zone")),
                       "zone_changes": F.sum(changed("zone", "_zone"))}
    statistics = [c for c in STATISTICS_OF if c in columns]
    for name in statistics:
        value = F.col(name)
        aggregates |= {f"{name}_mean": F.avg(value), f"{name}_std": F.stddev_samp(value),
                       f"{name}_skew": F.skewness(value), f"{name}_kurtosis": F.kurtosis(value),
                       f"{name}_q25": Quantile(value, 0.25), f"{name}_q75": Quantile(value, 0.75)}
    table = rows.aggregate(keys, **aggregates)

    n = F.col("sequence_length")
    x_range, y_range = F.col("_x1") - F.col("_x0"), F.col("_y1") - F.col("_y0")
    interval_cv = over_eps(F.col("std_time_interval"), F.col("mean_time_interval"))
    several = n > 1
    derived = {
        "sequence_duration": F.col("_t1") - F.col("_t0"),
        "time_interval_cv": interval_cv, "time_regularity": inverse(interval_cv),
        "distance_cv": over_eps(F.col("std_distance"), F.col("mean_distance")),
        "x_range": F.when(several, x_range), "y_range": F.when(several, y_range),
        "spatial_spread": F.when(several, F.sqrt(x_range * x_range + y_range * y_range)),
        "trajectory_smoothness": F.when(n > 3, inverse(F.col("std_distance"))),
        "direction_consistency": F.when(n > 2, inverse(F.col("_turn_std"))),
        **{f"{name}_iqr": F.col(f"{name}_q75") - F.col(f"{name}_q25") for name in statistics},
    }
    if "completionPerc" in columns:
        derived |= {"completion_range": F.col("_c1") - F.col("_c0"),
                    "completion_rate": over_eps(F.col("_c1") - F.col("_c0"), F.col("_t1") - F.col("_t0")),
                    "completion_consistency": inverse(F.col("_c_std"))}
    return table.withColumns(derived).drop("_t0", "_t1", "_x0", "_x1", "_y0", "_y1", "_turn_std", "_c0",
                                           "_c1", "_c_std")
