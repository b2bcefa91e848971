"""Per-event features of touches: timing, movement, behaviour and sequence quality.

A touch is (session, Touchdata_id) ordered by event_index; data without touch ids falls back to
(session, finger) ordered by time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from fingertrail.functions.numeric import finite_or_zero, over_eps, step
from fingertrail.functions.phases import PATTERN_PARTS, any_phase, loose_pattern, pattern_parts
from fingertrail.operators.groups import Position, Previous, Quantile, RunningSum, Touches
from fingertrail.operators.metrics import TOUCH
from fingertrail.operators.segment import FINGER
from fingertrail.schema import time_order

TEMPORAL = ["time_diff", "time_diff_normalized", "cumulative_time", "time_acceleration",
            "sequence_position", "sequence_length", "position_ratio", "time_rhythm_consistency"]
SPATIAL = ["x_diff", "y_diff", "distance", "velocity", "acceleration", "direction_angle",
           "direction_change", "cumulative_distance", "spatial_smoothness", "bbox_width", "bbox_height",
           "bbox_area"]
BEHAVIORAL = ["phase_transition", "completion_rate", "completion_acceleration", "acc_magnitude",
              "acc_change", "zone_change", "zone_stability", "color_change"]
QUALITY = ["has_began", "has_ended", "has_canceled", "sequence_valid_pattern", "velocity_outlier",
           "distance_outlier", "time_gap_outlier"]


def sequence_keys(columns: list[str]) -> tuple[list[str], list[str]]:
    if "Touchdata_id" in columns and "event_index" in columns:
        return TOUCH, ["event_index"]
    return FINGER, time_order(columns)


def arrange_sequences(touches: Touches) -> Touches:
    return touches.arrange(*sequence_keys(touches.columns))


def _keys(touches: Touches) -> list[str]:
    return sequence_keys(touches.columns)[0]


def temporal_features(touches: Touches) -> Touches:
    """Time steps, their normalisation and rhythm. ``cumulative_time`` sums the absolute times."""
    keys = _keys(touches)
    rows = (arrange_sequences(touches)
            .running(_time=Previous(F.col("time")), cumulative_time=RunningSum(F.col("time")),
                     sequence_position=Position())
            .with_columns(time_diff=step("time", "_time"))
            .running(_diff=Previous(F.col("time_diff")))
            .totals(keys, _mean=F.avg("time_diff"), _std=F.stddev_samp("time_diff"),
                    sequence_length=F.count(F.lit(1))))
    return rows.with_columns(
        time_diff_normalized=over_eps(F.col("time_diff") - F.col("_mean"), F.col("_std")),
        time_acceleration=step("time_diff", "_diff"),
        position_ratio=over_eps(F.col("sequence_position"), F.col("sequence_length")),
        time_rhythm_consistency=over_eps(F.lit(1.0), F.col("_std")),
    ).drop("_time", "_diff", "_mean", "_std")


def movement(touches: Touches) -> Touches:
    """Steps, distance, velocity and direction; needs time_diff."""
    return (arrange_sequences(touches)
            .running(_x=Previous(F.col("x")), _y=Previous(F.col("y")))
            .with_columns(x_diff=step("x", "_x"), y_diff=step("y", "_y"))
            .with_columns(distance=F.sqrt(F.col("x_diff") * F.col("x_diff") + F.col("y_diff") * F.col("y_diff")),
                          direction_angle=F.atan2("y_diff", "x_diff"))
            .with_columns(velocity=F.coalesce(over_eps(F.col("distance"), F.col("time_diff")), F.lit(0.0)))
            .drop("_x", "_y"))


def spatial_features(touches: Touches) -> Touches:
    """Movement features; the direction change is left unwrapped here."""
    keys = _keys(touches)
    rows = (movement(touches)
            .running(_v=Previous(F.col("velocity")), _a=Previous(F.col("direction_angle")),
                     cumulative_distance=RunningSum(F.col("distance")))
            .with_columns(acceleration=step("velocity", "_v"), direction_change=step("direction_angle", "_a"))
            .totals(keys, _turn=F.avg(F.abs("direction_change")), _x0=F.min("x"), _x1=F.max("x"), _y0=F.min("y"),
                    _y1=F.max("y"))
            .with_columns(bbox_width=F.col("_x1") - F.col("_x0"), bbox_height=F.col("_y1") - F.col("_y0")))
    return rows.with_columns(
        spatial_smoothness=over_eps(F.lit(1.0), F.col("_turn")),
        bbox_area=F.col("bbox_width") * F.col("bbox_height"),
    ).drop("_v", "_a", "_turn", "_x0", "_x1", "_y0", "_y1")


def changed(column: str, previous: str) -> Column:
    """1 where the value differs from the previous row's; a missing value differs from all."""
    return F.coalesce(F.col(column) != F.col(previous), F.lit(True)).cast("int")


def behavioral_features(touches: Touches, start: str = "start_") -> Touches:
    """Phase transitions, completion, acceleration sensor, zone and color changes.

    ``start`` prefixes the first transition: 'start_' here, 'start_to_' in the advanced family.
    """
    keys, columns = _keys(touches), touches.columns
    has_completion = "completionPerc" in columns
    has_sensor = {"accx", "accy", "accz"} <= set(columns)
    lags = {"_phase": Previous(F.col("touchPhase"))}
    for name in ("completionPerc", "zone", "color"):
        if name in columns:
            lags[f"_{name}"] = Previous(F.col(name))
    rows = arrange_sequences(touches)
    if has_sensor:
        rows = rows.with_columns(acc_magnitude=F.sqrt(
            F.col("accx") * F.col("accx") + F.col("accy") * F.col("accy") + F.col("accz") * F.col("accz")))
        lags["_acc"] = Previous(F.col("acc_magnitude"))
    rows = rows.running(**lags)
    derived = {"phase_transition": F.coalesce(
        F.concat("_phase", F.lit("_to_"), "touchPhase"), F.concat(F.lit(start), F.col("touchPhase")))}
    if has_completion:
        derived["completion_rate"] = step("completionPerc", "_completionPerc")
    if has_sensor:
        derived["acc_change"] = step("acc_magnitude", "_acc")
    for name in ("zone", "color"):
        if name in columns:
            derived[f"{name}_change"] = changed(name, f"_{name}")
    rows = rows.with_columns(**derived)
    if has_completion:
        rows = rows.running(_rate=Previous(F.col("completion_rate"))).with_columns(
            completion_acceleration=step("completion_rate", "_rate")).drop("_rate")
    if "zone" in columns:
        rows = rows.totals(keys, zone_stability=F.sum("zone_change"))
    return rows.drop(*lags)


def _far_from_median(value: str, median: str, std: str) -> Column:
    far = F.abs(F.col(value) - F.col(median)) > F.lit(3) * F.col(std)
    return F.when((F.col(std) > 0) & far, 1).otherwise(0)


def sequence_quality_features(touches: Touches) -> Touches:
    """Completeness marks, loose pattern and outlier marks; needs velocity, distance, time_diff."""
    keys, order = sequence_keys(touches.columns)
    rows = touches.totals(
        keys, _began=any_phase("Began"), _ended=any_phase("Ended"), _canceled=any_phase("Canceled"),
        **pattern_parts(F.struct(*order)),
        _v_std=F.stddev_samp("velocity"), _d_std=F.stddev_samp("distance"),
        _v_median=Quantile(F.col("velocity"), 0.5), _d_median=Quantile(F.col("distance"), 0.5),
        _t_q95=Quantile(F.col("time_diff"), 0.95))
    return rows.with_columns(
        has_began=F.col("_began").cast("int"), has_ended=F.col("_ended").cast("int"),
        has_canceled=F.col("_canceled").cast("int"), sequence_valid_pattern=loose_pattern().cast("int"),
        velocity_outlier=_far_from_median("velocity", "_v_median", "_v_std"),
        distance_outlier=_far_from_median("distance", "_d_median", "_d_std"),
        time_gap_outlier=(F.col("time_diff") > F.col("_t_q95") * 2).cast("int"),
    ).drop(*PATTERN_PARTS, "_began", "_ended", "_canceled", "_v_std", "_d_std", "_v_median", "_d_median",
           "_t_q95")


def extract_all_features(touches: Touches) -> Touches:
    """All four families over one clustering by session."""
    return sequence_quality_features(behavioral_features(spatial_features(temporal_features(touches))))


def feature_names(before: list[str], after: list[str]) -> list[str]:
    return [c for c in after if c not in before]


def feature_matrix(df: DataFrame, features: list[str], keep: list[str] | None = None) -> DataFrame:
    """Numeric features only, with null, NaN and infinities as 0."""
    numeric = {f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)}
    chosen = [f for f in features if f in numeric]
    return df.select(*(keep or []), *[finite_or_zero(F.col(f)).alias(f) for f in chosen])


def basic_features(touches: Touches) -> Touches:
    """The small set: time step, position, length, steps, distance and its running sum."""
    keys = _keys(touches)
    return (arrange_sequences(touches)
            .running(_time=Previous(F.col("time")), sequence_position=Position(),
                     _x=Previous(F.col("x")), _y=Previous(F.col("y")))
            .with_columns(time_diff=step("time", "_time"), x_diff=step("x", "_x"), y_diff=step("y", "_y"))
            .with_columns(distance=F.sqrt(F.col("x_diff") * F.col("x_diff") + F.col("y_diff") * F.col("y_diff")))
            .running(cumulative_distance=RunningSum(F.col("distance")))
            .totals(keys, sequence_length=F.count(F.lit(1)))
            .drop("_time", "_x", "_y"))


def pack_fixed_length(touches: Touches, max_length: int = 100,
                      inputs: tuple[str, ...] = ("x", "y", "time", "completionPerc", "accx", "accy")) -> DataFrame:
    """Per touch: the first ``max_length`` events as arrays of inputs, zero-padded at the end.

    The cut is part of the operator; it is applied before the events are gathered.
    """
    keys, order = sequence_keys(touches.columns)
    values = F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) if c in touches.columns else F.lit(0.0)
                       for c in inputs])
    rows = (arrange_sequences(touches).running(_pos=Position()).filter(F.col("_pos") < max_length)
            .with_columns(_input=values))
    packed = rows.rows().groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.struct("_pos", "_input"))).alias("_steps"))
    steps = F.transform("_steps", lambda s: s["_input"])
    zeros = F.array_repeat(F.array(*[F.lit(0.0) for _ in inputs]), max_length)
    return packed.select(*keys, F.size("_steps").alias("steps"),
                         F.slice(F.concat(steps, zeros), 1, max_length).alias("inputs"))
