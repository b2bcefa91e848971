"""Quality scores and behaviour classes, one row per touch.

``touch_profile`` reduces every touch to a row of combinable aggregates; each classifier below is a set
of column expressions over that row. ``attach`` of the two-part table brings labels back to events.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fingertrail.functions.numeric import clip, over_eps
from fingertrail.functions.phases import any_phase, count_phase
from fingertrail.operators.features import arrange_sequences, sequence_keys
from fingertrail.operators.groups import Previous, Touches

_MIDDLE = ["Moved", "Stationary", "Canceled"]


def touch_profile(touches: Touches) -> DataFrame:
    """Everything the classifiers ask of a touch.

    Flags and anomaly marks are taken from the first event of the touch, where the rows carry them.
    """
    keys, order = sequence_keys(touches.columns)
    at = F.struct(*order)
    rows = arrange_sequences(touches).running(
        _t=Previous(F.col("time")), _px=Previous(F.col("x")), _py=Previous(F.col("y")))
    dx, dy = F.col("x") - F.col("_px"), F.col("y") - F.col("_py")
    rows = rows.with_columns(_dt=F.col("time") - F.col("_t"), _dist=F.sqrt(dx * dx + dy * dy))
    # velocity counts the first event with 0, unlike the step statistics
    rows = rows.with_columns(_velocity=F.coalesce(over_eps(F.col("_dist"), F.col("_dt")), F.lit(0.0)))
    columns = touches.columns
    aggregates = {
        "n": F.count(F.lit(1)), "first_phase": F.min_by("touchPhase", at), "last_phase": F.max_by("touchPhase", at),
        "middles": count_phase(*_MIDDLE), "known": count_phase("Began", "Moved", "Stationary", "Ended"),
        "cancels": count_phase("Canceled"),
        "any_began": any_phase("Began"), "any_ended": any_phase("Ended"), "any_moved": any_phase("Moved"),
        "any_stationary": any_phase("Stationary"), "any_canceled": any_phase("Canceled"), "any_s": any_phase("S"),
        "duration": F.max("time") - F.min("time"),
        "mean_dt": F.avg("_dt"), "std_dt": F.stddev_samp("_dt"), "backwards": F.max(F.col("_dt") < 0),
        "total_distance": F.coalesce(F.sum("_dist"), F.lit(0.0)), "mean_distance": F.avg("_dist"),
        "std_distance": F.stddev_samp("_dist"), "max_distance": F.max("_dist"),
        "x_range": F.max("x") - F.min("x"), "y_range": F.max("y") - F.min("y"),
        "mean_velocity": F.avg("_velocity"), "std_velocity": F.stddev_samp("_velocity"),
    }
    if "flags" in columns:
        aggregates["first_flags"] = F.min_by("flags", at)
    if "anomaly_type" in columns:
        aggregates["first_anomaly"] = F.min_by("anomaly_type", at)
        aggregates["outliers"] = F.count_if(F.col("anomaly_type") == "outlier")
    if "velocity_outlier" in columns:
        aggregates["any_velocity_outlier"] = F.max(F.col("velocity_outlier") == 1)
    return rows.aggregate(keys, **aggregates)


def _in_middle(column: str) -> Column:
    return F.coalesce(F.col(column).isin(*_MIDDLE), F.lit(False)).cast("long")


def _is(column: str, *values: str) -> Column:
    return F.coalesce(F.col(column).isin(*values), F.lit(False))


def _middle_is_valid() -> Column:
    """All events between first and last are moves, stops or cancels."""
    return F.col("middles") - _in_middle("first_phase") - _in_middle("last_phase") == F.col("n") - 2


def _began_to_ended() -> Column:
    return _is("first_phase", "Began") & _is("last_phase", "Ended")


def _loose_valid() -> Column:
    return (F.col("n") >= 2) & _began_to_ended() & _middle_is_valid() & (F.col("cancels") <= 1)


def quality_tier(score: Column) -> Column:
    return F.when(score >= 0.8, "high").when(score >= 0.5, "medium").otherwise("low")


def sequence_quality(profile: DataFrame) -> DataFrame:
    """Completeness, temporal and spatial consistency, score and tier.

    A touch of one event scores 0. With two events the spread of the only step is undefined, which
    counts as fully irregular timing.
    """
    several = F.col("n") >= 2
    completeness = F.least(F.lit(1.0), (
        F.when(_is("first_phase", "Began"), 0.4).otherwise(0.0)
        + F.when(_is("last_phase", "Ended"), 0.4).when(_is("last_phase", "Canceled"), 0.2).otherwise(0.0)
        + F.when(_middle_is_valid(), 0.2).otherwise(0.0)))
    irregular = F.when(F.col("mean_dt") > 0, F.coalesce(F.col("std_dt") / F.col("mean_dt"), F.lit(1.0))).otherwise(1.0)
    temporal = F.when(F.coalesce(F.col("backwards"), F.lit(False)), 0.0).otherwise(
        F.greatest(F.lit(0.0), F.lit(1.0) - F.least(F.lit(1.0), irregular)))
    spread = F.try_divide("std_distance", "mean_distance")
    spatial = (F.when(F.col("n") < 3, 1.0)
               .when(F.col("mean_distance") == 0, F.when(F.col("std_distance") == 0, 1.0).otherwise(0.0))
               .otherwise(F.greatest(F.lit(0.0), F.lit(1.0) - F.least(F.lit(1.0), spread / 2.0))))
    table = profile.withColumns({
        "sequence_completeness": F.when(several, completeness).otherwise(0.0),
        "temporal_consistency": F.when(several, temporal).otherwise(0.0),
        "spatial_consistency": F.when(several, spatial).otherwise(0.0)})
    score = (F.lit(0.4) * F.col("sequence_completeness") + F.lit(0.3) * F.col("temporal_consistency")
             + F.lit(0.3) * F.col("spatial_consistency"))
    return table.withColumn("ml_quality_score", score).withColumn(
        "quality_tier", quality_tier(F.col("ml_quality_score")))


def simple_quality(profile: DataFrame) -> DataFrame:
    """The small score: begin, end, and a length of 2 to 20 events."""
    score = (F.when(_is("first_phase", "Began"), 0.4).otherwise(0.0)
             + F.when(_is("last_phase", "Ended"), 0.4).when(_is("last_phase", "Canceled"), 0.2).otherwise(0.0)
             + F.when(F.col("n").between(2, 20), 0.2).otherwise(0.0))
    score = F.when(F.col("n") < 2, 0.0).otherwise(F.least(F.lit(1.0), score))
    return profile.withColumns({"ml_quality_score": score, "sequence_completeness": score}).withColumn(
        "quality_tier", quality_tier(F.col("ml_quality_score")))


def _variation(std: str, mean: str) -> Column:
    return over_eps(F.col(std), F.col(mean))


def enhanced_quality(profile: DataFrame) -> DataFrame:
    """Score 0..100 from completeness, timing, movement and the share of outlier events."""
    long_enough = F.col("n") > 2
    completeness = (F.when((F.col("n") >= 2) & _began_to_ended(), 1.0)
                    .when(F.col("any_began") | F.col("any_ended"), 0.6).otherwise(0.2))
    temporal = F.greatest(F.lit(0.0), F.lit(1.0) - _variation("std_dt", "mean_dt"))
    temporal = F.when(F.col("backwards"), temporal * 0.5).otherwise(temporal)
    spatial = F.greatest(F.lit(0.0), F.lit(1.0) - _variation("std_distance", "mean_distance") * 0.5)
    spatial = F.when(F.col("max_distance") > F.col("mean_distance") * 10, spatial * 0.7).otherwise(spatial)
    outliers = F.lit(1.0)
    if "outliers" in profile.columns:
        outliers = F.greatest(F.lit(0.0), F.lit(1.0) - F.col("outliers") / F.col("n") * 2)
    score = (F.lit(0.4) * completeness + F.lit(0.3) * F.when(long_enough, temporal).otherwise(0.5)
             + F.lit(0.2) * F.when(long_enough, spatial).otherwise(0.5) + F.lit(0.1) * outliers)
    return profile.withColumn("ml_quality_score", clip(score * 100, 0.0, 100.0))


def _movement(minimal: bool) -> Column:
    kind = F.when(F.col("total_distance") < 10, "stationary")
    kind = kind.when(F.col("max_distance") > F.col("mean_distance") * 5, "erratic")
    kind = kind.when(F.col("std_distance") < F.col("mean_distance") * 0.5, "smooth").otherwise("variable")
    return F.when(F.col("n") < 3, "minimal").otherwise(kind) if minimal else kind


def behaviour(profile: DataFrame) -> DataFrame:
    """Pattern, style, confidence, movement and temporal pattern of a touch."""
    several = F.col("n") >= 2
    style = (F.when(_began_to_ended(), "deliberate").when(F.col("any_canceled"), "interrupted")
             .otherwise("irregular"))
    confidence = F.when(_began_to_ended(), 0.9).when(F.col("any_canceled"), 0.6).otherwise(0.3)
    pattern = (F.when((F.col("n") == 2) & _began_to_ended(), "tap")
               .when(F.col("any_moved") & (F.col("n") > 3), "drag")
               .when(F.col("any_stationary"), "hold").otherwise("complex"))
    tempo = (F.when(F.col("duration") < 100, "quick").when(F.col("duration") > 2000, "slow")
             .otherwise("normal"))
    return profile.withColumns({
        "behavioral_pattern": F.when(several, pattern).otherwise("unknown"),
        "interaction_style": F.when(several, style).otherwise("unknown"),
        "user_intent_confidence": F.when(several, confidence).otherwise(0.0),
        "movement_type": F.when(several, _movement(minimal=True)).otherwise("unknown"),
        "temporal_pattern": F.when(several, tempo)})


def simple_behaviour(profile: DataFrame) -> DataFrame:
    """Pattern, style and confidence of the small set."""
    tap = (F.col("n") == 2) & _began_to_ended()
    drag = F.col("any_moved") & (F.col("n") > 3)

    def pick(a, b, c, d):
        return F.when(tap, a).when(drag, b).when(F.col("any_canceled"), c).otherwise(d)

    return profile.withColumns({
        "behavioral_pattern": pick("tap", "drag", "interrupted", "complex"),
        "interaction_style": pick("deliberate", "deliberate", "interrupted", "unknown"),
        "user_intent_confidence": pick(0.9, 0.8, 0.6, 0.3)})


def enhanced_behaviour(profile: DataFrame) -> DataFrame:
    """Style by duration and rhythm, pattern by completeness; the pattern scales the confidence."""
    several = F.col("n") >= 2
    regular = F.coalesce(F.try_divide("std_dt", "mean_dt") < 0.3, F.lit(False))

    def timed(quick, hesitant, precise, erratic, untimed):
        value = (F.when(F.col("duration") < 0.5, quick).when(F.col("duration") > 5.0, hesitant)
                 .when(regular, precise).otherwise(erratic))
        return F.when(F.col("n") > 2, value).otherwise(untimed)

    style = timed("quick", "hesitant", "precise", "erratic", "unknown")
    confidence = timed(0.7, 0.9, 0.95, 0.4, 0.5)
    whole = (F.col("n") >= 3) & _began_to_ended()

    def phased(interrupted, complete, irregular, incomplete):
        return (F.when(whole & F.col("any_canceled"), interrupted)
                .when(whole & (F.col("known") == F.col("n")), complete)
                .when(whole, irregular).otherwise(incomplete))

    factor = phased(0.7, 1.1, 0.8, 0.5)
    return profile.withColumns({
        "behavioral_pattern": F.when(several, phased("interrupted", "complete", "irregular", "incomplete")).otherwise("unknown"),
        "interaction_style": F.when(several, style).otherwise("unknown"),
        "user_intent_confidence": F.when(several, clip(confidence * factor, 0.0, 1.0)).otherwise(0.5),
        "movement_type": F.when(several, _movement(minimal=False)).otherwise("unknown")})
