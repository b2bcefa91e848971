"""The four label columns of a touch in their five variants, validation, and recommendations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fingertrail.functions.flags import anomaly_kind
from fingertrail.functions.numeric import clip
from fingertrail.functions.phases import flag_if, flag_list
from fingertrail.operators.quality import (_began_to_ended, _is, _loose_valid, behaviour,
                                           enhanced_behaviour, enhanced_quality, sequence_quality)
from fingertrail.schema import ANOMALY_FLAGS, INTERACTION_TYPES, SUITABILITY_TAGS

# What stands in for a missing label.
DEFAULT_LABELS = {"quality_score": 50, "interaction_type": "Unknown", "anomaly_flag": "None",
                  "research_suitability": "Limited"}


def _whole(score: Column) -> Column:
    """Truncation of a non-negative score."""
    return F.floor(clip(score, 0.0, 100.0)).cast("int")


def _suitability(score: Column, kind: Column, anomaly: Column) -> Column:
    timed = kind.isin("Precise", "Quick")
    middle = (F.when(anomaly.isin("None", "Behavioral"), F.when(timed, "Timing,Spatial").otherwise("Behavioral"))
              .when(anomaly == "Technical", "Behavioral").when(anomaly == "Spatial", "Timing"))
    lower = F.when(anomaly == "None", "Behavioral").when(anomaly == "Behavioral", "Timing")
    return (F.when((score >= 80) & (anomaly == "None"), "All")
            .when(score >= 60, middle).when(score >= 40, F.coalesce(lower, F.lit("Limited")))
            .otherwise("Limited"))


def consolidated_labels(profile: DataFrame) -> DataFrame:
    """The primary labels, from quality components, behaviour, anomaly marks and flags."""
    table = behaviour(sequence_quality(profile))
    score = _whole((F.lit(0.4) * F.col("sequence_completeness") + F.lit(0.3) * F.col("temporal_consistency")
                    + F.lit(0.3) * F.col("spatial_consistency")) * 100)
    pattern, mean, std = F.col("behavioral_pattern"), F.col("mean_velocity"), F.col("std_velocity")
    by_velocity = (F.when(mean < 10, "Precise").when(mean > 50, "Quick")
                   .when(std > mean * 0.8, "Erratic").otherwise("Hesitant"))
    kind = (F.when(pattern == "deliberate", "Precise").when(pattern == "tap", "Quick")
            .when(pattern == "hold", "Hesitant").when(pattern.isin("complex", "erratic"), "Erratic")
            .when(F.col("n") > 2, by_velocity).otherwise("Unknown"))
    anomaly = anomaly_kind(F.col("first_flags")) if "first_flags" in table.columns else F.lit("None")
    if "first_anomaly" in table.columns:
        fast = F.col("any_velocity_outlier") if "any_velocity_outlier" in table.columns else F.lit(False)
        broken = ~F.col("any_began") | ~F.col("any_ended") | ~_loose_valid()
        outlier = F.when(broken, "Technical").when(fast, "Spatial").otherwise("Behavioral")
        anomaly = F.when(F.col("first_anomaly") == "outlier", outlier).otherwise(anomaly)
    table = table.withColumns({"quality_score": score, "interaction_type": kind, "anomaly_flag": anomaly})
    return table.withColumn("research_suitability", _suitability(
        F.col("quality_score"), F.col("interaction_type"), F.col("anomaly_flag")))


def rule_labels(profile: DataFrame) -> DataFrame:
    """Rule-based labels for when no quality components are at hand."""
    flagged = ~F.coalesce(F.col("first_flags").isin("", "nan"), F.lit(True))
    proper = _is("first_phase", "Began", "B") & _is("last_phase", "Ended", "E")
    n = F.col("n")
    score = clip(
        F.lit(50.0)
        + F.when((n >= 2) & proper, 30).when((n >= 2) & _is("last_phase", "Canceled", "C"), 15).otherwise(0)
        - F.when(flagged, 20).otherwise(0)
        + F.when(n >= 3, 10).when(n < 2, -20).otherwise(0), 0.0, 100.0).cast("int")
    kind = (F.when((n == 2) & (F.col("duration") < 200), "Quick")
            .when(F.col("any_stationary") | F.col("any_s"), "Hesitant")
            .when(F.col("duration") > 1000, "Precise").otherwise("Quick"))
    table = profile.withColumns({"quality_score": score, "interaction_type": kind,
                                 "anomaly_flag": F.when(flagged, anomaly_kind(F.col("first_flags"))).otherwise("None")})
    none = F.col("anomaly_flag") == "None"
    return table.withColumn("research_suitability", (
        F.when((F.col("quality_score") >= 80) & none, "All")
        .when(F.col("quality_score") >= 60, F.when(none, "Timing,Spatial").otherwise("Behavioral"))
        .when(F.col("quality_score") >= 40, "Behavioral").otherwise("Limited")))


def enhanced_labels(profile: DataFrame) -> DataFrame:
    """Labels of the enhanced path, from its own quality score, style and outlier share."""
    table = enhanced_behaviour(enhanced_quality(profile))
    style, n = F.col("interaction_style"), F.col("n")
    by_duration = (F.when(F.col("duration") < 0.5, "Quick").when(F.col("duration") > 3.0, "Hesitant")
                   .otherwise("Precise"))
    kind = (F.when(style.isin("precise", "quick", "hesitant", "erratic"), F.initcap(style))
            .when(n > 1, by_duration).otherwise("Unknown"))
    anomaly = F.lit("None")
    if "outliers" in table.columns:
        found = (F.when(~_began_to_ended(), "Technical").when(F.col("movement_type") == "erratic", "Behavioral")
                 .when((F.col("x_range") > 1000) | (F.col("y_range") > 1000), "Spatial").otherwise("Behavioral"))
        anomaly = F.when(F.col("outliers") / n > 0.5, found).otherwise("None")
    table = table.withColumns({"quality_score": F.floor("ml_quality_score").cast("int"),
                               "interaction_type": kind, "anomaly_flag": anomaly})
    # the raw score decides here, not its truncation
    raw, kind, anomaly = F.col("ml_quality_score"), F.col("interaction_type"), F.col("anomaly_flag")
    precise, clean = kind == "Precise", anomaly == "None"
    high, middle = raw >= 80, (raw >= 60) & (raw < 80)
    tags = flag_list([
        flag_if(high & (clean | (anomaly == "Technical")), "Behavioral"),
        flag_if((high & (clean | (anomaly == "Behavioral"))) | (middle & clean), "Spatial"),
        flag_if((high & ~(anomaly == "Technical")) | (middle & precise) | (precise & (raw >= 70)), "Timing"),
    ])
    text = F.when(F.size(tags) >= 3, "All").when(F.size(tags) >= 1, F.array_join(tags, ",")).otherwise("Limited")
    return table.withColumn("research_suitability", text)


def _by_duration() -> Column:
    return (F.when(F.col("duration") < 0.5, "Quick").when(F.col("duration") > 3.0, "Hesitant")
            .otherwise("Precise"))


def _completeness_cases(whole, partial, other) -> Column:
    complete = (F.col("n") >= 2) & _began_to_ended()
    return F.when(complete, whole).when(F.col("any_began") | F.col("any_ended"), partial).otherwise(other)


def basic_labels(profile: DataFrame) -> DataFrame:
    """Labels of last resort: 85 / 65 / 35 by completeness, type by duration, cancels penalised."""
    score = _completeness_cases(85, 65, 35)
    canceled = F.col("any_canceled")
    kind = F.when(F.col("n") > 1, _by_duration()).otherwise(_completeness_cases("Precise", "Quick", "Unknown"))
    return profile.withColumns({
        "quality_score": F.when(canceled, F.greatest(F.lit(30), score - 20)).otherwise(score).cast("int"),
        "interaction_type": kind,
        "anomaly_flag": F.when(canceled, "Behavioral").otherwise(_completeness_cases("None", "None", "Technical")),
        "research_suitability": _completeness_cases("All", "Spatial", "Limited")})


def statistical_fallback_labels(profile: DataFrame) -> DataFrame:
    """The enhanced path's own fallback: 80 / 60 / 30 by completeness, no anomaly."""
    return profile.withColumns({
        "quality_score": _completeness_cases(80, 60, 30).cast("int"),
        "interaction_type": F.when(F.col("n") > 1, _by_duration()).otherwise("Unknown"),
        "anomaly_flag": F.lit("None"),
        "research_suitability": _completeness_cases("All", "Spatial", "Limited")})


def validate_labels(df: DataFrame, original: DataFrame | None = None,
                    keys: list[str] | None = None) -> DataFrame:
    """Bring label columns into their vocabularies; missing columns get their defaults.

    With the original events at hand, x and y are taken from them.
    """
    score = F.col("quality_score").try_cast("double") if "quality_score" in df.columns else F.lit(None)
    checked = {"quality_score": clip(F.coalesce(score.cast("double"), F.lit(50.0)), 0.0, 100.0).cast("int")}
    for name, allowed in (("interaction_type", INTERACTION_TYPES), ("anomaly_flag", ANOMALY_FLAGS)):
        default = F.lit(DEFAULT_LABELS[name])
        checked[name] = (F.when(F.col(name).isin(*allowed), F.col(name)).otherwise(default)
                         if name in df.columns else default)
    name = "research_suitability"
    default = F.lit(DEFAULT_LABELS[name])
    if name in df.columns:
        known = F.forall(F.split(name, ","), lambda tag: F.trim(tag).isin(*SUITABILITY_TAGS))
        checked[name] = F.when(known, F.col(name)).otherwise(default)
    else:
        checked[name] = default
    result = df.withColumns(checked)
    if original is not None:
        source = original.select(*keys, F.col("x").alias("_ox"), F.col("y").alias("_oy"))
        result = (result.join(source, keys, "left")
                  .withColumns({"x": F.col("_ox"), "y": F.col("_oy")}).drop("_ox", "_oy"))
    return result


# Advice by score band, pattern, anomaly and tier; in this order.
_HIGH_ADVICE = ["timing_analysis", "spatial_analysis", "completion_tracking"]
_MIDDLE_ADVICE = ["general_analysis", "pattern_recognition"]
_LOW_ADVICE = ["quality_research"]
_PATTERN_ADVICE = {"deliberate": "user_intent_analysis", "erratic": "error_analysis",
                   "tap": "interaction_timing_analysis", "drag": "movement_analysis"}
_TIER_ADVICE = {"high": "primary_analysis", "medium": "secondary_analysis", "low": "exploratory_analysis"}


def _by_score(high: list[str], middle: list[str]) -> Column:
    def listed(names):
        return F.array(*[F.lit(n) for n in names])
    return (F.when(F.col("ml_quality_score") > 0.8, listed(high))
            .when(F.col("ml_quality_score") > 0.5, listed(middle)).otherwise(listed(_LOW_ADVICE)))


def _advice(column: str, names: dict[str, str]) -> list[Column]:
    return [flag_if(F.col(column) == value, name) for value, name in names.items()]


def recommendations(variant: str = "cleaning") -> Column:
    """Usage advice per row: variants 'cleaning' (all parts), 'short' (no tap, drag, tier) and
    'simple' (short lists, own patterns)."""
    outlier = [flag_if(F.col("anomaly_type") == "outlier", "outlier_investigation")]
    if variant == "cleaning":
        rest = _advice("behavioral_pattern", _PATTERN_ADVICE) + outlier + _advice("quality_tier", _TIER_ADVICE)
        return F.concat(_by_score(_HIGH_ADVICE, _MIDDLE_ADVICE), flag_list(rest))
    if variant == "short":
        short = {k: _PATTERN_ADVICE[k] for k in ("deliberate", "erratic")}
        return F.concat(_by_score(_HIGH_ADVICE, _MIDDLE_ADVICE), flag_list(_advice("behavioral_pattern", short) + outlier))
    if variant == "simple":
        names = {"tap": "interaction_timing_analysis", "drag": "movement_analysis", "interrupted": "error_analysis"}
        return F.concat(_by_score(_HIGH_ADVICE[:2], _MIDDLE_ADVICE[:1]), flag_list(_advice("behavioral_pattern", names)))
    raise ValueError(f"unknown variant {variant}")
