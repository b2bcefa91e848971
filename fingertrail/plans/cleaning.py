"""Composed jobs: the cleaning paths from events to labelled events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fingertrail.operators import anomaly, features, flags, labels, metrics, quality, segment
from fingertrail.operators.groups import Touches
from fingertrail.schema import LABEL_COLUMNS

QUALITY_COLUMNS = ["ml_quality_score", "quality_tier", "sequence_completeness", "temporal_consistency",
                   "spatial_consistency"]
BEHAVIOUR_COLUMNS = ["behavioral_pattern", "interaction_style", "user_intent_confidence", "movement_type"]
VERSION = "enhanced_v1.0"


def flag_coloring(touches: Touches) -> Touches:
    """Segmentation and rule flags of Coloring events."""
    return flags.apply_flag_rules(segment.segment_sequences(touches))


def flag_tracing(touches: Touches) -> Touches:
    """Segmentation and row flags of Tracing events."""
    return flags.apply_tracing_flag_rules(segment.segment_tracing_sequences(touches))


def detect_anomalies(touches: Touches, how: str = "simple") -> Touches:
    """Anomaly marks by the session z-score, or by an isolation forest."""
    if how == "forest":
        from fingertrail.operators.forest import isolation_forest
        names = [c for c in ("x", "y", "time", "completionPerc") if c in touches.columns]
        return isolation_forest(touches, names)
    return anomaly.simple_anomalies(touches)


def describe(touches: Touches, anomalies: str = "simple") -> Touches:
    """Events with features, anomaly marks, quality and behaviour of their touch."""
    rows = detect_anomalies(features.extract_all_features(touches), anomalies)
    keys, _ = features.sequence_keys(rows.columns)
    profile = quality.behaviour(quality.sequence_quality(quality.touch_profile(rows)))
    return rows.attach(profile.select(*keys, *QUALITY_COLUMNS, *BEHAVIOUR_COLUMNS), keys)


def label_touches(touches: Touches, anomalies: str = "simple") -> DataFrame:
    """The primary labels per touch of flagged events."""
    rows = detect_anomalies(features.extract_all_features(touches), anomalies)
    return labels.consolidated_labels(quality.touch_profile(rows))


def clean_and_enhance(touches: Touches, variant: str = "cleaning", anomalies: str = "forest") -> Touches:
    """The enhanced cleaning path: every original column, plus features, quality, behaviour, anomaly
    marks and usage advice."""
    rows = describe(touches, anomalies).with_columns(usage_recommendations=labels.recommendations(variant))
    if variant == "cleaning":
        rows = rows.with_columns(ml_processing_version=F.lit(VERSION))
    return rows


def clean_simple(touches: Touches) -> Touches:
    """The small cleaning path: basic features, simple quality, behaviour, anomalies and advice."""
    rows = anomaly.simple_anomalies(features.basic_features(touches))
    keys, _ = features.sequence_keys(rows.columns)
    profile = quality.simple_behaviour(quality.simple_quality(quality.touch_profile(rows)))
    table = profile.select(*keys, "ml_quality_score", "quality_tier", "sequence_completeness",
                           "behavioral_pattern", "interaction_style", "user_intent_confidence")
    return rows.attach(table, keys).with_columns(usage_recommendations=labels.recommendations("simple"))


def process_coloring(touches: Touches, anomalies: str = "forest") -> tuple[Touches, DataFrame]:
    """Complete Coloring path: flagged and labelled events, and the metrics table with flags.

    Flagged events are stored: metrics, flags of sequences, labels and the result read them, and would each do the windows again.
    """
    rows = flag_coloring(touches).materialise()
    table = flags.attach_metric_flags(metrics.compute_sequence_metrics(rows), flags.sequence_flag_table(rows))
    keys, _ = features.sequence_keys(rows.columns)
    chosen = label_touches(rows, anomalies).select(*keys, *LABEL_COLUMNS)
    return rows.attach(labels.validate_labels(chosen), keys), table


def process_tracing(touches: Touches) -> tuple[Touches, DataFrame]:
    """Complete Tracing path: flagged events labelled by the rules, and the metrics with flags."""
    rows = flag_tracing(touches)
    table = flags.tracing_sequence_flags(metrics.compute_tracing_metrics(rows))
    keys, _ = features.sequence_keys(rows.columns)
    chosen = labels.rule_labels(quality.touch_profile(rows)).select(*keys, *LABEL_COLUMNS)
    return rows.attach(labels.validate_labels(chosen), keys), table
