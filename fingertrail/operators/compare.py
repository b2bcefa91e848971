"""Choosing between anomaly detectors and clusterings by their comparison lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fingertrail.operators.anomaly import covariance_distance, scale, statistical_outliers
from fingertrail.operators.cluster import anomaly_comparison_line, cluster, clustering_comparison_line, compare_scalers
from fingertrail.operators.density import dbscan
from fingertrail.operators.forest import isolation_forest
from fingertrail.operators.groups import SESSION, Touches, split_sessions
from fingertrail.operators.neighbours import local_outlier_factor
from fingertrail.session import settle

DETECTORS = ["statistical", "isolation_forest", "covariance", "local_outlier_factor"]
CLUSTERINGS = ["kmeans", "dbscan", "gaussian_mixture", "ward"]


def detect_with(touches: Touches, how: str, features: list[str]) -> Touches:
    """Anomaly marks by one detector; with fewer than three features every event is normal."""
    if len(features) < 3:
        return touches.with_columns(anomaly_score=F.lit(0.0), anomaly_type=F.lit("normal"),
                                    anomaly_confidence=F.lit(0.0))
    if how == "statistical":
        return statistical_outliers(touches, features)
    if how == "isolation_forest":
        return isolation_forest(touches, features)
    if how == "covariance":
        return covariance_distance(touches, features)
    if how == "local_outlier_factor":
        rows = local_outlier_factor(touches.rows(), "event_id", features, hot_rows=touches.hot_rows, at_most=touches.at_most)
        return split_sessions(rows, touches.hot_rows, touches.at_most)
    raise ValueError(f"unknown detector {how}")


def best_scaler(df: DataFrame, features: list[str], hot_rows: int, at_most: int | None = None) -> str:
    """Name of the scaler with the highest score."""
    lines = compare_scalers(df, features, hot_rows, at_most)
    return lines.orderBy(F.desc("overall_score"), "scaler").first()["scaler"]


def scaled_copies(touches: Touches, features: list[str], how: str) -> tuple[Touches, list[str]]:
    """Rows with a scaled copy of each feature, stored once for all detectors, and the names of the copies."""
    names = [f"scaled_{f}" for f in features]
    rows = touches.rows().withColumns({n: F.col(f) for n, f in zip(names, features)})
    scaled = scale(rows, names, how, touches.hot_rows, touches.at_most)
    return split_sessions(scaled, touches.hot_rows, touches.at_most).materialise(), names


def advanced_anomalies(touches: Touches, features: list[str]) -> tuple[Touches, str, str]:
    """Anomaly marks by the best detector on features scaled by the best scaler, and the names of both.

    All detectors see the same rows and the same scaled features, so their lines compare.
    """
    touches = touches.materialise()  # read for each scaler
    scaler = best_scaler(touches.rows(), features, touches.hot_rows, touches.at_most)
    rows, names = scaled_copies(touches, features, scaler)
    detector = best_detector(rows, names)
    return detect_with(rows, detector, names).drop(*names), scaler, detector


def compare_detectors(touches: Touches, features: list[str]) -> DataFrame:
    """One line per detector of events."""
    lines = None
    for how in DETECTORS:
        line = anomaly_comparison_line(detect_with(touches, how, features).rows(), how)
        lines = line if lines is None else lines.unionByName(line)
    return lines


def best_detector(touches: Touches, features: list[str]) -> str:
    """Name of the detector with the highest score; one line is fetched."""
    return compare_detectors(touches, features).orderBy(F.desc("overall_score"), "algorithm").first()["algorithm"]


def compare_clusterings(df: DataFrame, row_id: str, features: list[str], eps: float = 0.5,
                        min_points: int = 5) -> DataFrame:
    """One line per clustering of the whole table."""
    df, lines = settle(df), None  # all clusterings see the same rows
    for how in CLUSTERINGS:
        if how == "dbscan":
            # all rows form one group here, as in the other clusterings; ids must be unique in it
            whole = settle(df.withColumn(SESSION, F.lit(0)))
            found = dbscan(whole, row_id, features, eps, min_points)
            found = found.withColumn("cluster", F.coalesce("cluster", F.lit(-1)))
        else:
            found = cluster(df, features, how)
        line = clustering_comparison_line(found, features, how)
        lines = line if lines is None else lines.unionByName(line)
    return lines
