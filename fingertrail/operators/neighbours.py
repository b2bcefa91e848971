"""Operators over nearest neighbours: imputation of missing values and the local outlier factor."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fingertrail.functions.numeric import step
from fingertrail.operators.advanced_features import encode_categories
from fingertrail.operators.groups import CHUNK, SESSION, Previous, Quantile, Touches, split_sessions
from fingertrail.operators.near import CELL_ROWS, nearest, whole_session
from fingertrail.operators.segment import FINGER
from fingertrail.schema import time_order
from fingertrail.session import settle, store

NUMERIC = ["x", "y", "time", "completionPerc", "accx", "accy", "accz"]
CATEGORIES = ["touchPhase", "color", "zone"]


def cleaning_features(touches: Touches) -> tuple[Touches, list[str]]:
    """Numeric columns, encoded categories, and steps along the finger; and their names."""
    numeric = [c for c in NUMERIC if c in touches.columns]
    categories = [c for c in CATEGORIES if c in touches.columns]
    rows = encode_categories(touches, categories)
    rows = (rows.arrange(FINGER, time_order(touches.columns))
            .running(_t=Previous(F.col("time")), _px=Previous(F.col("x")), _py=Previous(F.col("y")))
            .with_columns(_dt=step("time", "_t"), _dd=F.sqrt(
                F.pow(step("x", "_px"), 2) + F.pow(step("y", "_py"), 2)))
            .drop("_t", "_px", "_py"))
    return rows, [*numeric, *[f"{c}_encoded" for c in categories], "_dt", "_dd"]


def impute_nearest(touches: Touches, row_id: str = "event_id", columns: tuple[str, ...] | None = None,
                   k: int = 5, cell_rows: int = CELL_ROWS, features: list[str] | None = None) -> Touches:
    """Fill missing values with the distance-weighted mean of the k nearest events of the session.

    Without ``columns`` these are all numeric columns that lack a value somewhere, coordinates included; each is
    filled from events that have it, by the values as they were. Distances use all cleaning features present on both events. A neighbour at distance 0 decides alone.
    Rows that carry the features already are given with their names.
    """
    described = features is not None
    rows = touches
    if not described:
        rows, features = cleaning_features(touches)
        rows = rows.materialise()  # read for points, donors and the result
    imputed = F.lit(False)
    wanted = [c for c in (NUMERIC if columns is None else columns) if c in touches.columns]
    lacking = rows.rows().agg(F.lit(0).alias("_"), *[F.count_if(F.col(c).isNull()).alias(c) for c in wanted]).first()
    columns = [c for c in wanted if lacking[c]]
    for name in columns:
        points = rows.rows().select(
            SESSION, F.col(row_id).cast("long").alias("pid"), F.lit(1).cast("long").alias("weight"),
            F.col(name).isNull().alias("asks"), F.col(name).isNotNull().alias("gives"),
            *[F.col(f).cast("double").alias(f) for f in features])
        near = nearest(points, features, ["time", "x", "y"], k, cell_rows, touches.at_most)
        donors = points.filter("gives").select(SESSION, F.col("pid").alias("nid"), F.col(name).alias("_given"))
        equal, other = F.col("dist") == 0, F.col("dist") > 0
        at_zero = F.try_divide(F.sum(F.when(equal, F.col("_given"))), F.count_if(equal))
        weighted = F.try_divide(F.sum(F.when(other, F.col("_given") / F.col("dist"))),
                                F.sum(F.when(other, 1 / F.col("dist"))))
        filled = (near.join(donors, [SESSION, "nid"]).groupBy(SESSION, F.col("pid").alias("_pid"))
                  .agg(F.coalesce(at_zero, weighted).alias(f"_new_{name}")))
        rows = rows.with_columns(_pid=F.col(row_id).cast("long")).attach(filled, [SESSION, "_pid"]).drop("_pid")
        imputed = imputed | (F.col(name).isNull() & F.col(f"_new_{name}").isNotNull())
    rows = rows.with_columns(imputed=imputed)
    rows = rows.with_columns(**{name: F.coalesce(name, f"_new_{name}") for name in columns})
    rows = rows.drop(*[f"_new_{c}" for c in columns])
    return rows if described else rows.drop(*[f for f in features if f not in touches.columns])


def local_outlier_factor(table: DataFrame, row_id: str, features: list[str], k: int = 20, share: float = 0.1,
                         hot_rows: int | None = None, at_most: int | None = None,
                         cell_rows: int = CELL_ROWS) -> DataFrame:
    """Local outlier factor of the rows of each session, and the share with the largest as outliers.

    Rows with equal features are one point with a weight. Missing features count as 0. Sessions of at most ``cell_rows``
    points are done where their points are; only the neighbours of larger ones are shuffled.
    """
    table = settle(table)  # scores are joined back by the features
    clean = table.withColumns({f: F.coalesce(F.col(f).cast("double"), F.lit(0.0)) for f in features})
    points = (clean.groupBy(SESSION, *features)
              .agg(F.min(F.col(row_id).cast("long")).alias("pid"), F.count(F.lit(1)).alias("weight"))
              .withColumn("asks", F.lit(True)).withColumn("gives", F.lit(True)))
    points = store(points)
    parts = split_sessions(points, cell_rows, at_most)
    kind = points.schema[SESSION].dataType.simpleString()

    def whole(pdf: pd.DataFrame) -> pd.DataFrame:
        return _factors(whole_session(pdf, features, k)).assign(**{SESSION: pdf[SESSION].iloc[0]})[[SESSION, "pid", "anomaly_score"]]

    factor = parts.cold.groupBy(SESSION).applyInPandas(whole, f"{SESSION} {kind}, pid long, anomaly_score double")
    if parts.hot is not None:
        factor = factor.unionByName(_large_factors(parts.hot.drop(CHUNK), features, k, cell_rows, parts.hot_count))
    scored = points.select(SESSION, *features, "pid").join(factor, [SESSION, "pid"], "left").drop("pid")
    rows = split_sessions(clean, hot_rows, at_most).attach(scored, [SESSION, *features])
    rows = rows.totals([SESSION], _limit=Quantile(F.col("anomaly_score"), 1 - share))
    outlier = F.coalesce(F.col("anomaly_score") > F.col("_limit"), F.lit(False))
    return rows.with_columns(anomaly_type=F.when(outlier, "outlier").otherwise("normal"),
                             anomaly_confidence=F.abs("anomaly_score")).drop("_limit").rows()


def _factors(near: pd.DataFrame) -> pd.DataFrame:
    """(pid, anomaly_score) of a session's points from all their neighbours."""
    kth = near.groupby("pid")["dist"].max()
    taken = near["take"].groupby(near["pid"]).sum()
    reach = np.maximum(near["dist"], near["nid"].map(kth)) * near["take"]
    density = 1.0 / (reach.groupby(near["pid"]).sum() / taken + 1e-10)
    mean = (near["nid"].map(density) * near["take"]).groupby(near["pid"]).sum() / taken
    return (mean / density).rename("anomaly_score").rename_axis("pid").reset_index()


def _large_factors(points: DataFrame, features: list[str], k: int, cell_rows: int, rows: int) -> DataFrame:
    near = store(nearest(points, features, features, k, cell_rows, rows))
    reach = near.groupBy(SESSION, F.col("pid").alias("nid")).agg(F.max("dist").alias("_kth"))
    linked = near.join(reach, [SESSION, "nid"])
    mean_reach = F.sum(F.greatest("dist", "_kth") * F.col("take")) / F.sum("take")
    density = linked.groupBy(SESSION, "pid").agg((F.lit(1.0) / (mean_reach + 1e-10)).alias("_lrd"))
    of_neighbour = density.select(SESSION, F.col("pid").alias("nid"), F.col("_lrd").alias("_nlrd"))
    return (near.join(of_neighbour, [SESSION, "nid"])
            .groupBy(SESSION, "pid").agg((F.sum(F.col("_nlrd") * F.col("take")) / F.sum("take")).alias("_mean"))
            .join(density, [SESSION, "pid"])
            .select(SESSION, "pid", (F.col("_mean") / F.col("_lrd")).alias("anomaly_score")))
