"""Statistical anomaly marks of events, scalers, and the basic cleaning marks."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from fingertrail.functions.numeric import finite_or_zero
from fingertrail.functions.phases import is_phase
from fingertrail.operators.groups import HOT_ROWS_DEFAULT, Position, Quantile, Touches, table_quantiles
from fingertrail.schema import COLORING_PHASES, EPS, TRACING_PHASES

SESSION = ["session_id"]


def simple_anomalies(touches: Touches) -> Touches:
    """z-score of the step distance over the session; outlier above 3. Needs distance."""
    rows = touches.totals(SESSION, _mean=F.avg("distance"), _std=F.stddev_samp("distance"))
    z = F.abs((F.col("distance") - F.col("_mean")) / F.col("_std"))
    spread = F.coalesce(F.col("_std") > 0, F.lit(False))
    return rows.with_columns(_z=F.when(spread, z).otherwise(0.0)).with_columns(
        anomaly_score=F.col("_z") / 3.0,
        anomaly_type=F.when(F.col("_z") > 3, "outlier").otherwise("normal")).drop("_mean", "_std", "_z")


def statistical_outliers(touches: Touches, features: list[str], share: float = 0.9) -> Touches:
    """Sum of large z-scores and of quartile-fence hits per event, averaged over the hits.

    An event is an outlier above the 90th percentile of the session's scores.
    """
    score, hits = F.lit(0.0), F.lit(0)
    helpers = []
    for name in features:
        value = F.when(F.isnan(F.col(name).cast("double")), None).otherwise(F.col(name).cast("double"))
        touches = touches.totals(SESSION, **{
            f"_m_{name}": F.avg(value), f"_s_{name}": F.stddev_samp(value),
            f"_q1_{name}": Quantile(value, 0.25), f"_q3_{name}": Quantile(value, 0.75)})
        mean, std = F.col(f"_m_{name}"), F.col(f"_s_{name}")
        q1, q3 = F.col(f"_q1_{name}"), F.col(f"_q3_{name}")
        z = F.when(std > 0, F.abs((value - mean) / std)).otherwise(0.0)
        far = F.coalesce(z > 3, F.lit(False))
        fence = F.coalesce((q3 > q1) & ((value < q1 - (q3 - q1) * 1.5) | (value > q3 + (q3 - q1) * 1.5)),
                           F.lit(False))
        score = score + F.when(far, z).otherwise(0.0) + F.when(fence, 1.0).otherwise(0.0)
        hits = hits + far.cast("int") + fence.cast("int")
        helpers += [f"_m_{name}", f"_s_{name}", f"_q1_{name}", f"_q3_{name}"]
    rows = touches.with_columns(anomaly_score=score / F.greatest(hits, F.lit(1)))
    rows = rows.totals(SESSION, _limit=Quantile(F.col("anomaly_score"), share), _top=F.max("anomaly_score"))
    return rows.with_columns(
        anomaly_type=F.when(F.col("anomaly_score") > F.col("_limit"), "outlier").otherwise("normal"),
        anomaly_confidence=F.col("anomaly_score") / (F.col("_top") + EPS)).drop("_limit", "_top", *helpers)


# ---- scalers ----------------------------------------------------------------------------------

def scale(df: DataFrame, features: list[str], how: str = "standard", hot_rows: int = HOT_ROWS_DEFAULT,
          at_most: int | None = None) -> DataFrame:
    """Scaled features over the whole table: standard, robust or minmax.

    The parameters are one line from combinable aggregates (exact quartiles for the robust scaler).
    Constant features scale to 0.
    """
    values = {name: finite_or_zero(F.col(name)) for name in features}
    if how == "robust":
        wanted = {}
        for name, value in values.items():
            wanted |= {f"c_{name}": Quantile(value, 0.5), f"_1_{name}": Quantile(value, 0.25),
                       f"_3_{name}": Quantile(value, 0.75)}
        line = table_quantiles(df, wanted, hot_rows, at_most)
        line = line.select(*[f"c_{n}" for n in features],
                           *[(F.col(f"_3_{n}") - F.col(f"_1_{n}")).alias(f"w_{n}") for n in features])
    elif how == "standard":
        line = df.agg(*[F.avg(v).alias(f"c_{n}") for n, v in values.items()],
                      *[F.stddev_pop(v).alias(f"w_{n}") for n, v in values.items()])
    elif how == "minmax":
        line = df.agg(*[F.min(v).alias(f"c_{n}") for n, v in values.items()],
                      *[(F.max(v) - F.min(v)).alias(f"w_{n}") for n, v in values.items()])
    else:
        raise ValueError(f"unknown scaler {how}")
    scaled = [((values[n] - F.col(f"c_{n}")) / F.when(F.col(f"w_{n}") > 0, F.col(f"w_{n}")).otherwise(1.0)).alias(n)
              for n in features]
    others = [c for c in df.columns if c not in features]
    return df.join(F.broadcast(line)).select(*others, *scaled)  # one line


# ---- basic cleaning marks ---------------------------------------------------------------------

def invalid_phases(df: DataFrame, data_type: str = "Coloring") -> DataFrame:
    """Mark events whose phase is not of the recording type."""
    known = COLORING_PHASES if data_type == "Coloring" else TRACING_PHASES
    return df.withColumn("invalid_phase", ~is_phase(*known))


def duplicates(touches: Touches, order: list[str]) -> Touches:
    """Mark all but the first of the events with equal x, y, time and finger in a session.

    Copies of one event may be many, so the first is found by its position in an arranged group,
    which a large session computes in chunks.
    """
    same = ["session_id", "fingerId", "time", "x", "y"]
    rows = touches.arrange(same, order).running(_copy=Position())
    return rows.with_columns(duplicate=F.col("_copy") > 0).drop("_copy")


# ---- covariance distance ----------------------------------------------------------------------

@F.pandas_udf(ArrayType(DoubleType()))
def _inverse(flat: pd.Series) -> pd.Series:
    """Pseudo-inverse of square matrices given row by row; one small matrix per session."""
    def invert(values):
        size = int(round(len(values) ** 0.5))
        matrix = np.asarray(values, dtype=float).reshape(size, size)
        return np.linalg.pinv(np.nan_to_num(matrix)).ravel()
    return flat.map(invert)


def covariance_distance(touches: Touches, features: list[str], share: float = 0.1) -> Touches:
    """Mahalanobis distance of each event from its session, and the farthest ``share`` as outliers."""
    pairs = [(a, b) for a in features for b in features]
    columns = {f"_m_{f}": F.avg(finite_or_zero(F.col(f))) for f in features}
    columns |= {f"_v_{i}": F.covar_samp(finite_or_zero(F.col(a)), finite_or_zero(F.col(b)))
                for i, (a, b) in enumerate(pairs)}
    table = touches.aggregate(SESSION, **columns)
    cells = F.array(*[F.coalesce(F.col(f"_v_{i}"), F.lit(0.0)) for i in range(len(pairs))])
    table = table.select(*SESSION, *[f"_m_{f}" for f in features], _inverse(cells).alias("_inv"))
    rows = touches.attach(table, SESSION)
    off = {f: finite_or_zero(F.col(f)) - F.col(f"_m_{f}") for f in features}
    distance2 = F.lit(0.0)
    for i, (a, b) in enumerate(pairs):
        distance2 = distance2 + off[a] * F.col("_inv")[i] * off[b]
    rows = rows.with_columns(anomaly_score=F.sqrt(F.greatest(distance2, F.lit(0.0))))
    rows = rows.totals(SESSION, _limit=Quantile(F.col("anomaly_score"), 1 - share))
    outlier = F.col("anomaly_score") > F.col("_limit")
    return rows.with_columns(anomaly_type=F.when(outlier, "outlier").otherwise("normal"),
                             anomaly_confidence=F.col("anomaly_score")).drop("_inv", "_limit", *[f"_m_{f}" for f in features])


def basic_cleaning(touches: Touches, data_type: str = "Coloring", order: list[str] | None = None) -> Touches:
    """The basic cleaning marks: invalid_phase, duplicate, imputed (values filled) and outlier."""
    from fingertrail.operators.forest import isolation_forest
    from fingertrail.operators.neighbours import cleaning_features, impute_nearest
    rows = touches.map(lambda df: invalid_phases(df, data_type))
    rows, names = cleaning_features(duplicates(rows, order or ["event_id"]))
    filled = impute_nearest(rows.materialise(), features=names).materialise()
    marked = isolation_forest(filled, names, contamination=0.05)
    return marked.with_columns(outlier=F.col("anomaly_type") == "outlier").drop(
        "anomaly_score", "anomaly_type", "anomaly_confidence", *[n for n in names if n not in touches.columns])
