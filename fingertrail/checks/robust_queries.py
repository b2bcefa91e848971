"""Query of the robust covariance, with the same steps in SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from fingertrail.checks.catalog import query
from fingertrail.checks.sql import STEPS as FEATURES
from fingertrail.checks.sql import TOUCH, sql
from fingertrail.operators import features, robust
from fingertrail.sources.touch_view import touch_view


def _moments(name: str, source: str, kept: str) -> str:
    return (f"{name} AS (SELECT session_id, avg(a) AS ma, avg(b) AS mb, var_samp(a) AS va, var_samp(b) AS vb, covar_samp(a, b) AS c "
            f"FROM {source} WHERE {kept} GROUP BY session_id)")


_D = "(power(a - ma, 2) * vb - 2 * (a - ma) * (b - mb) * c + power(b - mb, 2) * va) / (va * vb - c * c)"


def _steps() -> str:
    parts = ["rc0 AS (SELECT session_id, event_id, coalesce(distance, 0) AS a, coalesce(time_diff, 0) AS b FROM f3)"]
    for s in range(robust.STARTS):
        parts.append(f"rs{s}_0 AS (SELECT *, (event_id * 7919 + {s * 104729}) % {robust.PLACES} < {int(robust.PLACES * robust.SUPPORT)} AS kept FROM rc0)")
        for k in range(robust.STEPS):
            parts += [_moments(f"rm{s}_{k}", f"rs{s}_{k}", "kept"),
                      f"rd{s}_{k} AS (SELECT x.*, {_D} AS d FROM rc0 x JOIN rm{s}_{k} USING (session_id))",
                      f"rs{s}_{k + 1} AS MATERIALIZED (SELECT session_id, event_id, a, b, d <= quantile_cont(d, {robust.SUPPORT}) OVER (PARTITION BY session_id) AS kept FROM rd{s}_{k})"]
        parts.append(_moments(f"rf{s}", f"rs{s}_{robust.STEPS}", "kept"))
    every = " UNION ALL ".join(f"SELECT *, va * vb - c * c AS det, {s} AS start FROM rf{s}" for s in range(robust.STARTS))
    half, near = robust.chi_squared(0.5, 2), robust.chi_squared(robust.NEAR, 2)
    parts += [f"rb AS (SELECT * FROM ({every}) QUALIFY row_number() OVER (PARTITION BY session_id ORDER BY det, start) = 1)",
              f"rr AS (SELECT x.*, {_D} AS d FROM rc0 x JOIN rb USING (session_id))",
              f"rn AS (SELECT *, d / (quantile_cont(d, 0.5) OVER (PARTITION BY session_id) / {half!r}) < {near!r} AS kept FROM rr)",
              _moments("rl", "rn", "kept"),
              f"rz AS (SELECT x.*, sqrt(greatest({_D}, 0)) AS d FROM rc0 x JOIN rl USING (session_id))"]
    return ",\n".join(parts)


@query("robust_covariance", sql(TOUCH + FEATURES + ",\n" + _steps(), """
SELECT event_id, round(d, 6) AS anomaly_score,
  CASE WHEN d > quantile_cont(d, 0.9) OVER (PARTITION BY session_id) THEN 'outlier' ELSE 'normal' END AS anomaly_type FROM rz"""))
def robust_covariance(spark, sf_dir):
    """Concentration steps from two hashed halves, then the reweighted estimate."""
    rows = robust.robust_distance(features.basic_features(touch_view(spark, sf_dir)), ["distance", "time_diff"], "event_id").rows()
    return rows.select("event_id", F.round("anomaly_score", 6).alias("anomaly_score"), "anomaly_type")
