"""The robust covariance: resists planted outliers, equals plain steps, and does not depend on the size of a session."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from fingertrail.operators import robust
from fingertrail.operators.groups import split_sessions


def test_quantiles_of_the_distance():
    for q in (0.1, 0.5, 0.975):
        assert robust.chi_squared(q, 2) == pytest.approx(-2 * math.log(1 - q), rel=1e-9)
    assert robust.chi_squared(0.95, 1) == pytest.approx(3.841458820694124, rel=1e-9) and robust.chi_squared(0.5, 5) == pytest.approx(4.351460191095526, rel=1e-9)


def plain(x, keys, starts=robust.STARTS, steps=robust.STEPS):
    def squared(mean, cov):
        return np.einsum("ij,jk,ik->i", x - mean, np.linalg.pinv(cov), x - mean)

    best = None
    for s in range(starts):
        kept = (keys * 7919 + s * 104729) % robust.PLACES < int(robust.PLACES * robust.SUPPORT)
        for _ in range(steps):
            d = squared(x[kept].mean(0), np.cov(x[kept].T))
            kept = d <= np.quantile(d, robust.SUPPORT)
        det = np.linalg.det(np.cov(x[kept].T))
        if best is None or det < best[0]:
            best = det, kept
    d = squared(x[best[1]].mean(0), np.cov(x[best[1]].T))
    near = d / (np.median(d) / robust.chi_squared(0.5, x.shape[1])) < robust.chi_squared(robust.NEAR, x.shape[1])
    return np.sqrt(squared(x[near].mean(0), np.cov(x[near].T)))


@pytest.mark.parametrize("hot_rows", [10_000, 60])
def test_equals_plain_steps_and_resists_outliers(spark, hot_rows):
    rng = np.random.default_rng(4)
    data = {}
    for session in range(2):
        x = rng.normal(size=(200, 3)) @ np.array([[3, 1, 0], [0, 1, 0.5], [0, 0, 0.2]])
        x[:50] += [400, -300, 100]  # a quarter lies far off
        data[session] = x
    rows = [(s, s * 1000 + k, *map(float, v)) for s, x in data.items() for k, v in enumerate(x)]
    touches = split_sessions(spark.createDataFrame(rows, "session_id long, event_id long, a double, b double, c double"), hot_rows)
    got = {(r["session_id"], r["event_id"]): r for r in robust.robust_distance(touches, ["a", "b", "c"], "event_id", share=0.25).rows().collect()}
    for s, x in data.items():
        want = plain(x, s * 1000 + np.arange(200))
        assert [got[s, s * 1000 + k]["anomaly_score"] for k in range(200)] == pytest.approx(want.tolist(), rel=1e-6)
        assert [got[s, s * 1000 + k]["anomaly_type"] == "outlier" for k in range(200)] == [k < 50 for k in range(200)]


def test_rows_without_spread(spark):
    rows = [(1, k, 5.0, None if k % 2 else float("nan")) for k in range(20)] + [(2, 50, 1.0, 2.0)]
    touches = split_sessions(spark.createDataFrame(rows, "session_id long, event_id long, a double, b double"))
    got = robust.robust_distance(touches, ["a", "b"], "event_id").rows()
    assert got.count() == 21 and got.filter((F.col("anomaly_score") > 1e-6) | (F.col("anomaly_type") != "normal")).count() == 0
