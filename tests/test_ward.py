"""Ward linkage and silhouettes against plain forms over all pairs."""

import numpy as np
import pytest

from fingertrail.operators import ward


def plain_ward(x, k):
    groups = [[i] for i in range(len(x))]
    while len(groups) > k:
        best = min((len(a) * len(b) / (len(a) + len(b)) * ((x[a].mean(0) - x[b].mean(0)) ** 2).sum(), i, j)
                   for i, a in enumerate(groups) for j, b in enumerate(groups) if i < j)
        _, i, j = best
        groups[i] += groups.pop(j)
    return {frozenset(g) for g in groups}


def frame(spark, x, labels=None):
    rows = [(i, *map(float, v), int(labels[i]) if labels is not None else 0) for i, v in enumerate(x)]
    return spark.createDataFrame(rows, "id long, a double, b double, label int").repartition(5)


def parts(df):
    found = {}
    for r in df.collect():
        found.setdefault(r["cluster"], set()).add(r["id"])
    return {frozenset(v) for v in found.values()}


@pytest.mark.parametrize("seed", range(3))
def test_ward_equals_all_pairs(spark, seed):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(70, 2)) + rng.integers(0, 3, (70, 1)) * 2
    x = np.r_[x, x[:12]]  # equal points
    for k in (1, 2, 4, 9):
        assert parts(ward.ward(frame(spark, x), ["a", "b"], k)) == plain_ward(x, k)


def test_many_points_become_a_bounded_number_of_leaves(spark):
    rng = np.random.default_rng(9)
    centres = np.array([[0, 0], [50, 0], [0, 50], [50, 50]])
    own = rng.integers(0, 4, 6000)
    x = centres[own] + rng.normal(size=(6000, 2))
    df = frame(spark, x, own)
    placed = ward.with_leaves(df, ["a", "b"], most=200)
    assert 20 < placed.select("_leaf").distinct().count() <= 200
    got = ward.ward(df, ["a", "b"], 4, most=200)
    assert got.select("label", "cluster").distinct().count() == 4 and got.count() == 6000


def plain_silhouette(x, labels):
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    out = []
    for i in range(len(x)):
        same = labels == labels[i]
        if same.sum() == 1:
            out.append(0.0)
            continue
        a = d[i, same].sum() / (same.sum() - 1)
        b = min(d[i, labels == c].mean() for c in set(labels.tolist()) if c != labels[i])
        out.append((b - a) / max(a, b) if max(a, b) > 0 else 0.0)
    return float(np.mean(out))


def test_silhouette_is_exact_for_few_points_and_bounded_for_many(spark):
    rng = np.random.default_rng(2)
    labels = rng.integers(-1, 3, 400)
    labels[0] = 7  # alone
    x = rng.normal(size=(400, 2)) + labels[:, None] * 1.5
    x[300:] = np.round(x[300:], 1)
    want, df = plain_silhouette(x, labels), frame(spark, x, labels)
    exact = ward.silhouette(df, ["a", "b"], "label").first()
    assert exact["silhouette"] == pytest.approx(want, abs=1e-9) and exact["highest"] - exact["lowest"] < 1e-9
    rough = ward.silhouette(df, ["a", "b"], "label", most=150).first()
    assert rough["lowest"] <= want <= rough["highest"] and rough["highest"] - rough["lowest"] < 0.9 and abs(rough["silhouette"] - want) < 0.05


def test_no_rows_and_one_cluster(spark):
    df = frame(spark, np.ones((3, 2)))
    assert ward.silhouette(df, ["a", "b"], "label").first()["silhouette"] == 0.0
    assert parts(ward.ward(df, ["a", "b"])) == {frozenset({0, 1, 2})}
    assert ward.ward(df.limit(0), ["a", "b"]).count() == 0


def test_values_that_change_between_passes(spark):
    """Means added up anew differ in the last digits: leaves and rows must still be those of one pass."""
    import random

    from pyspark.sql import functions as F

    shaken = F.udf(lambda v: v + random.random() * 1e-3, "double").asNondeterministic()
    rng = np.random.default_rng(5)
    df = frame(spark, rng.normal(size=(900, 2)), rng.integers(0, 3, 900)).withColumn("a", shaken("a"))
    line = ward.silhouette(df, ["a", "b"], "label", most=100).first()
    assert line["lowest"] <= line["silhouette"] <= line["highest"]
    assert ward.ward(df, ["a", "b"], 3, most=100).count() == 900
