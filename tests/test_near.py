"""Neighbours, density clusters and long spectra against brute force on small data."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from fingertrail.operators import near
from fingertrail.operators.density import dbscan
from fingertrail.operators.near import nearest
from fingertrail.operators.spectrum import long_spectrum_peaks


def test_nearest_equals_brute_force(spark):
    rng = np.random.default_rng(1)
    data = np.r_[rng.normal(size=(150, 2)), rng.normal(size=(60, 2)) * 0.01 + 5]
    rows = [(1, i, 1, True, True, float(a), float(b)) for i, (a, b) in enumerate(data)]
    df = spark.createDataFrame(rows, "session_id long, pid long, weight long, asks boolean, gives boolean, a double, b double")
    got = {}
    for r in nearest(df, ["a", "b"], ["a", "b"], 5, cell_rows=30).collect():
        got.setdefault(r.pid, []).append((round(r.dist, 9), r.nid))
    gaps = np.sqrt(((data[:, None] - data[None]) ** 2).sum(-1))
    np.fill_diagonal(gaps, np.inf)
    for i in range(len(data)):
        want = sorted((round(gaps[i, j], 9), j) for j in np.argsort(gaps[i])[:5])
        assert sorted(got[i]) == want, i


def test_missing_values_and_extra_features(spark):
    rng = np.random.default_rng(5)
    data = np.r_[rng.normal(size=(160, 3)), rng.normal(size=(60, 3)) * 0.01 + 5]
    data[rng.random(data.shape) < 0.1] = np.nan
    data[100:140, 0] = np.nan
    gives = rng.random(len(data)) < 0.7
    gives[:40] = False  # whole stretches without donors
    rows = [(1, i, 1, True, bool(g), *(None if np.isnan(v) else float(v) for v in row)) for i, (row, g) in enumerate(zip(data, gives))]
    df = spark.createDataFrame(rows, "session_id long, pid long, weight long, asks boolean, gives boolean, a double, b double, c double")
    got = {}
    for r in nearest(df, ["a", "b", "c"], ["a", "b"], 4, cell_rows=25).collect():
        got.setdefault(r.pid, []).append(round(r.dist, 9))
    for i in range(len(data)):
        gap = (data[i] - data) ** 2
        shared = (~np.isnan(gap)).sum(1)
        with np.errstate(divide="ignore", invalid="ignore"):
            dist = np.where(shared > 0, np.sqrt(np.nansum(gap, axis=1) * 3 / shared), np.inf)
        dist[~gives] = np.inf
        dist[i] = np.inf
        assert np.allclose(sorted(got.get(i, [])), np.sort(dist[np.isfinite(dist)])[:4]), i


def test_dbscan_clusters(spark):
    rng = np.random.default_rng(2)
    data = np.r_[rng.normal(size=(60, 2)) * 0.2, rng.normal(size=(60, 2)) * 0.2 + 4, rng.uniform(-6, 10, size=(15, 2))]
    df = spark.createDataFrame([(1, i, float(a), float(b)) for i, (a, b) in enumerate(data)],
                               "session_id long, pid long, a double, b double")
    found = {r.pid: (r.kind, r.cluster) for r in dbscan(df, "pid", ["a", "b"], 0.5, 5).collect()}
    near = np.sqrt(((data[:, None] - data[None]) ** 2).sum(-1)) <= 0.5
    core = near.sum(1) >= 5
    label = np.where(core, np.arange(len(data)), len(data))
    while True:
        new = label.copy()
        for i in np.flatnonzero(core):
            new[i] = min(label[j] for j in np.flatnonzero(near[i] & core))
        if (new == label).all():
            break
        label = new
    for i in range(len(data)):
        if core[i]:
            assert found[i] == ("core", label[i])
        else:
            cores = np.flatnonzero(near[i] & core)
            assert found[i] == (("border", min(label[cores])) if len(cores) else ("noise", None))


def test_long_spectrum(spark):
    rng = np.random.default_rng(3)
    values = rng.normal(size=37) + 2 * np.cos(2 * np.pi * 5 * np.arange(37) / 37)
    df = spark.createDataFrame([(1, i, 37, float(v)) for i, v in enumerate(values)], "k long, _pos long, _n long, _w double")
    power = np.abs(np.fft.rfft(values)) ** 2
    assert long_spectrum_peaks(df, ["k"]).first()["_peak"] == int(np.argmax(power))


def test_sessions_of_one_cell_are_searched_where_they_are(spark, monkeypatch):
    """No layout and no table of forests for sessions that one task holds, however many there are."""
    from fingertrail.operators import near
    from fingertrail.operators.forest import isolation_forest
    from fingertrail.operators.groups import split_sessions

    def layout(*_):
        raise AssertionError("small sessions are not laid out")

    monkeypatch.setattr(near, "cells_of", layout)
    rng = np.random.default_rng(3)
    at = rng.integers(0, 6, (90, 2)).astype(float)  # many ties
    copies = rng.integers(1, 3, 90)
    rows = [(i % 6, i, int(copies[i]), True, True, *map(float, at[i])) for i in range(90)]
    points = spark.createDataFrame(rows, "session_id int, pid long, weight long, asks boolean, gives boolean, a double, b double")
    found = {}
    for r in nearest(points, ["a", "b"], ["a", "b"], 4, cell_rows=15, at_most=90).collect():
        found.setdefault(r["pid"], []).append((r["dist"], r["nid"], r["take"]))
    for i in range(90):
        others = sorted((float(np.sqrt(((at[i] - at[j]) ** 2).sum())), j) for j in range(i % 6, 90, 6) for _ in range(copies[j] - (i == j)))
        want = {}
        for d, j in others[:4]:
            want[d, j] = want.get((d, j), 0) + 1
        assert sorted(found[i]) == sorted((d, j, n) for (d, j), n in want.items())
    events = points.select("session_id", F.col("pid").alias("event_id"), "a", "b")
    marked = isolation_forest(split_sessions(events), ["a", "b"]).rows()
    assert "CoGroups" not in marked._jdf.queryExecution().toString() and marked.count() == 90


def test_distances_are_held_in_bounded_blocks(monkeypatch):
    """A search holds a bounded number of distances at once, and finds what one block finds, gaps or not."""
    rng, held = np.random.default_rng(3), []
    whole = near._distances

    def watched(a, b):
        held.append(len(a) * len(b))
        return whole(a, b)

    monkeypatch.setattr(near, "_distances", watched)
    for gaps in (False, True):
        values = rng.integers(0, 12, (700, 3)).astype(float)
        if gaps:
            values[rng.random(values.shape) < 0.1] = np.nan
        points = pd.DataFrame(values, columns=["a", "b", "c"]).assign(pid=rng.permutation(700), weight=1, asks=True, gives=True)
        found = near.whole_session(points, ["a", "b", "c"], 5)
        distance = whole(values, values)
        np.fill_diagonal(distance, np.inf)
        ids = points["pid"].to_numpy()
        for row in range(0, 700, 50):
            best = sorted((d, i) for d, i in zip(distance[row], ids) if np.isfinite(d))[:5]
            own = found[found["pid"] == ids[row]]
            assert list(zip(own["dist"], own["nid"])) == best and (own["take"] == 1).all()
    assert max(held) <= 100_000
