"""Isolation forest per session: small trees from bounded samples, scoring spread over all rows."""

from __future__ import annotations

from dataclasses import replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fingertrail.functions.numeric import finite_or_zero
from fingertrail.operators.groups import CHUNK, SESSION, Quantile, Touches

TREES = 100
SAMPLE = 256
DEPTH = 8                          # ceil(log2(SAMPLE))
SCORED = 512                       # rows that go down all trees at once
POOL = TREES * SAMPLE              # rows a session's samples are drawn from


def _mean_path(n: np.ndarray) -> np.ndarray:
    """Average path length of an unsuccessful search among n points."""
    n = np.asarray(n, dtype=float)
    harmonic = np.log(np.maximum(n - 1, 1)) + np.euler_gamma
    path = 2 * harmonic - 2 * (n - 1) / np.maximum(n, 1)
    return np.where(n > 2, path, np.where(n == 2, 1.0, 0.0))


def _grow(pool: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """All trees at once, level by level, as complete binary trees.

    Returns per tree and node the split feature (-1: leaf), the threshold and the leaf's path length.
    """
    rng = np.random.default_rng(seed)
    size = min(SAMPLE, len(pool))
    nodes = 2 ** (DEPTH + 1) - 1
    feature = np.full((TREES, nodes), -1, dtype=np.int32)
    threshold = np.zeros((TREES, nodes))
    path = np.zeros((TREES, nodes))
    picked = np.stack([rng.choice(len(pool), size, replace=False) for _ in range(TREES)])
    data = picked.ravel()
    columns = [np.ascontiguousarray(c) for c in pool.T]
    values, width = pool.ravel(), pool.shape[1]
    place = np.repeat(np.arange(TREES) * nodes, size)  # tree and node of each sample
    for level in range(DEPTH + 1):
        order = np.argsort(place.astype(np.uint16), kind="stable")  # below 2 ** 16, sorted by radix
        place, data = place.take(order), data.take(order)
        starts = np.flatnonzero(np.r_[True, place[1:] != place[:-1]]) if len(place) else np.array([], dtype=int)
        if not len(starts):
            break
        counts = np.diff(np.r_[starts, len(place)])
        held = [c.take(data) for c in columns]
        low = np.stack([np.minimum.reduceat(h, starts) for h in held], 1)
        high = np.stack([np.maximum.reduceat(h, starts) for h in held], 1)
        spread = high > low
        # a random feature among those that still vary in the node
        draw = np.where(spread, rng.random(spread.shape), -1.0)
        chosen = draw.argmax(axis=1)
        leaf = ~spread.any(axis=1) | (counts <= 1) | (level == DEPTH)
        row = np.arange(len(starts))
        cut = low[row, chosen] + rng.random(len(starts)) * (high[row, chosen] - low[row, chosen])
        at = place[starts]
        feature.ravel()[at] = np.where(leaf, -1, chosen)
        threshold.ravel()[at] = cut
        path.ravel()[at] = np.where(leaf, level + _mean_path(counts), 0.0)
        stay = np.flatnonzero(np.repeat(~leaf, counts))
        of, data = np.repeat(row, counts).take(stay), data.take(stay)
        right = values.take(data * width + chosen.take(of)) > cut.take(of)
        place = (at + at % nodes + 1).take(of) + right  # the left child, or the one after it
    return feature, threshold, path, size


def _score(values: np.ndarray, feature, threshold, path, size: int) -> np.ndarray:
    """2 ** (-mean path / expected path) of each row."""
    trees, nodes = feature.shape
    # all trees of some rows at once; a leaf leads to itself, by a threshold that no value exceeds
    leaf = (feature < 0).ravel()
    split, limit, ends = np.where(leaf, 0, feature.ravel()), np.where(leaf, np.inf, threshold.ravel()), path.ravel()
    below = np.where(leaf, np.arange(nodes)[None, :].repeat(trees, 0).ravel(), (2 * np.arange(nodes) + 1)[None, :].repeat(trees, 0).ravel())
    below = below + np.arange(trees).repeat(nodes) * nodes
    total = np.zeros(len(values))
    for start in range(0, len(values), SCORED):
        part = np.ascontiguousarray(values[start:start + SCORED]).ravel()
        row = np.arange(len(part) // values.shape[1]) * values.shape[1]
        at = np.broadcast_to((np.arange(trees) * nodes)[:, None], (trees, len(row)))
        for _ in range(DEPTH):
            at = below.take(at) + (part.take(split.take(at) + row) > limit.take(at))
        for found in ends.take(at):  # tree by tree, in a fixed order
            total[start:start + len(row)] += found
    expected = max(float(_mean_path(np.array([size]))[0]), 1e-12)
    return 2.0 ** (-(total / len(feature)) / expected)


def _score_sessions(df: DataFrame, features: list[str], lot: Column, order: list[Column], pool_rows: int) -> DataFrame:
    """Add anomaly_score to sessions of bounded size: a session's forest grows where its rows are, and stays there."""
    names, sorting, columns = df.columns, [f"_k{i}" for i in range(len(order))], [f"_f_{f}" for f in features]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)

    def score(rows: pa.Table) -> pa.Table:
        drawn = rows.column("_lot").to_numpy() < float(pool_rows) / len(rows)
        pool = rows.select([*sorting, *columns]).filter(pa.array(drawn)).to_pandas().sort_values(sorting)
        values = np.column_stack([rows.column(c).to_numpy() for c in columns]).astype(float)
        feature, threshold, path, size = _grow(pool[columns].to_numpy(dtype=float), seed=42)
        return rows.select(names).append_column("anomaly_score", pa.array(_score(values, feature, threshold, path, size)))

    return df.withColumns({**dict(zip(sorting, order)), "_lot": lot}).groupBy(SESSION).applyInArrow(score, f"{schema}, anomaly_score double")


def _score_rows(df: DataFrame, forests: DataFrame, features: list[str]) -> DataFrame:
    """Add anomaly_score; rows arrive in bounded groups (session, chunk), each with its forest."""
    groups = df.select(SESSION, CHUNK).distinct().join(forests, SESSION)
    names = [f for f in df.columns]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)

    def score(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left):
            return left.assign(anomaly_score=[])
        shape = (TREES, -1)
        found = _score(left[[f"_f_{f}" for f in features]].to_numpy(dtype=float),
                       np.asarray(right["feature"].iloc[0]).reshape(shape),
                       np.asarray(right["threshold"].iloc[0]).reshape(shape),
                       np.asarray(right["path"].iloc[0]).reshape(shape), int(right["size"].iloc[0]))
        return left[names].assign(anomaly_score=found)

    groups = groups.toDF(*groups.columns)
    return df.groupBy(SESSION, CHUNK).cogroup(groups.groupBy(SESSION, CHUNK)).applyInPandas(
        score, f"{schema}, anomaly_score double")


def isolation_forest(touches: Touches, features: list[str], row_id: str = "event_id",
                     contamination: float = 0.1, pool_rows: int = POOL) -> Touches:
    """Anomaly score, type and confidence of every event, by a forest of its session.

    The samples of all trees come from a pool of about ``pool_rows`` rows of the session (all, if it has no
    more), drawn by a hash of the row id, so it is the same on every run and a large session is not gathered.
    A tree sees SAMPLE rows in any case; a smaller pool than TREES x SAMPLE makes trees share rows. The
    share ``contamination`` with the highest scores are outliers.
    """
    id_name = row_id if row_id in touches.columns else None
    key = [F.col(id_name)] if id_name else [F.col(c) for c in ("Touchdata_id", "event_index") if c in touches.columns]
    rows = touches.with_columns(**{f"_f_{f}": finite_or_zero(F.col(f)) for f in features})
    lot = F.pmod(F.xxhash64(*key), F.lit(1 << 40)) / F.lit(float(1 << 40))
    values = [f"_f_{f}" for f in features]
    cold = _score_sessions(rows.cold, features, lot, key, pool_rows).drop(*values)
    if rows.hot is None:
        return _marked(replace(rows, cold=cold), contamination)
    rows = replace(rows, hot=rows._stored_hot(), stored=True)
    sizes = rows.hot.groupBy(SESSION).agg(F.count(F.lit(1)).alias("_size"))
    pool = rows.hot.join(sizes, SESSION).filter(lot < F.lit(float(pool_rows)) / F.col("_size")).select(
        SESSION, *values, *[c.alias(f"_k{i}") for i, c in enumerate(key)])
    kind = touches.cold.schema[SESSION].dataType.simpleString()
    order = [f"_k{i}" for i in range(len(key))]

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        values = pdf.sort_values(order)[[f"_f_{f}" for f in features]].to_numpy(dtype=float)
        feature, threshold, path, size = _grow(values, seed=42)
        return pd.DataFrame({SESSION: [pdf[SESSION].iloc[0]], "feature": [feature.ravel()],
                             "threshold": [threshold.ravel()], "path": [path.ravel()], "size": [size]})

    forests = pool.groupBy(SESSION).applyInPandas(
        grow, f"{SESSION} {kind}, feature array<int>, threshold array<double>, path array<double>, size long")

    hot = _score_rows(rows.hot, forests, features).drop(*values)
    return _marked(replace(rows, cold=cold, hot=hot, stored=False), contamination)


def _marked(scored: Touches, contamination: float) -> Touches:
    """Type and confidence by the score's quantile in the session."""
    marked = scored.totals([SESSION], _limit=Quantile(F.col("anomaly_score"), 1 - contamination))
    outlier = F.col("anomaly_score") > F.col("_limit")
    return marked.with_columns(anomaly_type=F.when(outlier, "outlier").otherwise("normal"),
                               anomaly_confidence=F.abs("anomaly_score")).drop("_limit")
