"""Ward linkage and silhouettes over any number of points, through a bounded number of cluster features.

Points are summed up as leaves: a count, the sums of the values and of their squares, over the cells of a grid. Up to LEAVES
different points are a leaf each, and everything here is exact; beyond that, the cells are the finest of a ladder of grids
that has no more. Leaves come from combinable aggregates, and only they, a bounded table, are merged on one machine.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fingertrail.functions.numeric import finite_or_zero
from fingertrail.session import settle

LEAVES = 4_096
#: The ladder of grids: the widest cells are the values' whole range, each further grid halves them.
GRIDS = 24


def _values(features: list[str]) -> list[Column]:
    return [finite_or_zero(F.col(f)) for f in features]


def with_leaves(df: DataFrame, features: list[str], group: list[str] | None = None, most: int = LEAVES) -> DataFrame:
    """df with ``_leaf``, the cell of each row, such that at most about ``most`` different (group, cell) occur.

    The cells of different points are the points themselves while these are no more than ``most``. Missing and infinite values
    count as 0.
    """
    group, values = group or [], _values(features)
    point = F.array(*values)
    if df.select(*group, point.alias("_leaf")).distinct().limit(most + 1).count() <= most:
        return df.withColumn("_leaf", point)
    ends = df.agg(*[F.min(v).alias(f"a{k}") for k, v in enumerate(values)], *[F.max(v).alias(f"b{k}") for k, v in enumerate(values)]).first()
    spans = [(ends[f"a{k}"], (ends[f"b{k}"] - ends[f"a{k}"]) or 1.0) for k in range(len(values))]

    def cells(grid: int) -> list[Column]:
        return [F.floor((v - low) / (span / 2**grid)).cast("double") for v, (low, span) in zip(values, spans)]

    grid = 1  # from wide cells to narrow ones: a grid has few times the cells of the one before
    while grid + 1 < GRIDS and df.select(*group, F.array(*cells(grid + 1)).alias("_leaf")).distinct().limit(most + 1).count() <= most:
        grid += 1
    return df.withColumn("_leaf", F.array(*cells(grid)))


def leaf_features(df: DataFrame, features: list[str], group: list[str] | None = None) -> DataFrame:
    """Per (group, leaf) the count, the mean of each value and the mean squared distance of its points from it."""
    values = _values(features)
    rows = df.groupBy(*(group or []), "_leaf").agg(
        F.count(F.lit(1)).alias("n"), *[F.avg(v).alias(f"m{k}") for k, v in enumerate(values)], *[F.var_pop(v).alias(f"v{k}") for k, v in enumerate(values)])
    return rows.select(*(group or []), "_leaf", "n", F.array(*[F.col(f"m{k}") for k in range(len(values))]).alias("mean"),
                       reduce(lambda a, b: a + b, [F.col(f"v{k}") for k in range(len(values))]).alias("spread"))


def ward_labels(n: np.ndarray, mean: np.ndarray, k: int) -> np.ndarray:
    """Cluster number of each leaf after merging down to k clusters, by chains of nearest neighbours.

    The cost of a merger is the growth of the squared distances from the means. Clusters are numbered by their means.
    """
    size, centre = n.astype(float).copy(), mean.astype(float).copy()
    active, merges, chain = np.ones(len(n), bool), [], []

    def costs(a: int) -> np.ndarray:
        d = ((centre - centre[a]) ** 2).sum(1) * (size * size[a] / (size + size[a]))
        d[~active] = np.inf
        d[a] = np.inf
        return d

    while active.sum() > 1:
        if not chain:
            chain.append(int(np.flatnonzero(active)[0]))
        a = chain[-1]
        d = costs(a)
        b = int(d.argmin())
        if len(chain) > 1 and d[chain[-2]] <= d[b]:  # nearest to each other: merge
            b = chain[-2]
            merges.append((float(d[b]), min(a, b), max(a, b)))
            low, high = min(a, b), max(a, b)
            centre[low] = (centre[low] * size[low] + centre[high] * size[high]) / (size[low] + size[high])
            size[low] += size[high]
            active[high] = False
            chain = chain[:-2]
        else:
            chain.append(b)
    root = np.arange(len(n))

    def top(v: int) -> int:
        while root[v] != v:
            v = root[v]
        return v

    for _, a, b in sorted(merges, key=lambda m: m[0])[:max(0, len(n) - k)]:
        root[top(b)] = top(a)
    tops = np.array([top(v) for v in range(len(n))])
    found = sorted(set(tops.tolist()), key=lambda t: tuple(np.average(mean[tops == t], axis=0, weights=n[tops == t]).tolist()))
    number = {t: c for c, t in enumerate(found)}
    return np.array([number[t] for t in tops.tolist()], int)


def ward(df: DataFrame, features: list[str], k: int = 4, most: int = LEAVES) -> DataFrame:
    """df with ``cluster``: ward linkage cut at k clusters; fewer different points make fewer clusters."""
    df = settle(df)
    placed = with_leaves(df, features, most=most)
    leaves = leaf_features(placed, features).orderBy("_leaf").collect()  # at most about `most`
    if not leaves:
        return df.withColumn("cluster", F.lit(0))
    labels = ward_labels(np.array([r["n"] for r in leaves]), np.array([r["mean"] for r in leaves]), k)
    table = df.sparkSession.createDataFrame([(r["_leaf"], int(c)) for r, c in zip(leaves, labels)], "_leaf array<double>, cluster int")
    return placed.drop("cluster").join(F.broadcast(table), "_leaf").drop("_leaf")


def silhouette(df: DataFrame, features: list[str], cluster: str = "cluster", most: int = LEAVES) -> DataFrame:
    """One row: the mean silhouette by true distances, and bounds (lowest, highest) between which the exact one lies.

    A point's mean distance to a cluster is taken to its leaves; by the triangle inequality it is off by no more than the leaves'
    mean radius. With up to ``most`` different (cluster, point) the three numbers are the same. A point alone in its cluster counts 0,
    as do all points where there is one cluster.
    """
    placed = with_leaves(settle(df), features, [cluster], most)  # the cells of the leaves must be those of the rows
    leaves = leaf_features(placed, features, [cluster]).orderBy(cluster, "_leaf").collect()  # at most about `most`
    names = sorted({r[cluster] for r in leaves})
    if len(names) < 2:
        return df.sparkSession.createDataFrame([(0.0, 0.0, 0.0)], "silhouette double, lowest double, highest double")
    of = np.array([names.index(r[cluster]) for r in leaves])
    n, mean = np.array([r["n"] for r in leaves], float), np.array([r["mean"] for r in leaves], float)
    radius = np.sqrt(np.array([max(r["spread"], 0.0) for r in leaves]))  # at least the mean distance from the leaf's mean
    total = np.bincount(of, n, len(names))
    error = np.bincount(of, n * radius, len(names)) / total
    centres, starts = [np.ascontiguousarray(c) for c in mean.T], np.searchsorted(of, np.arange(len(names)))  # leaves come by cluster
    own_leaf = {(r[cluster], tuple(r["_leaf"])): k for k, r in enumerate(leaves)}

    def score(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        top = np.maximum(a, b)
        return np.where(top > 0, (b - a) / np.where(top > 0, top, 1), 0.0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, count = np.zeros(3), 0
        for whole in batches:
            for at in range(0, whole.num_rows, 32):  # few enough for the distances to stay in a core's cache
                batch = whole.slice(at, 32)
                x = batch.column(2).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
                label = np.array([names.index(v) for v in batch.column(0).to_pylist()])
                leaf = [own_leaf[v, tuple(c)] for v, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
                d = np.zeros((len(x), len(n)))
                for k, centre in enumerate(centres):
                    gap = x[:, k, None] - centre
                    gap *= gap
                    d += gap
                np.sqrt(d, out=d)
                rows = np.arange(len(x))
                far = np.add.reduceat(d * n, starts, axis=1)
                others = np.maximum(total[label] - 1, 1)
                a = (far[rows, label] - d[rows, leaf]) / others
                far = far / total
                wide = error[label] * total[label] / others + d[rows, leaf] / others * (radius[leaf] > 0)
                mine = far.copy()
                mine[rows, label] = np.inf
                b = mine.min(1)
                spread = (mine + error).min(1), np.where(np.isinf(mine), np.inf, mine - error).min(1)
                alone = total[label] == 1
                for k, s in enumerate((score(a, b), score(a + wide, np.maximum(spread[1], 0)), score(np.maximum(a - wide, 0), spread[0]))):
                    sums[k] += np.where(alone, 0.0, s).sum()
                count += len(x)
        yield pa.RecordBatch.from_pydict({"s": [sums[0]], "low": [sums[1]], "high": [sums[2]], "n": [count]})

    parts = placed.select(cluster, "_leaf", F.array(*_values(features)).alias("x")).mapInArrow(run, "s double, low double, high double, n long")
    return parts.agg(*[(F.sum(c) / F.sum("n")).alias(name) for c, name in (("s", "silhouette"), ("low", "lowest"), ("high", "highest"))])
