"""Exact nearest neighbours inside each session, without pairing all its points.

Points of a session are laid along a Z-order curve and cut into cells of bounded size, so a cell is a
compact stretch with a bounding box. Each query point first searches its own cell, which bounds the
distance of its k-th neighbour; it then visits only the cells whose box lies within that bound. Boxes
are compared in two levels (blocks of cells, then cells). Only the best k of a visit leave the task.

Equal points must be merged by the caller (``weight`` = number of copies), so that copies, however many,
are one point. Missing values are allowed: the distance over shared features, scaled up for missing ones, is
never below that over the ``axes`` (the features used for the boxes) that both points have. Points that lack
the same axes lie together; a cell that lacks an axis for some point is unbounded along it.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from fingertrail.operators.groups import CHUNK, SESSION, _range_chunks, split_sessions
from fingertrail.session import store

CELL_ROWS = 4000
TASK_ROWS = 2_000_000  # rows that one task cuts into cells, so the driver plans few partitions
BLOCK = 500       # cells per block in the first box comparison
PAIRS = 30_000   # distances held at once, few enough for a core's cache
_SCHEMA = "nid long, dist double, copies long"


@F.pandas_udf(LongType())
def _z_order(scaled: pd.Series) -> pd.Series:
    """Interleave the bits of coordinates given as numbers in [0, 1]."""
    if not len(scaled):
        return pd.Series([], dtype="int64")
    grid = np.stack(scaled.to_numpy()).astype(float)
    bits = 60 // grid.shape[1]
    cells = np.clip(np.nan_to_num(grid) * (2 ** bits - 1), 0, 2 ** bits - 1).astype(np.int64)
    code = np.zeros(len(grid), dtype=np.int64)
    for bit in range(bits):
        for axis in range(grid.shape[1]):
            code |= ((cells[:, axis] >> bit) & 1) << (bit * grid.shape[1] + axis)
    return pd.Series(code)


def cells_of(points: DataFrame, axes: list[str], cell_rows: int = CELL_ROWS,
             at_most: int | None = None) -> DataFrame:
    """Points with their cell in column ``_chunk``; a table that fits one cell needs no layout."""
    rows = points.count() if at_most is None else at_most
    if rows <= cell_rows:
        return points.withColumn(CHUNK, F.lit(0).cast("long"))
    spans = points.groupBy(SESSION).agg(
        *[F.min(a).alias(f"_lo_{a}") for a in axes], *[F.max(a).alias(f"_hi_{a}") for a in axes])
    joined = points.join(spans, SESSION)
    scaled = F.array(*[F.coalesce(F.try_divide(F.col(a) - F.col(f"_lo_{a}"), F.col(f"_hi_{a}") - F.col(f"_lo_{a}")),
                                  F.lit(0.0)) for a in axes])
    lacks = reduce(lambda a, b: a + b, [F.col(a).isNull().cast("int") * 2 ** i for i, a in enumerate(axes)])
    coded = joined.select(*points.columns, lacks.alias("_lacks"), _z_order(scaled).alias("_z"))
    order = ["_lacks", "_z", "pid"]
    pieces = max(-(-rows // TASK_ROWS), min(-(-rows // cell_rows), points.sparkSession.sparkContext.defaultParallelism))
    ranged = _range_chunks(coded, [SESSION], order, -(-rows // pieces), rows)
    place = F.row_number().over(Window.partitionBy(SESSION, CHUNK).orderBy(*order)) - 1
    cell = F.col(CHUNK).cast("long") * (2 ** 31) + F.floor(place / cell_rows)
    return store(ranged.withColumn(CHUNK, cell).drop("_lacks", "_z"))


def _boxes(cells: DataFrame, axes: list[str]) -> DataFrame:
    """Extent of each cell; without limit along an axis that a point of it lacks."""
    def side(pick, a, limit):
        return F.when(F.count(a) < F.count(F.lit(1)), F.lit(limit)).otherwise(pick(a))

    return cells.groupBy(SESSION, CHUNK).agg(
        *[side(F.min, a, float("-inf")).alias(f"lo_{a}") for a in axes],
        *[side(F.max, a, float("inf")).alias(f"hi_{a}") for a in axes])


def _full_cells(cells: DataFrame, features: list[str], k: int) -> DataFrame:
    """For each cell the nearest cell along the curve with more than k donors, and where its values lie (f_lo, f_hi)."""
    sides = [F.min(f).alias(f"f_lo_{f}") for f in features] + [F.max(f).alias(f"f_hi_{f}") for f in features]
    table = cells.groupBy(SESSION, CHUNK).agg(F.sum(F.when(F.col("gives"), F.col("weight"))).alias("_points"))
    donors = cells.filter("gives").groupBy(SESSION, CHUNK).agg(*sides)
    names = [f"f_{s}_{f}" for s in ("lo", "hi") for f in features]
    full = F.when(F.col("_points") > k, F.struct(*names))
    along = Window.partitionBy(SESSION).orderBy(CHUNK)
    before = F.last(full, ignorenulls=True).over(along.rowsBetween(Window.unboundedPreceding, 0))
    after = F.first(full, ignorenulls=True).over(along.rowsBetween(0, Window.unboundedFollowing))
    return table.join(donors, [SESSION, CHUNK], "left").select(SESSION, CHUNK, F.coalesce(before, after).alias("_full"))


def _gap(a: str, left: str, right: str) -> Column:
    """Distance of two intervals along one axis."""
    return F.greatest(F.lit(0.0), F.col(f"{left}lo_{a}") - F.col(f"{right}hi_{a}"),
                      F.col(f"{right}lo_{a}") - F.col(f"{left}hi_{a}"))


def _box_distance2(axes, left, right) -> Column:
    return reduce(lambda p, q: p + q, [_gap(a, left, right) * _gap(a, left, right) for a in axes])


def _prefixed(df: DataFrame, prefix: str) -> DataFrame:
    return df.select(*[F.col(c).alias(prefix + c) if c != SESSION else F.col(c) for c in df.columns])


def _near_cells(queries: DataFrame, boxes: DataFrame, axes: list[str]) -> DataFrame:
    """Pairs (session, cell, other cell) within the largest search radius of the cell."""
    reach = queries.groupBy(SESSION, CHUNK).agg(F.max("radius").alias("_reach"))
    asking = boxes.join(reach, [SESSION, CHUNK])
    block = F.floor(F.col(CHUNK) / BLOCK)
    sides = [F.min(f"lo_{a}").alias(f"lo_{a}") for a in axes] + [F.max(f"hi_{a}").alias(f"hi_{a}") for a in axes]
    left = asking.groupBy(SESSION, block.alias("block")).agg(*sides, F.max("_reach").alias("_reach"))
    right = boxes.groupBy(SESSION, block.alias("block")).agg(*sides)
    # one box per block: the first comparison is over summaries of summaries
    blocks = (_prefixed(left, "l_").join(_prefixed(right, "r_"), SESSION)
              .filter(_box_distance2(axes, "l_", "r_") <= F.col("l__reach") * F.col("l__reach"))
              .select(SESSION, "l_block", "r_block"))
    left = _prefixed(asking.withColumn("block", block), "l_")
    right = _prefixed(boxes.withColumn("block", block), "r_")
    return (blocks.join(left, [SESSION, "l_block"]).join(right, [SESSION, "r_block"])
            .filter((F.col(f"l_{CHUNK}") != F.col(f"r_{CHUNK}"))
                    & (_box_distance2(axes, "l_", "r_") <= F.col("l__reach") * F.col("l__reach")))
            .select(SESSION, F.col(f"l_{CHUNK}").alias(CHUNK), F.col(f"r_{CHUNK}").alias("_to"),
                    *[F.col(f"r_{s}_{a}").alias(f"{s}_{a}") for s in ("lo", "hi") for a in axes]))


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances over the features present on both sides, scaled up for the missing ones."""
    total = np.zeros((len(a), len(b)))
    if a.shape[1] and np.isfinite(a).all() and np.isfinite(b).all():  # nothing is missing
        gap = np.empty_like(total)
        for j in range(a.shape[1]):
            np.subtract(a[:, j, None], b[None, :, j], out=gap)
            np.multiply(gap, gap, out=gap)
            total += gap
        return np.sqrt(total, out=total)
    present = np.zeros((len(a), len(b)))
    for j in range(a.shape[1]):
        gap = a[:, j, None] - b[None, :, j]
        known = ~np.isnan(gap)
        total += np.where(known, gap * gap, 0.0)
        present += known
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(present > 0, np.sqrt(total * (a.shape[1] / present)), np.inf)


def _best(queries: pd.DataFrame, donors: pd.DataFrame, features: list[str], k: int) -> pd.DataFrame:
    """The nearest donors of each query, up to k copies; ties go to the smaller id."""
    found = []
    donors = donors.sort_values("pid")
    ids, copies = donors["pid"].to_numpy(), donors["weight"].to_numpy()
    target = np.asfortranarray(donors[features].to_numpy(dtype=float))
    asked, values = queries["pid"].to_numpy(), queries[features].to_numpy(dtype=float)
    step = max(1, PAIRS // max(1, len(donors)))
    for start in range(0, len(asked), step):
        own = asked[start:start + step]
        distance = _distances(values[start:start + step], target)
        # a point is its own neighbour only through its copies
        same = own[:, None] == ids[None, :]
        distance[copies[None, :] <= same] = np.inf
        if not distance.size:
            continue
        # the k + 1 smallest of a row and what equals the last of them; only these are sorted, ties in the order of ids
        reach = np.partition(distance, min(k, len(ids) - 1), axis=1)[:, min(k, len(ids) - 1)]
        row, col = np.divmod(np.flatnonzero(distance <= np.minimum(reach, np.finfo(float).max)[:, None]), len(ids))
        near = distance[row, col]
        order = np.lexsort((near, row))
        row, col, near = row[order], col[order], near[order]
        held = copies[col] - same[row, col]
        first = np.searchsorted(row, row)
        before = np.cumsum(held) - held
        kept = (before - before[first] < k) & (np.arange(len(row)) - first <= k)
        found.append((own[row[kept]], ids[col[kept]], near[kept], held[kept]))
    names = ["pid", "nid", "dist", "copies"]
    return pd.DataFrame({n: np.concatenate(parts) for n, parts in zip(names, zip(*found))} if found else {n: [] for n in names})


def whole_session(points: pd.DataFrame, features: list[str], k: int) -> pd.DataFrame:
    """(pid, nid, dist, take): the k nearest donors of the query points of a session that fits one cell."""
    found = _best(points[points["asks"]], points[points["gives"]], features, k)
    found = found.iloc[np.lexsort([found[c].to_numpy() for c in ("nid", "dist", "pid")])]
    before = found.groupby("pid")["copies"].cumsum() - found["copies"]
    found = found.assign(take=np.minimum(found["copies"], k - before))
    return found[before < k].drop(columns="copies")  # rows with a common id share their k neighbours


def nearest(points: DataFrame, features: list[str], axes: list[str], k: int,
            cell_rows: int = CELL_ROWS, at_most: int | None = None) -> DataFrame:
    """(session_id, pid, nid, dist, take): the k nearest donors of each query point.

    ``points`` has session_id, pid (unique in the session), weight, asks, gives (booleans) and the
    features. ``take`` is how many copies of the neighbour count towards the k. A session of at most ``cell_rows`` points is
    one cell and searched where its points are; larger ones are laid out.
    """
    names = list(dict.fromkeys([SESSION, "pid", "weight", "asks", "gives", *features, *axes]))
    kind = points.schema[SESSION].dataType.simpleString()
    parts = split_sessions(points.select(*names), cell_rows, at_most)

    def whole(pdf: pd.DataFrame) -> pd.DataFrame:
        found = whole_session(pdf, features, k)
        return found.assign(**{SESSION: pdf[SESSION].iloc[0]})[[SESSION, "pid", "nid", "dist", "take"]]

    small = parts.cold.groupBy(SESSION).applyInPandas(whole, f"{SESSION} {kind}, pid long, nid long, dist double, take long")
    if parts.hot is None:
        return small
    return small.unionByName(_nearest_large(parts.hot.drop(CHUNK), features, axes, k, cell_rows, parts.hot_count, kind))


def _nearest_large(points: DataFrame, features: list[str], axes: list[str], k: int, cell_rows: int, rows: int, kind: str) -> DataFrame:
    cells = cells_of(points, axes, cell_rows, rows)
    schema = f"{SESSION} {kind}, {CHUNK} long, pid long, {_SCHEMA}"

    def own(pdf: pd.DataFrame) -> pd.DataFrame:
        found = _best(pdf[pdf["asks"]], pdf[pdf["gives"]], features, k)
        return found.assign(**{SESSION: pdf[SESSION].iloc[0], CHUNK: pdf[CHUNK].iloc[0]})[
            [SESSION, CHUNK, "pid", "nid", "dist", "copies"]]

    local = cells.groupBy(SESSION, CHUNK).applyInPandas(own, schema)
    local = store(local)
    cut = (cells.select(SESSION, CHUNK).distinct().groupBy(SESSION).agg(F.count(F.lit(1)).alias("_cells"))
           .filter(F.col("_cells") > 1).select(SESSION))
    asking = cells.filter("asks").join(cut, SESSION, "left_semi")
    bound = local.groupBy(SESSION, "pid").agg(F.sum("copies").alias("_found"), F.max("dist").alias("_kth"))
    # a point with fewer than k neighbours in its cell is bounded by a full cell near it: the scaled distance to a
    # donor there is at most the largest gap of a shared feature times the root of the number of features
    givers = _boxes(cells.filter("gives"), axes)
    gaps = [F.coalesce(F.greatest(F.abs(F.col(f) - F.col(f"_full.f_lo_{f}")), F.abs(F.col(f) - F.col(f"_full.f_hi_{f}"))), F.lit(0.0))
            for f in features]
    far = F.when(F.col("_full").isNotNull(), reduce(F.greatest, gaps) * len(features) ** 0.5).otherwise(F.lit(float("inf")))
    radius = F.when(F.coalesce("_found", F.lit(0)) >= k, F.col("_kth")).otherwise(far)
    asking = (asking.join(bound, [SESSION, "pid"], "left").join(_full_cells(cells, features, k), [SESSION, CHUNK], "left")
              .withColumn("radius", radius).select(*cells.columns, "radius"))
    pairs = _near_cells(asking, givers.unionByName(
        _boxes(cells.filter("asks"), axes).join(givers.select(SESSION, CHUNK), [SESSION, CHUNK], "left_anti")), axes)
    gap2 = reduce(lambda p, q: p + q, [F.coalesce(
        F.pow(F.greatest(F.lit(0.0), F.col(f"lo_{a}") - F.col(a), F.col(a) - F.col(f"hi_{a}")), 2), F.lit(0.0)) for a in axes])
    visits = (asking.join(pairs, [SESSION, CHUNK]).filter(gap2 <= F.col("radius") * F.col("radius"))
              .select(SESSION, F.col("_to").alias(CHUNK), "pid", "weight", *[f for f in features]))
    # many visitors of one cell are spread over copies of the cell
    guests = visits.groupBy(SESSION, CHUNK).agg(F.ceil(F.count(F.lit(1)) / cell_rows).cast("int").alias("_salts"))
    visits = visits.join(guests, [SESSION, CHUNK]).withColumn("_salt", F.pmod(F.xxhash64("pid"), F.col("_salts")).cast("int"))
    hosts = (cells.filter("gives").join(guests, [SESSION, CHUNK])
             .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.col("_salts") - 1))))

    def visit(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({SESSION: [], CHUNK: [], "pid": [], "nid": [], "dist": [], "copies": []})
        found = _best(left, right, features, k)
        return found.assign(**{SESSION: left[SESSION].iloc[0], CHUNK: left[CHUNK].iloc[0]})[
            [SESSION, CHUNK, "pid", "nid", "dist", "copies"]]

    # fresh column identities, as both sides of the cogroup come from the same cells
    hosts = hosts.toDF(*hosts.columns)
    visits = visits.toDF(*visits.columns)
    group = [SESSION, CHUNK, "_salt"]
    remote = visits.groupBy(*group).cogroup(hosts.groupBy(*group)).applyInPandas(visit, schema)
    return _top(local.unionByName(remote), k)


def _top(found: DataFrame, k: int) -> DataFrame:
    window = Window.partitionBy(SESSION, "pid").orderBy("dist", "nid")
    before = F.coalesce(F.sum("copies").over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return (found.withColumn("_before", before).filter(F.col("_before") < k)
            .select(SESSION, "pid", "nid", "dist", F.least(F.col("copies"), F.lit(k) - F.col("_before")).alias("take")))
