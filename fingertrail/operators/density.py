"""DBSCAN inside each session on a grid, for up to four features.

The grid's cells have a diagonal of eps, so the points of a cell are within eps of each other: a cell of
``min_points`` or more holds core points only and needs no distances, and the core points of a cell
belong to one cluster, so cells (not points) are the nodes of the cluster graph. Distances are computed
for points of sparse cells, of which a cell has fewer than ``min_points``, and between one representative
per fine sub-cell of neighbouring cells; points themselves are compared only where representatives
leave a pair of cells undecided. Equal points are merged first.
"""

from __future__ import annotations

import itertools
import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fingertrail.operators.groups import SESSION
from fingertrail.session import settle, store

FINE = 4  # sub-cells along each side of a cell
SALT_ROWS = 50_000


def _distance2(features: list[str], left: str, right: str) -> Column:
    gaps = [F.col(f"{left}{f}") - F.col(f"{right}{f}") for f in features]
    return reduce(lambda a, b: a + b, [g * g for g in gaps])


def _offsets(dimensions: int, own: bool) -> list[tuple[int, ...]]:
    """Cells that can hold points within eps of a point of this cell."""
    reach = math.ceil(math.sqrt(dimensions))
    found = []
    for offset in itertools.product(range(-reach, reach + 1), repeat=dimensions):
        gap = sum(max(0, abs(o) - 1) ** 2 for o in offset)
        if gap <= dimensions and (own or any(offset)):
            found.append(offset)
    return found


def _spread(df: DataFrame, cells: list[str], offsets) -> DataFrame:
    """One row per cell in reach; the target cell is in columns t_<cell>."""
    targets = F.array(*[F.struct(*[(F.col(c) + F.lit(o)).alias(f"t_{c}") for c, o in zip(cells, offset)])
                        for offset in offsets])
    return df.withColumn("_t", F.explode(targets)).select(*df.columns, "_t.*")


def _renamed(df: DataFrame, prefix: str) -> DataFrame:
    return df.select(*[F.col(c).alias(f"{prefix}{c}") if c != SESSION else F.col(c) for c in df.columns])


def connected_components(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """(session_id, node, component) with the smallest node of each component as its name.

    Alternates linking each node's larger neighbours to its smallest one and its smaller neighbours to
    the smallest, until nothing changes; the number of rounds grows with the logarithm of the size.
    """

    def star(pairs: DataFrame, large: bool) -> DataFrame:
        both = pairs.unionByName(pairs.select(SESSION, F.col("b").alias("a"), F.col("a").alias("b")))
        hub = both.groupBy(SESSION, "a").agg(F.least(F.min("b"), F.first("a")).alias("_min"))
        linked = both.join(hub, [SESSION, "a"])
        kept = linked.filter(F.col("b") > F.col("a")) if large else linked.filter(F.col("b") < F.col("a"))
        moved = kept.select(SESSION, F.col("b").alias("a"), F.col("_min").alias("b"))
        if not large:
            moved = moved.unionByName(linked.select(SESSION, "a", F.col("_min").alias("b")))
        return moved.filter(F.col("a") != F.col("b")).distinct()

    pairs = store(edges.select(SESSION, F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter(
        F.col("a") != F.col("b")).distinct())
    state = None
    while True:
        pairs = store(star(star(pairs, large=True), large=False))
        line = pairs.agg(F.count(F.lit(1)), F.sum("b"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(line) == state:
            break
        state = tuple(line)
    return nodes.join(pairs.select(SESSION, F.col("a").alias("node"), F.col("b").alias("_low")), [SESSION, "node"], "left").select(
        SESSION, "node", F.coalesce("_low", "node").alias("component"))


def dbscan(table: DataFrame, row_id: str, features: list[str], eps: float = 0.5, min_points: int = 5) -> DataFrame:
    """Rows with ``kind`` (core, border, noise) and ``cluster`` (smallest core id; null for noise).

    A border point joins the cluster with the smallest name among the cores in reach.
    """
    if not 1 <= len(features) <= 4:
        raise ValueError("the grid is meant for one to four features")
    table = settle(table)  # the points found are joined back by their features
    clean = table.withColumns({f: F.coalesce(F.col(f).cast("double"), F.lit(0.0)) for f in features})
    side = eps / math.sqrt(len(features))
    cells = [f"_g{i}" for i in range(len(features))]
    eps2 = F.lit(eps * eps)
    points = (clean.groupBy(SESSION, *features)
              .agg(F.min(F.col(row_id).cast("long")).alias("pid"), F.count(F.lit(1)).alias("weight"))
              .withColumns({c: F.floor(F.col(f) / side) for c, f in zip(cells, features)}))
    sizes = points.groupBy(SESSION, *cells).agg(F.sum("weight").alias("_w"), F.count(F.lit(1)).alias("_n"))
    points = store(points.join(sizes, [SESSION, *cells]))

    # counts of the points in sparse cells; the points of a large target cell are spread by a salt
    sparse = points.filter(F.col("_w") < min_points)
    salts = F.greatest(F.lit(1), F.ceil(F.col("_n") / SALT_ROWS)).cast("int")
    asking = _spread(sparse.select(SESSION, "pid", *features, *cells), cells, _offsets(len(features), own=True))
    target_sizes = sizes.select(SESSION, *[F.col(c).alias(f"t_{c}") for c in cells], salts.alias("_salts"))
    asking = (asking.join(target_sizes, [SESSION, *[f"t_{c}" for c in cells]])
              .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.col("_salts") - 1))))
    target = points.withColumn("_salt", F.pmod(F.xxhash64("pid"), salts).cast("int"))
    target = target.select(SESSION, "_salt", *[F.col(c).alias(f"t_{c}") for c in cells],
                           *[F.col(f).alias(f"o_{f}") for f in features], F.col("pid").alias("o_pid"),
                           F.col("weight").alias("o_weight"))
    meets = (asking.join(target, [SESSION, "_salt", *[f"t_{c}" for c in cells]])
             .filter(_distance2(features, "", "o_") <= eps2))
    counted = meets.groupBy(SESSION, "pid").agg(F.sum("o_weight").alias("_near"))
    points = store(points.join(counted, [SESSION, "pid"], "left")
              .withColumn("_core", (F.col("_w") >= min_points) | (F.coalesce("_near", F.lit(0)) >= min_points))
              .drop("_near"))
    core = points.filter("_core")

    # cells with core points are the nodes; their name is the smallest core id
    named = core.groupBy(SESSION, *cells).agg(F.min("pid").alias("node"))
    fine = [f"_f{i}" for i in range(len(features))]
    placed = core.join(named, [SESSION, *cells]).withColumns(
        {f: F.floor(F.col(v) / (side / FINE)) for f, v in zip(fine, features)})
    reps = store(placed.groupBy(SESSION, *cells, "node", *fine).agg(
        F.min_by(F.struct(*features), "pid").alias("_p")).select(
        SESSION, *cells, "node", *fine, *[F.col("_p")[f].alias(f) for f in features]))
    left = _spread(reps, cells, [o for o in _offsets(len(features), own=False) if o > tuple([0] * len(o))])
    left = _renamed(left.drop(*cells), "l_")
    right = _renamed(reps, "r_")
    same = [F.col(f"l_t_{c}") == F.col(f"r_{c}") for c in cells]
    joined = left.join(right.withColumnRenamed(SESSION, "_s"), reduce(lambda a, b: a & b, same) & (F.col(SESSION) == F.col("_s")))
    gap = F.sqrt(_distance2(features, "l_", "r_"))
    # a representative stands for points up to one sub-cell diagonal away, on both sides
    slack = 2 * (side / FINE) * math.sqrt(len(features))
    close = joined.withColumn("_gap", gap).filter(F.col("_gap") <= eps + slack)
    pairs = close.groupBy(SESSION, "l_node", "r_node").agg(F.min("_gap").alias("_gap"))
    linked = pairs.filter(F.col("_gap") <= eps)
    open_pairs = close.join(pairs.filter(F.col("_gap") > eps).select(SESSION, "l_node", "r_node"),
                            [SESSION, "l_node", "r_node"], "left_semi").select(
        SESSION, "l_node", "r_node", *[f"{s}_{f}" for s in ("l", "r") for f in fine])
    members = placed.select(SESSION, "node", *fine, *features)
    # a left member stays if any right member is in reach: the search stops at the first, no pair is put out
    asked = open_pairs.join(_renamed(members, "l_"), [SESSION, "l_node", *[f"l_{f}" for f in fine]])
    reachable = _renamed(members, "r_").withColumnsRenamed({SESSION: "_s", "r_node": "_m", **{f"r_{f}": f"_m_{f}" for f in fine}})
    same = [(SESSION, "_s"), ("r_node", "_m"), *[(f"r_{f}", f"_m_{f}") for f in fine]]
    decided = asked.join(reachable, reduce(lambda a, b: a & b, [F.col(a) == F.col(b) for a, b in same])
                         & (_distance2(features, "l_", "r_") <= eps2), "left_semi").select(SESSION, "l_node", "r_node").distinct()
    edges = linked.select(SESSION, "l_node", "r_node").unionByName(decided).toDF(SESSION, "a", "b")
    components = connected_components(edges, named.select(SESSION, "node"))
    owner = named.join(components, [SESSION, "node"]).select(SESSION, *cells, "component")
    core_cluster = core.join(owner, [SESSION, *cells]).select(SESSION, "pid", F.col("component").alias("cluster"))

    reached = meets.select(SESSION, "pid", "o_pid").join(
        core_cluster.select(SESSION, F.col("pid").alias("o_pid"), "cluster"), [SESSION, "o_pid"])
    border = (reached.groupBy(SESSION, "pid").agg(F.min("cluster").alias("_border"))
              .join(points.filter(~F.col("_core")).select(SESSION, "pid"), [SESSION, "pid"]))
    labelled = (points.join(core_cluster, [SESSION, "pid"], "left").join(border, [SESSION, "pid"], "left")
                .select(SESSION, *features,
                        F.when(F.col("_core"), "core").when(F.col("_border").isNotNull(), "border").otherwise("noise").alias("kind"),
                        F.coalesce("cluster", "_border").alias("cluster")))
    return clean.join(labelled, [SESSION, *features])
