"""Near-duplicate embeddings by sorted projection passes.

Equal vectors of a label become one class with its number of rows. A pass gives every class a word of concatenated
random hashes, the signs of its projections on random directions, and sorts the classes lexicographically by label
and word. Similar vectors share long beginnings of their words, so they come to stand close together; each class is
compared with the next WINDOW ones, and pairs that reach the cosine are links. Further passes with other directions
find what one order parts. The links of all passes are united to components.

The number of passes follows from the largest label: two vectors at the threshold meet if they agree on about
log2(classes / WINDOW) bits, so the share missed by all passes is known and kept below MISSED.

A window is bounded, a group of near copies is not. Its window neighbours tie it to one component, and links lie
inside components; so links are counted in full afterwards, in blocks of at most about BLOCK x BLOCK classes of a
component, of which only sums per class leave the task.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fingertrail.llm.catalog import query
from fingertrail.llm.common import table
from fingertrail.llm.components import components
from fingertrail.session import store

COSINE = 0.98
#: Following neighbours that a vector is compared with in a pass, and hashes in a word.
WINDOW, BITS = 32, 64
#: Expected share of pairs right at the threshold that no pass brings together; passes are at least and at most so many.
MISSED, FEWEST, MOST = 0.005, 4, 64
#: Classes of a component on either side of a block in which links are counted.
BLOCK = 512
#: Rows of a sorted part.
PART_ROWS = 50_000


def passes_for(classes: int, cosine: float = COSINE, window: int = WINDOW) -> int:
    """Passes that leave out at most MISSED of the pairs at the threshold, among so many classes of one label."""
    agree = (1 - math.acos(cosine) / math.pi) ** max(1.0, math.log2(max(classes, 2) / window) + 1)
    return min(MOST, max(FEWEST, math.ceil(math.log(MISSED) / math.log(1 - agree)))) if agree < 1 else FEWEST


def matrix(vectors: pa.Array) -> np.ndarray:
    """Vectors as rows, the largest component scaled to 1, then to unit length; shorter ones filled with zeros."""
    sizes = pc.list_value_length(vectors).to_numpy(zero_copy_only=False)
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    x = np.zeros((len(sizes), int(sizes.max(initial=1))))
    x[np.arange(x.shape[1]) < sizes[:, None]] = flat
    x /= np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def words(vectors: pa.Array, passes: int, seed: int = 13) -> np.ndarray:
    """A word of BITS hashes for each vector and pass; directions depend on the vectors' length alone."""
    sizes = pc.list_value_length(vectors).to_numpy(zero_copy_only=False)
    out = np.zeros((len(sizes), passes), np.int64)
    weight = np.left_shift(np.uint64(1), np.arange(BITS - 1, -1, -1, dtype=np.uint64))
    for size in np.unique(sizes):
        rows = np.flatnonzero(sizes == size)
        directions = np.random.default_rng([seed, int(size)])
        x = matrix(vectors.take(pa.array(rows)))
        for p in range(passes):
            signs = x @ directions.standard_normal((int(size), BITS)) >= 0
            out[rows, p] = (signs * weight).sum(1, dtype=np.uint64).view(np.int64)
    return out


def tied(pairs_a: np.ndarray, pairs_b: np.ndarray) -> np.ndarray:
    """Which of the pairs tie something that the pairs before them do not."""
    root: dict[int, int] = {}

    def top(v: int) -> int:
        while (up := root.get(v, v)) != v:
            root[v] = v = root.get(up, up)
        return v

    keep = np.zeros(len(pairs_a), bool)
    for k, (a, b) in enumerate(zip(pairs_a.tolist(), pairs_b.tolist())):
        a, b = top(a), top(b)
        if a != b:
            root[max(a, b)] = min(a, b)
            keep[k] = True
    return keep


def window_links(x: np.ndarray, run: np.ndarray, window: int, cosine: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places (i, i + 1), (i, i + 2), ... up to the window, of unit rows that reach the cosine within one run."""
    for step in range(1, min(window, len(x) - 1) + 1):
        first = np.flatnonzero(run[:-step] == run[step:])
        if not len(first):
            return  # runs are contiguous
        found = first[(x[first] * x[first + step]).sum(1) >= cosine]
        yield found, found + step


def runs_of(*columns: pa.Array) -> np.ndarray:
    """Number of the stretch of equal values that each row lies in."""
    change = np.zeros(len(columns[0]), bool)
    for column in columns:
        if len(column) > 1:
            change[1:] |= pc.not_equal(column[1:], column[:-1]).to_numpy(zero_copy_only=False)
    return np.cumsum(change)


def _sorted_pass(classes: DataFrame, p: int, parts: int, cosine: float, window: int) -> DataFrame:
    """Links of one pass: each class with its next neighbours, first in the sorted parts, then across their borders."""
    order = [F.col("label"), F.size("vector"), F.get("words", p), F.xxhash64("cls")]
    sorted_rows = classes.repartitionByRange(parts, *order).sortWithinPartitions(*order).select("cls", "label", "vector")
    kinds = {f.name: f for f in sorted_rows.schema.fields}
    out = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType()), T.StructField("part", T.IntegerType()),
                        T.StructField("place", T.LongType()), T.StructField("rows", T.LongType()), kinds["label"], kinds["vector"]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, place, carry, schema = TaskContext.get().partitionId(), 0, None, None

        def rows(n: int, **columns) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if f.name in columns and not isinstance(columns[f.name], pa.Array)
                                               else columns.get(f.name, pa.nulls(n, f.type)) for f in schema], schema=schema)

        def border(batch: pa.RecordBatch, first: int) -> pa.RecordBatch:
            n = batch.num_rows
            return rows(n, a=batch.column(0), part=[part] * n, place=range(first, first + n), label=batch.column(1), vector=batch.column(2))

        for batch in batches:
            if not batch.num_rows:
                continue
            schema = schema or pa.schema([("a", pa.int64()), ("b", pa.int64()), ("part", pa.int32()), ("place", pa.int64()), ("rows", pa.int64()),
                                          ("label", batch.column(1).type), ("vector", batch.column(2).type)])
            if place < window:
                yield border(batch.slice(0, window - place), place)
            known = carry.num_rows if carry is not None else 0
            both = pa.Table.from_batches([carry, batch] if known else [batch]).combine_chunks().to_batches()[0]
            size = pc.list_value_length(both.column(2))
            a, b = _forest(matrix(both.column(2)), runs_of(both.column(1), size), both.column(0), known, window, cosine)
            if len(a):
                yield rows(len(a), a=a, b=b)
            place += batch.num_rows
            carry = both.slice(max(0, both.num_rows - window))
        if carry is not None:
            last = carry.slice(max(0, carry.num_rows - max(0, place - window)))  # those not given as first ones
            if last.num_rows:
                yield border(last, place - last.num_rows)
            yield rows(1, part=[part], rows=[place])

    found = store(sorted_rows.mapInArrow(run, out))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per part
    starts = found.filter("rows is not null").select(F.col("part").alias("own"), F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start"))
    rank = F.col("start") + F.col("place")
    group = F.explode(F.array(F.floor(rank / window), F.floor(rank / window) - 1)).alias("group")
    borders = found.filter("place is not null").join(starts, F.col("part") == F.col("own")).select(
        group, rank.alias("rank"), F.col("a").alias("cls"), "label", "vector")

    def across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in whole_groups(batches, 1):
            size = pc.list_value_length(batch.column(4))
            runs = runs_of(batch.column(0), batch.column(3), size)
            a, b = _forest(matrix(batch.column(4)), runs, batch.column(2), 0, window, cosine)
            yield pa.RecordBatch.from_pydict({"a": a, "b": b}, schema=pa.schema([("a", pa.int64()), ("b", pa.int64())]))

    ties = borders.repartition("group").sortWithinPartitions("group", "rank").mapInArrow(across, "a long, b long")
    return store(found.filter("b is not null").select("a", "b").unionByName(ties))


def _forest(x: np.ndarray, run: np.ndarray, ids: pa.Array, known: int, window: int, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Links of the rows from `known` on, less those that others tie already."""
    pairs = [(i[j >= known], j[j >= known]) for i, j in window_links(x, run, window, cosine)]
    i = np.concatenate([a for a, _ in pairs]) if pairs else np.zeros(0, int)
    j = np.concatenate([b for _, b in pairs]) if pairs else np.zeros(0, int)
    keep = tied(i, j)
    number = ids.to_numpy(zero_copy_only=False)
    return number[i[keep]], number[j[keep]]


def whole_groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.RecordBatch]:
    """Batches that end where a group (equal values of the first columns) ends; groups must be bounded."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        run = runs_of(*[batch.column(k) for k in range(keys)])
        last = int(np.searchsorted(run, run[-1]))
        if held and last == 0 and all(held[-1].column(k)[-1].as_py() == batch.column(k)[0].as_py() for k in range(keys)):
            held.append(batch)
            continue
        ready = pa.Table.from_batches([*held, batch.slice(0, last)]).combine_chunks().to_batches()
        yield from ready
        held = [batch.slice(last)]
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def _count_links(members: DataFrame, cosine: float) -> DataFrame:
    """Per class (cls) the rows of other classes of its component that it links with.

    members has component, cls, rows (of the class) and vector. A component of m classes is cut into m / BLOCK blocks;
    a class meets every block once.
    """
    sizes = members.groupBy("component").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    placed = members.join(sizes, "component").withColumn("block", F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int"))
    dealt = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "component", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "cls", "rows", "vector")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in whole_groups(batches, 3):
            groups = runs_of(*[batch.column(k) for k in range(3)])
            x = matrix(batch.column(6))
            low, high, block, cls, weight = (batch.column(k).to_numpy(zero_copy_only=False) for k in (1, 2, 3, 4, 5))
            links = np.zeros(len(groups), np.int64)
            starts = np.flatnonzero(np.r_[True, groups[1:] != groups[:-1]])
            sizes = np.diff(np.r_[starts, len(groups)])
            small = np.repeat(sizes <= WINDOW, sizes)
            rows = np.flatnonzero(small)  # all pairs of small groups step by step, of all groups at once
            for i, j in window_links(x[rows], groups[rows], WINDOW, cosine):
                i, j = rows[i], rows[j]
                ok = (low[i] == high[i]) | (block[i] != block[j])
                i, j = i[ok], j[ok]
                links += np.bincount(i, weight[j], len(links)).astype(np.int64) + np.bincount(j, weight[i], len(links)).astype(np.int64)
            for s, n in zip(starts[sizes > WINDOW].tolist(), sizes[sizes > WINDOW].tolist()):
                own = np.arange(s, s + n)
                if low[s] == high[s]:
                    near = x[own] @ x[own].T >= cosine
                    np.fill_diagonal(near, False)
                    links[own] += near @ weight[own]
                else:
                    a, b = own[block[own] == low[s]], own[block[own] == high[s]]
                    near = x[a] @ x[b].T >= cosine
                    links[a] += near @ weight[b]
                    links[b] += weight[a] @ near
            yield pa.RecordBatch.from_arrays([pa.array(cls), pa.array(links)], names=["cls", "links"])

    keys = ["component", "low", "high"]
    counted = dealt.repartition(*keys).sortWithinPartitions(*keys, "cls").mapInArrow(run, "cls long, links long")
    return counted.groupBy("cls").agg(F.sum("links").alias("links"))


def _usable(vector: Column, label: Column) -> Column:
    """Whether a vector can link: a label, no null, no component that is null or not finite, and not all zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    return F.coalesce(label.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def near_duplicates(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label",
                    cosine: float = COSINE, window: int = WINDOW, passes: int | None = None) -> DataFrame:
    """One row per row of vectors: vec_id, n_links, component_id, kept.

    Rows link when their labels and lengths are equal and their cosine, in double precision, reaches the threshold.
    A row that is null, zero, empty, of null label or with a null or infinite component links with nothing. Equal rows
    link with each other, also under one id. component_id is the smallest id of the component, ids that are null left
    out; a row without an id is never kept.
    """
    value = F.transform(F.col(vector), lambda x: x + F.lit(0).cast("float"))  # no negative zeros
    own = store(vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(label).alias("label"),
                               F.when(_usable(F.col(vector), F.col(label)), value).alias("vector")))
    key = [F.xxhash64("label", "vector").alias("k1"), F.xxhash64(F.lit(1), "vector", "label").alias("k2")]
    classes = (own.filter("vector is not null").groupBy("label", "vector").agg(F.min("vec_id").alias("first"), F.count("*").alias("rows"))
               .select(F.monotonically_increasing_id().alias("cls"), *key, "first", "rows", "label", "vector"))
    classes = store(classes)  # from here on a class keeps its number
    n = classes.count()
    largest = classes.groupBy("label", F.size("vector")).count().agg(F.max("count")).first()[0] or 0
    passes = passes or passes_for(largest, cosine, window)

    def worded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.array(list(words(batch.column(2), passes)), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([*batch.columns, found], names=["cls", "label", "vector", "words"])

    small = classes.select("cls", "label", "vector")
    named = store(small.mapInArrow(worded, T.StructType([*small.schema.fields, T.StructField("words", T.ArrayType(T.LongType()))])))
    wide = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(-(-n // PART_ROWS), min(wide, n // 1024 + 1))
    links = None
    for p in range(passes):
        one = _sorted_pass(named, p, parts, cosine, window)
        links = one if links is None else links.unionByName(one)
    tied_to = store(components(links))
    members = classes.join(tied_to, F.col("cls") == F.col("node")).select("component", "cls", "rows", "vector", "first")
    smallest = members.groupBy("component").agg(F.min("first").alias("smallest"))
    counted = _count_links(members.drop("first"), cosine)
    found = members.select("cls", "component").join(smallest, "component").join(counted, "cls", "left").select("cls", "smallest", "links")
    facts = classes.select("cls", "k1", "k2", "first", "rows").join(found, "cls", "left").select(
        "k1", "k2", (F.coalesce("links", F.lit(0)) + F.col("rows") - 1).alias("n_links"), F.coalesce("smallest", "first").alias("component_id"))
    rows = own.select("vec_id", F.when(F.col("vector").isNotNull(), key[0]).alias("k1"), F.when(F.col("vector").isNotNull(), key[1]).alias("k2"))
    return rows.join(facts, ["k1", "k2"], "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


_SQL = """
WITH RECURSIVE own AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings),
good AS (
  SELECT * FROM own WHERE label IS NOT NULL AND v IS NOT NULL AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(v, lambda x: x <> 0)) > 0),
link AS MATERIALIZED (
  SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.98),
reach(a, b) AS (SELECT a, b FROM link UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a),
least_of AS (SELECT a, min(b) AS m FROM reach GROUP BY a),
many AS (SELECT a, count(*) AS n FROM link GROUP BY a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, least(vec_id, coalesce(m, vec_id)) AS component_id, vec_id <= coalesce(m, vec_id) AS kept
FROM own LEFT JOIN many ON many.a = vec_id LEFT JOIN least_of ON least_of.a = vec_id"""


@query("op13_embedding_dedup", _SQL)
def op13_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))
