"""Vector code compression: a product quantiser trained with norm-of-sum bounds.

Vectors become integers and are cut into parts; each part has a codebook that a fixed number of rounds improves. A
round assigns every part to its nearest entry and replaces entries by the mean of their parts. Most distances need
not be computed again: for every part and every GROUP entries a vector keeps a lower bound on its distance to those
that are not its own, with the round in which it was measured. All earlier codebooks are retained, so a bound from
round s is lowered in round t by the greatest true displacement |c_t - c_s| of an entry of the group, the norm of
the summed moves, which is tighter than the sum of the norms of the moves. Only where the lowered bound doesn't exceed
the exact distance to the own entry are the group's entries scanned again. Sums and distances are exact integers.

A round is one pass over the rows without a shuffle of vectors: every task returns its rows with their bounds, and
one row per entry with the sum of the parts assigned to it. The driver holds codebooks, which are of fixed size.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fingertrail.llm.catalog import query
from fingertrail.llm.common import fresh, quoted, table
from fingertrail.session import discard, store

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: Neighbouring entries of a codebook that share a lower bound.
GROUP = 32
#: Rows whose distances are computed together.
BLOCK = 4096
#: Components are held between -LIMIT and LIMIT.
LIMIT = 1 << 40
#: Labels whose sums may be broadcast; more are joined by a shuffle.
MOST_LABELS = 1_000_000
#: Relative margin for the rounding of square roots.
_SLACK = 1e-6


def cuts(size: int, parts: int) -> list[int]:
    """Borders of equal consecutive parts; where the size doesn't divide, later parts are longer by one."""
    return [size * p // parts for p in range(parts + 1)]


def exact(x: np.ndarray, y: np.ndarray) -> bool:
    """Whether squared distances are exact in double precision at every step."""
    most = max(int(np.abs(x).max(initial=0)), int(np.abs(y).max(initial=0)))
    return x.shape[1] * (2 * most) ** 2 < 1 << 53


def squared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Exact squared distances of all rows of x to all of y."""
    if exact(x, y):
        a, b = x.astype(np.float64), y.astype(np.float64)
        return (a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)
    a, b = x.astype(object), y.astype(object)
    return (a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)


def rounded_down(x: np.ndarray) -> np.ndarray:
    return np.nextafter(x.astype(np.float32), np.float32(-np.inf))


class Assigner:
    """Assigns rows to the newest of a history of codebooks (per round a list of one array per part)."""

    def __init__(self, history: list[list[np.ndarray]]):
        self.history = history
        self.round = len(history) - 1
        self.entries = len(history[0][0])
        self.groups = -(-self.entries // GROUP)
        self.scans = self.possible = 0
        firsts = np.arange(0, self.entries, GROUP)
        # moves[part][s, group]: greatest true displacement of an entry since round s
        self.moves = [np.array([np.maximum.reduceat(np.sqrt(((new.astype(np.float64) - old[p]) ** 2).sum(1)), firsts) for old in history])
                      * (1 + _SLACK) for p, new in enumerate(history[-1])]

    def part(self, p: int, x: np.ndarray, own: np.ndarray | None, low: np.ndarray, stamp: np.ndarray):
        """Entry and squared distance of each row; low and stamp (row, group) are brought up to date in place."""
        book, rows = self.history[-1][p], np.arange(len(x))
        if own is None:
            entry, best = np.full(len(x), self.entries), np.full(len(x), np.inf)
            scan = np.ones(low.shape, bool)
            lowered = low
        else:
            entry = own.astype(np.int64)
            moved = (x - book[entry]).astype(np.float64 if exact(x, book) else object)
            best = (moved * moved).sum(1)
            lowered = low - np.take_along_axis(self.moves[p], stamp.astype(np.int64), 0)
            scan = ~(lowered > np.sqrt(best.astype(np.float64))[:, None] * (1 + _SLACK))
        before, distance = entry, best
        self.scans += int(scan.sum())
        self.possible += scan.size
        scanned = []
        for g in range(self.groups):
            at = rows[scan[:, g]]
            if not len(at):
                continue
            d = squared(x[at], book[g * GROUP:(g + 1) * GROUP])
            place = d.argmin(1)
            least = d[np.arange(len(at)), place]
            d[np.arange(len(at)), place] = np.inf
            second = d.min(1)
            place = place + g * GROUP
            better = (least < best[at]) | (least == best[at]) & (place < entry[at])
            best = best.astype(object) if least.dtype == object else best
            entry, best = entry.copy(), best.copy()
            entry[at[better]], best[at[better]] = place[better], least[better]
            scanned.append((g, at, place, least, second))
        for g, at, place, least, second in scanned:
            other = np.where(place == entry[at], second, least).astype(np.float64)
            low[at, g] = rounded_down(np.sqrt(other) * (1 - _SLACK))
            stamp[at, g] = self.round
        if own is not None:  # the entry that was left is again one of the others of its group
            left = before // GROUP
            again = (before != entry) & ~scan[rows, left]
            i, g = rows[again], left[again]
            low[i, g] = rounded_down(np.minimum(lowered[i, g], np.sqrt(distance[i].astype(np.float64)) * (1 - _SLACK)))
            stamp[i, g] = self.round
        return entry, best


def _pass(rows: DataFrame, history: list[list[np.ndarray]], bounds: list[int], sums: bool) -> DataFrame:
    """Rows (row, v, code, low, stamp, error) assigned anew and, if asked for, sums: rows with part, entry, n and s."""
    parts = len(bounds) - 1
    out = T.StructType([T.StructField(f.name, f.dataType) for f in rows.schema.fields])  # all may be null

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        assigner, total, given = Assigner(history), {}, {}
        for whole in batches:
            for at in range(0, whole.num_rows, BLOCK):
                batch = whole.slice(at, BLOCK)
                n, given = batch.num_rows, {name: batch.schema.field(name).type for name in ("row", "v")}
                x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(n, -1)
                first = len(history) == 1
                code = None if first else batch.column(2).flatten().to_numpy(zero_copy_only=False).reshape(n, parts)
                shape = (n, parts, assigner.groups)
                low = np.zeros(shape, np.float32) if first else batch.column(3).flatten().to_numpy(zero_copy_only=False).reshape(shape).copy()
                stamp = np.zeros(shape, np.int8) if first else batch.column(4).flatten().to_numpy(zero_copy_only=False).reshape(shape).copy()
                error, codes = np.zeros(n, object), np.zeros((n, parts), np.int16)
                for p in range(parts):
                    own = x[:, bounds[p]:bounds[p + 1]]
                    entry, distance = assigner.part(p, own, None if first else code[:, p], low[:, p], stamp[:, p])
                    codes[:, p] = entry
                    error = error + np.array([int(d) for d in distance.tolist()], object)
                    if sums:
                        order = np.argsort(entry, kind="stable")
                        found, starts = np.unique(entry[order], return_index=True)
                        for e, s, m in zip(found.tolist(), np.add.reduceat(own[order], starts, 0), np.diff(np.r_[starts, n]).tolist()):
                            known = total.setdefault((p, e), [0, np.zeros(own.shape[1], np.int64)])
                            known[0] += m
                            known[1] += s
                yield filled(n, given, row=batch.column(0), v=batch.column(1), code=listed(codes.reshape(n, -1), pa.int16()),
                             low=listed(low.reshape(n, -1), pa.float32()), stamp=listed(stamp.reshape(n, -1), pa.int8()),
                             error=pa.array([min(e, (1 << 63) - 1) for e in error], pa.int64()))
        if total:
            keys = sorted(total)
            yield filled(len(keys), given, part=pa.array([p for p, _ in keys], pa.int32()), entry=pa.array([e for _, e in keys], pa.int32()),
                         n=pa.array([total[k][0] for k in keys], pa.int64()), s=pa.array([total[k][1] for k in keys], pa.list_(pa.int64())))

    def filled(size: int, given: dict[str, pa.DataType], **columns: pa.Array) -> pa.RecordBatch:
        kinds = {**given, "code": pa.list_(pa.int16()), "low": pa.list_(pa.float32()),
                 "stamp": pa.list_(pa.int8()), "error": pa.int64(), "part": pa.int32(), "entry": pa.int32(), "n": pa.int64(), "s": pa.list_(pa.int64())}
        return pa.RecordBatch.from_arrays([columns[k] if k in columns else pa.nulls(size, t) for k, t in kinds.items()], names=list(kinds))

    return rows.mapInArrow(run, out)


def listed(values: np.ndarray, kind: pa.DataType) -> pa.Array:
    n, width = values.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(0, n * width + 1, width), pa.int32()) if width else pa.array([0] * (n + 1), pa.int32()),
                                    pa.array(values.reshape(-1), kind))


@dataclass
class Codes:
    """`rows`: the kept columns with code (an entry per part) and error; `codebooks`: per part an array of entries."""
    rows: DataFrame
    codebooks: list[np.ndarray]
    code: str = "code"
    error: str = "error"

    def sha256(self) -> str:
        """Digest of all components by part, entry and position."""
        text = ",".join(str(c) for book in self.codebooks for c in book.reshape(-1).tolist())
        return hashlib.sha256(text.encode()).hexdigest()

    def hex(self) -> Column:
        """The code as two hex digits per part; entries must be at most 256."""
        return F.array_join(F.transform(F.col(self.code), lambda c: F.lpad(F.lower(F.hex(c)), 2, "0")), "")


def compress(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", keep: tuple[str, ...] = ("vec_id", "label"),
             parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> Codes:
    """Codes of all vectors that are not null or empty and hold no null or infinite component.

    A component x is the integer floor(scale * x), held within LIMIT. The codebooks begin as the parts of the vectors of
    the smallest ids (null ids come last, equal ids by their vectors); fewer vectors make smaller codebooks. Vectors of
    another length than that of the smallest id have no code and are left out. Errors beyond a long count as the largest long.
    No vector at all gives an empty table and empty codebooks.
    """
    code, error = fresh("code", list(keep)), fresh("error", list(keep))
    finite = F.forall(F.col(vector), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    number = F.transform(F.col(vector), lambda x: F.greatest(F.lit(-LIMIT), F.least(F.lit(LIMIT), F.floor(x.cast("double") * scale).cast("long"))))
    own = vectors.filter(F.coalesce(finite, F.lit(False)) & (F.size(vector) > 0)).select(
        F.struct(*quoted(list(keep))).alias("row"), F.col(vec_id).alias("id"), number.alias("v"))
    order = own.select("id", "v").orderBy(F.col("id").asc_nulls_last(), "v")
    head = order.first()
    size = len(head["v"]) if head else 0
    first = [r["v"] for r in order.filter(F.size("v") == size).limit(entries).collect()]  # the entries of a codebook
    start = np.array(first, np.int64).reshape(len(first), size)
    bounds = cuts(size, parts)
    history = [[start[:, a:b] for a, b in zip(bounds, bounds[1:])]]
    state = {"code": "array<smallint>", "low": "array<float>", "stamp": "array<tinyint>", "error": "long", "part": "int", "entry": "int",
             "n": "long", "s": "array<long>"}
    rows = own.filter(F.size("v") == size).select("row", "v", *[F.lit(None).cast(kind).alias(name) for name, kind in state.items()])
    if not first:
        return Codes(own.limit(0).select("row.*", F.lit(None).cast("array<smallint>").alias(code), F.lit(None).cast("long").alias(error)),
                     history[0], code, error)
    for _ in range(rounds):
        done = store(_pass(rows, history, bounds, True))
        history.append(_means(done, history[-1]))
        if len(history) > 2:
            discard(previous)  # noqa: F821
        previous, rows = done, done.filter("entry is null")
    last = store(_pass(rows, history, bounds, False))
    discard(previous)
    return Codes(last.select("row.*", F.col("code").alias(code), F.col("error").alias(error)), history[-1], code, error)


def _means(done: DataFrame, books: list[np.ndarray]) -> list[np.ndarray]:
    """New codebooks: floors of the means of what was assigned; an entry without any stays."""
    longest = max(book.shape[1] for book in books)
    sums = done.filter("entry is not null").groupBy("part", "entry").agg(
        F.sum("n").alias("n"), F.array(*[F.sum(F.get("s", k)) for k in range(longest)]).alias("s"))
    new = [book.copy() for book in books]
    for r in sums.collect():  # parts x entries
        new[r["part"]][r["entry"]] = [s // r["n"] for s in r["s"][:new[r["part"]].shape[1]]]
    return new


def with_label_error(codes: DataFrame, label: str, error: str, name: str) -> DataFrame:
    """Adds the sum of errors over rows of equal label; null labels are one. Sums combine before the shuffle."""
    key = fresh("_label", codes.columns)
    sums = store(codes.groupBy(F.col(label).alias(key)).agg(F.sum(error).alias(name)))
    sums = F.broadcast(sums) if sums.count() <= MOST_LABELS else sums
    return codes.join(sums, F.col(label).eqNullSafe(F.col(key))).drop(key)


def _sql() -> str:
    book = """SELECT part, entry, pos, coalesce(c2, c) AS c FROM book{k} LEFT JOIN (
    SELECT part, entry, pos, ((s - ((s % n) + n) % n) // n)::BIGINT AS c2 FROM (
      SELECT part, m[2] AS entry, pos, sum(v)::BIGINT AS s, count(*)::BIGINT AS n FROM near{k} JOIN comp USING (vec_id, part) GROUP BY ALL)
    ) USING (part, entry, pos)"""
    near = """SELECT vec_id, part, min([d, entry]) AS m FROM (
    SELECT vec_id, part, entry, sum((v - c) * (v - c))::BIGINT AS d FROM comp JOIN book{k} USING (part, pos) GROUP BY ALL) GROUP BY ALL"""
    steps = []
    for k in range(ROUNDS + 1):
        if k:
            steps.append(f"book{k} AS MATERIALIZED ({book.format(k=k - 1)})")
        steps.append(f"near{k} AS MATERIALIZED ({near.format(k=k)})")
    return f"""
WITH kept AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
comp AS MATERIALIZED (
  SELECT vec_id, (i - 1) // (len(v) // {PARTS}) AS part, (i - 1) % (len(v) // {PARTS}) AS pos, v[i] AS v
  FROM kept, unnest(range(1, len(v) + 1)) AS u(i)),
book0 AS MATERIALIZED (
  SELECT part, entry, pos, v AS c FROM comp JOIN (
    SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM kept ORDER BY vec_id LIMIT {ENTRIES}) USING (vec_id)),
{', '.join(steps)},
code AS (SELECT vec_id, string_agg(printf('%02x', m[2]), '' ORDER BY part) AS code, sum(m[1])::BIGINT AS error FROM near{ROUNDS} GROUP BY vec_id)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
  (SELECT sha256(string_agg(c::VARCHAR, ',' ORDER BY part, entry, pos)) FROM book{ROUNDS}) AS codebooks_sha256
FROM code JOIN kept USING (vec_id)"""


@query("op12_vector_codes", _sql())
def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes = compress(table(spark, sf_dir, "embeddings"))
    rows = codes.rows.select("vec_id", "label", codes.hex().alias("code"), F.col("error"))
    return with_label_error(rows, "label", "error", "label_error").drop("label").withColumn("codebooks_sha256", F.lit(codes.sha256()))
