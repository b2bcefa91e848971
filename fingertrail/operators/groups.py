"""Ordered and whole-group operations that stay safe when one group holds a third of the rows.

A window function sends each group to one task. That is the plan we want for the billions of
ordinary sessions, and it fails for a session of 10^11 rows. ``Touches`` therefore keeps two parts:

* ``cold``: sessions of at most ``fingertrail.hotRows`` rows. They are clustered by session once,
  and every later window (by finger, touch or sequence inside the session) reuses that exchange.
* ``hot``: the rows of larger sessions, or None. They are range-partitioned by (group, order), so a
  group spreads over many partitions. Running values are computed inside each chunk and completed
  with the carry of the chunks before it; the carries come from one small row per (group, chunk).
  Whole-group values are ordinary aggregates (with map-side combine) joined back per (group, chunk).

The number of hot sessions is at most rows / hotRows, which bounds the broadcast key list.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fingertrail.session import store

HOT_ROWS_CONF = "fingertrail.hotRows"
HOT_ROWS_DEFAULT = 5_000_000
CHUNK = "_chunk"
SESSION = "session_id"


# ---- what can be asked of an ordered group ----------------------------------------------------

@dataclass(frozen=True)
class RunningSum:
    """Sum from the start of the group to this row."""
    value: Column

    def local(self, window):
        return F.sum(self.value).over(window.rowsBetween(Window.unboundedPreceding, 0))

    def summary(self, order):
        return F.sum(self.value)

    def carry(self, column, window):
        return F.sum(column).over(window.rowsBetween(Window.unboundedPreceding, -1))

    def join(self, local, carry, first):
        return F.coalesce(carry + local, local, carry)


@dataclass(frozen=True)
class Position:
    """0-based position in the group."""

    def local(self, window):
        return (F.row_number().over(window) - 1).cast("long")

    def summary(self, order):
        return F.count(F.lit(1))

    def carry(self, column, window):
        return F.sum(column).over(window.rowsBetween(Window.unboundedPreceding, -1))

    def join(self, local, carry, first):
        return F.coalesce(carry, F.lit(0)) + local


@dataclass(frozen=True)
class LastBefore:
    """Last non-null value on the rows before this one."""
    value: Column

    def local(self, window):
        frame = window.rowsBetween(Window.unboundedPreceding, -1)
        return F.last(self.value, ignorenulls=True).over(frame)

    def summary(self, order):
        return F.max_by(self.value, F.when(self.value.isNotNull(), order))

    def carry(self, column, window):
        frame = window.rowsBetween(Window.unboundedPreceding, -1)
        return F.last(column, ignorenulls=True).over(frame)

    def join(self, local, carry, first):
        return F.coalesce(local, carry)


@dataclass(frozen=True)
class RunningMaxBefore:
    """Largest value on the rows before this one."""
    value: Column

    def local(self, window):
        return F.max(self.value).over(window.rowsBetween(Window.unboundedPreceding, -1))

    def summary(self, order):
        return F.max(self.value)

    def carry(self, column, window):
        return F.max(column).over(window.rowsBetween(Window.unboundedPreceding, -1))

    def join(self, local, carry, first):
        return F.greatest(local, carry)


@dataclass(frozen=True)
class Previous:
    """Value on the row before this one."""
    value: Column

    def local(self, window):
        return F.lag(self.value).over(window)

    def summary(self, order):
        return F.max_by(self.value, order)

    def carry(self, column, window):
        return F.lag(column).over(window)

    def join(self, local, carry, first):
        return F.when(first, carry).otherwise(local)


@dataclass(frozen=True)
class Quantile:
    """Exact quantile with linear interpolation, as a whole-group value."""
    value: Column
    q: float


# ---- helpers for the hot part -----------------------------------------------------------------

def _null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Equi-join that also matches null keys; keeps the left copy of the keys."""
    renamed = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys],
                           *[c for c in right.columns if c not in keys])
    condition = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys])
    return left.join(renamed, condition, how).drop(*[f"_r_{k}" for k in keys])


def _range_chunks(df: DataFrame, keys: Sequence[str], order: Sequence[str], chunk_rows: int,
                  rows: int | None = None) -> DataFrame:
    """Cut rows into contiguous stretches of (keys, order); the layout is fixed by storing it.

    ``rows`` is a known bound of the row count; without one the rows are counted.
    """
    rows = df.count() if rows is None else rows
    pieces = max(2, -(-rows // chunk_rows))
    ranged = df.drop(CHUNK).repartitionByRange(int(pieces), *keys, *order)
    return store(ranged.withColumn(CHUNK, F.spark_partition_id()))


def _order_struct(order: Sequence[str]) -> Column:
    return F.struct(*order)


def _running_hot(df: DataFrame, keys, order, columns: dict) -> DataFrame:
    group = [*keys, CHUNK]
    inside = Window.partitionBy(*group).orderBy(*order)
    along = Window.partitionBy(*keys).orderBy(CHUNK)
    position = _order_struct(order)
    summary = df.groupBy(*group).agg(
        *[spec.summary(position).alias(f"_s_{name}") for name, spec in columns.items()])
    carries = summary.select(
        *group, *[spec.carry(F.col(f"_s_{name}"), along).alias(f"_c_{name}")
                  for name, spec in columns.items()])
    local = df.select("*", (F.row_number().over(inside) == 1).alias("_first"),
                      *[spec.local(inside).alias(f"_l_{name}") for name, spec in columns.items()])
    joined = _null_safe(local, carries, group, "left")
    return joined.select(
        *df.columns,
        *[spec.join(F.col(f"_l_{name}"), F.col(f"_c_{name}"), F.col("_first")).alias(name)
          for name, spec in columns.items()])


# size of the quantile sketch, the share of values on either side of a wanted rank that its error cannot leave, and the
# number of values up to which a group is ranked whole
SKETCH_SIZE, MARGIN, RANKED_WHOLE = 1024, 0.014, 1_000


def hot_quantiles(df: DataFrame, keys, columns: dict[str, Quantile], chunk_rows: int, bracketed: bool = True) -> DataFrame:
    """Exact quantiles of groups of any size, all at once.

    One pass keeps a mergeable sketch per group and value, which brackets each wanted rank between two values. A second
    pass counts what lies below a bracket and keeps only the different values inside it, which are ranked and
    interpolated. Should a bracket miss its rank, as a sketch may, all values of the table are ranked instead.
    """
    values: dict[str, tuple[str, Column]] = {}
    for name, spec in columns.items():
        values.setdefault(str(spec.value), (f"_v{len(values)}", spec.value.cast("double")))
    of = {name: values[str(spec.value)][0] for name, spec in columns.items()}
    rows = df.select(*keys, *([CHUNK] if CHUNK in df.columns else []), *[c.alias(v) for v, c in values.values()])
    found = rows.groupBy(*keys).agg(*[F.count(v).alias(f"_n{v}") for v, _ in values.values()],
                                    *[F.kll_sketch_agg_double(v, F.lit(SKETCH_SIZE)).alias(f"_s{v}") for v, _ in values.values() if bracketed])

    def bound(name: str, rank: float) -> Column:
        if not bracketed or not 0 < rank < 1:
            return F.lit(None).cast("double")
        large = F.col(f"_n{of[name]}") > RANKED_WHOLE
        return F.when(large, F.kll_sketch_get_quantile_double(F.when(large, F.col(f"_s{of[name]}")), F.lit(rank)))

    limits = store(found.select(
        *keys, *[F.col(f"_n{v}") for v, _ in values.values()], *[bound(n, s.q - MARGIN).alias(f"_lo_{n}") for n, s in columns.items()],
        *[bound(n, s.q + MARGIN).alias(f"_hi_{n}") for n, s in columns.items()]))
    if CHUNK in rows.columns:  # the chunk in the join key spreads a large group over many tasks
        pairs = _null_safe(rows.select(*keys, CHUNK).distinct(), limits, keys, "inner")
        rows = _null_safe(rows, pairs, [*keys, CHUNK], "inner")
    else:
        rows = _null_safe(rows, limits, keys, "inner")

    def entry(name: str) -> Column:
        v, low, high = F.col(of[name]), F.col(f"_lo_{name}"), F.col(f"_hi_{name}")
        below = F.coalesce(v < low, F.lit(False))
        wanted = v.isNotNull() & (below | F.coalesce(v <= high, high.isNull()))
        return F.when(wanted, F.struct(F.lit(name).alias("_name"), F.when(~below, v).alias("_v")))

    counted = (rows.select(*keys, F.explode(F.array_compact(F.array(*[entry(n) for n in columns]))).alias("_e")).select(*keys, "_e.*")
               .groupBy(*keys, "_name", "_v").agg(F.count(F.lit(1)).alias("_n")))
    group = [*keys, "_name"]
    laid = _range_chunks(counted, group, ["_v"], chunk_rows)  # nulls first: what lies below counts before all others
    ranked = _running_hot(laid, group, ["_v"], {"_upto": RunningSum(F.col("_n"))}).filter(F.col("_v").isNotNull())
    sizes = limits.select(*keys, F.inline(F.array(*[
        F.struct(F.lit(n).alias("_name"), F.col(f"_n{of[n]}").alias("_size"), (F.lit(s.q) * (F.col(f"_n{of[n]}") - 1)).alias("_at"))
        for n, s in columns.items()]))).filter("_size > 0")
    ranks = _null_safe(laid.select(*group, CHUNK).distinct(), sizes, group, "inner")
    ranked = _null_safe(ranked, ranks, [*group, CHUNK], "inner")

    def holds(rank):
        return (F.col("_upto") - F.col("_n") <= rank) & (rank < F.col("_upto"))

    picked = (ranked.filter(holds(F.floor("_at")) | holds(F.ceil("_at"))).groupBy(*group)
              .agg(F.max(F.when(holds(F.floor("_at")), F.col("_v"))).alias("_lo"), F.max(F.when(holds(F.ceil("_at")), F.col("_v"))).alias("_hi"),
                   F.max("_at").alias("_at")))
    picked = store(picked.select(*group, (F.col("_lo") + (F.col("_hi") - F.col("_lo")) * (F.col("_at") - F.floor("_at"))).alias("_q")))
    if bracketed and picked.filter("_q is not null").count() < sizes.count():
        return hot_quantiles(df, keys, columns, chunk_rows, False)
    wide = picked.groupBy(*keys).agg(*[F.max(F.when(F.col("_name") == n, F.col("_q"))).alias(n) for n in columns])
    return _null_safe(limits.select(*keys), wide, keys, "left")


def table_quantiles(df: DataFrame, columns: dict[str, Quantile], hot_rows: int = HOT_ROWS_DEFAULT,
                    at_most: int | None = None) -> DataFrame:
    """One row of exact quantiles over a whole table of any size."""
    if (df.count() if at_most is None else at_most) <= hot_rows:
        return df.agg(*[F.percentile(s.value, F.lit(s.q)).alias(name) for name, s in columns.items()])
    keyed = df.withColumn("_all", F.lit(0))
    return hot_quantiles(keyed, ["_all"], columns, hot_rows).drop("_all")


# ---- the two-part table -----------------------------------------------------------------------

@dataclass(frozen=True)
class Touches:
    cold: DataFrame
    hot: DataFrame | None = None
    clustered: bool = False
    keys: tuple[str, ...] = ()
    order: tuple[str, ...] = ()
    hot_rows: int = HOT_ROWS_DEFAULT
    at_most: int | None = None  # no session of this table or of one derived from it has more rows
    hot_count: int | None = None  # bound of the rows in the hot part
    stored: bool = False  # the hot part is a stored table, nothing is computed on top of it

    @property
    def columns(self) -> list[str]:
        return [c for c in self.cold.columns if c != CHUNK]

    def map(self, fn: Callable[[DataFrame], DataFrame]) -> "Touches":
        """Apply a row-wise transformation to both parts."""
        if self.hot is None:
            return replace(self, cold=fn(self.cold))
        return replace(self, cold=fn(self.cold), hot=fn(self.hot), stored=False)

    def with_columns(self, **columns: Column) -> "Touches":
        return self.map(lambda df: df.withColumns(columns))

    def select(self, *columns) -> "Touches":
        def pick(df):
            extra = [CHUNK] if CHUNK in df.columns else []
            return df.select(*columns, *extra)
        return self.map(pick)

    def drop(self, *columns: str) -> "Touches":
        return self.map(lambda df: df.drop(*columns))

    def filter(self, condition: Column) -> "Touches":
        return self.map(lambda df: df.filter(condition))

    def rows(self) -> DataFrame:
        """All rows as one DataFrame."""
        if self.hot is None:
            return self.cold
        return self.cold.unionByName(self.hot.drop(CHUNK))

    def materialise(self) -> "Touches":
        """Store the rows once, where several later steps read them."""
        return replace(self, cold=store(self.cold), clustered=False,
                       hot=self._stored_hot(), stored=True)

    def _stored_hot(self) -> DataFrame | None:
        """The hot part as a stored table: each step reads it more than once, so what was computed since
        the last step is stored first, which keeps work and plans linear in the number of steps."""
        return self.hot if self.hot is None or self.stored else store(self.hot)

    def arrange(self, keys: Sequence[str], order: Sequence[str]) -> "Touches":
        """Declare the grouping and order of the following ``running`` calls.

        Cold rows are clustered by session once; hot rows get a range layout for this order.
        """
        cold = self.cold if self.clustered else self.cold.repartition(SESSION)
        hot = self.hot
        if hot is not None and (tuple(keys), tuple(order)) != (self.keys, self.order):
            hot = _range_chunks(hot, keys, order, self.hot_rows, self.hot_count)
            return replace(self, cold=cold, hot=hot, clustered=True, keys=tuple(keys), order=tuple(order),
                           stored=True)
        return replace(self, cold=cold, clustered=True, keys=tuple(keys), order=tuple(order))

    def running(self, within: Sequence[str] | None = None, **columns) -> "Touches":
        """Add order-dependent columns; ``within`` may refine the arranged keys."""
        keys, order = list(within or self.keys), list(self.order)
        window = Window.partitionBy(*keys).orderBy(*order)
        cold = self.cold.select(
            "*", *[spec.local(window).alias(name) for name, spec in columns.items()])
        hot = None
        if self.hot is not None:
            hot = _running_hot(self._stored_hot(), keys, order, columns)
        return replace(self, cold=cold, hot=hot, stored=False)

    def totals(self, within: Sequence[str], **columns) -> "Touches":
        """Add whole-group values (aggregate columns or ``Quantile``) to every row."""
        whole = Window.partitionBy(*within)
        start = self if self.clustered else replace(
            self, cold=self.cold.repartition(SESSION), clustered=True)

        def over(spec):
            if isinstance(spec, Quantile):
                return F.percentile(spec.value, F.lit(spec.q)).over(whole)
            return spec.over(whole)

        cold = start.cold.select("*", *[over(spec).alias(name) for name, spec in columns.items()])
        if start.hot is None:
            return replace(start, cold=cold)
        start = replace(start, hot=start._stored_hot(), stored=True)
        hot = start._attach_hot(start._aggregate_hot(within, columns), within)
        return replace(start, cold=cold, hot=hot, stored=False)

    def aggregate(self, keys: Sequence[str], **columns) -> DataFrame:
        """One row per group. Aggregates combine map-side, so no group travels whole."""
        cold = self.cold.groupBy(*keys).agg(
            *[(F.percentile(s.value, F.lit(s.q)) if isinstance(s, Quantile) else s).alias(name)
              for name, s in columns.items()])
        if self.hot is None:
            return cold
        return cold.unionByName(self._aggregate_hot(keys, columns))

    def attach(self, table: DataFrame, keys: Sequence[str]) -> "Touches":
        """Left-join a table with one row per group to the rows.

        A row with a null key gets nulls, in both parts: unlike windows and aggregates, where null keys form a group,
        labels belong to a named group only.
        """
        cold = self.cold.join(table, list(keys), "left")
        if self.hot is None:
            return replace(self, cold=cold)
        start = replace(self, hot=self._stored_hot(), stored=True)
        return replace(self, cold=cold, hot=start._attach_hot(table, keys, False), stored=False)

    def _aggregate_hot(self, keys, columns) -> DataFrame:
        plain = {n: s for n, s in columns.items() if not isinstance(s, Quantile)}
        quantiles = {n: s for n, s in columns.items() if isinstance(s, Quantile)}
        table = self.hot.groupBy(*keys).agg(
            *[s.alias(n) for n, s in plain.items()], F.count(F.lit(1)).alias("_rows")).drop("_rows")
        if quantiles:
            found = hot_quantiles(self.hot, keys, quantiles, self.hot_rows)
            table = _null_safe(table, found, keys, "left")
        return table.select(*keys, *columns)

    def _attach_hot(self, table: DataFrame, keys, match_nulls: bool = True) -> DataFrame:
        hot = self.hot
        # the chunk in the join key spreads a large group over many tasks
        groups = hot.select(*keys, CHUNK).distinct()
        pairs = _null_safe(groups, table, keys, "left") if match_nulls else groups.join(table, list(keys), "left")
        return _null_safe(hot, pairs, [*keys, CHUNK], "left").select(
            *hot.columns, *[c for c in table.columns if c not in keys])


def _hashable(df: DataFrame) -> list[str]:
    """Columns that a hash takes: no maps and no variants, not even inside."""
    return [name for name, kind in df.dtypes if "map<" not in kind and "variant" not in kind]


def split_sessions(df: DataFrame, hot_rows: int | None = None, at_most: int | None = None) -> Touches:
    """Separate the sessions too large for one task.

    A table of at most ``hot_rows`` rows cannot hold such a session, so it needs no second look.
    ``at_most`` is a known bound of the row count, which saves counting a derived table.
    """
    spark = df.sparkSession
    limit = hot_rows or int(spark.conf.get(HOT_ROWS_CONF, str(HOT_ROWS_DEFAULT)))
    bound = df.count() if at_most is None else at_most
    if bound <= limit:
        return Touches(df, hot_rows=limit, at_most=bound)
    large = (df.groupBy(SESSION).agg(F.count(F.lit(1)).alias("_n"))
             .filter(F.col("_n") > limit).select(F.col(SESSION).alias("_hot"), "_n"))
    large = store(large)
    found, rows = large.agg(F.count(F.lit(1)), F.sum("_n")).first()
    if not found:
        return Touches(df, hot_rows=limit, at_most=bound)
    keys = F.broadcast(large.select("_hot"))  # at most rows / limit keys
    match = F.col(SESSION).eqNullSafe(F.col("_hot"))
    # until an order is declared, a hash of the row spreads each large session
    pieces = max(2, -(-int(rows) // limit))
    hot = (df.join(keys, match, "left_semi")
           .withColumn(CHUNK, F.pmod(F.xxhash64(*_hashable(df)), F.lit(pieces)).cast("int")))
    return Touches(df.join(keys, match, "left_anti"), hot, hot_rows=limit, at_most=bound, hot_count=int(rows))
