"""Segmentation of sessions too large for one task: an associative state per chunk, one scan over the states, one rewrite.

What a chunk of a finger's ordered rows does to a sequence that comes in open, and what it leaves open for the chunks
after it, fits in one small row. These rows come from one aggregate over the stored layout; windows over them alone (a
row per finger and chunk) give every chunk the number of sequences before it, whether one is open at its start, and how the
sequences that cross its borders go on. The events are then completed inside their chunks, without a look at any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fingertrail.operators.groups import CHUNK, _null_safe
from fingertrail.session import store

FINGER = ["session_id", "fingerId"]
PIECE = [*FINGER, CHUNK]


def _states(rows: DataFrame, order: list[str], more: dict[str, Column] | None = None) -> DataFrame:
    """A row per finger and chunk: what its begins, ends and middles (columns _begin, _end, _middle) do to a sequence."""
    at = F.struct(*order)
    first = lambda c: F.min(F.when(F.col(c), at))
    last = lambda c: F.max(F.when(F.col(c), at))
    found = rows.groupBy(*PIECE).agg(
        F.sum(F.col("_begin").cast("long")).alias("begins"), F.max_by("_begin", F.when(F.col("_begin") | F.col("_end"), at)).alias("leaves_open"),
        first("_begin").alias("b1"), first("_end").alias("e1"), first("_middle").alias("m1"), last("_begin").alias("b2"), last("_end").alias("e2"),
        last("_middle").alias("m2"), *[c.alias(name) for name, c in (more or {}).items()])
    before = lambda a, b: F.col(a).isNotNull() & F.coalesce(F.col(a) < F.col(b), F.lit(True))
    states = found.withColumns({
        "head_end": before("e1", "b1"), "head_middle": before("m1", "b1") & before("m1", "e1"),
        "tail_end": F.coalesce(F.col("e2") > F.col("b2"), F.lit(False)), "tail_middle": F.coalesce(F.col("m2") > F.col("b2"), F.lit(False))})
    along = Window.partitionBy(*FINGER).orderBy(CHUNK)
    past = along.rowsBetween(Window.unboundedPreceding, -1)
    return states.drop("b1", "e1", "m1", "b2", "e2", "m2").withColumns({
        "count_in": F.coalesce(F.sum("begins").over(past), F.lit(0)),
        "open_in": F.coalesce(F.last("leaves_open", ignorenulls=True).over(past), F.lit(False)),
        "last_seq": F.sum("begins").over(Window.partitionBy(*FINGER)),
        **{name: F.lag(name).over(along) for name in (more or {})}})


def _with_crossing(states: DataFrame, entry: Column, leaving: Column) -> DataFrame:
    """States with what becomes of the sequence at the chunk's start (entry_end, entry_middle) and of the one at its end."""
    seq = F.col("count_in") + F.col("begins")
    parts = states.filter(entry).select(*FINGER, F.col("count_in").alias("seq"), F.col("head_end").alias("ended"), F.col("head_middle").alias("middle"))
    parts = parts.unionByName(states.filter(leaving & (F.col("begins") > 0)).select(
        *FINGER, seq.alias("seq"), F.col("tail_end").alias("ended"), F.col("tail_middle").alias("middle")))
    cross = parts.groupBy(*FINGER, "seq").agg(F.max("ended").alias("ended"), F.max("middle").alias("middle"))
    out = states.withColumn("seq", F.col("count_in"))
    out = _null_safe(out, cross.withColumnsRenamed({"ended": "entry_end", "middle": "entry_middle"}), [*FINGER, "seq"], "left").withColumn("seq", seq)
    return _null_safe(out, cross.withColumnsRenamed({"ended": "exit_end", "middle": "exit_middle"}), [*FINGER, "seq"], "left").drop("seq")


def coloring(hot: DataFrame, order: list[str], begin: Column, end: Column, middle: Column, session: dict[str, Column]) -> DataFrame:
    """hot (stored, in chunks by finger and order) with the columns that segmentation of Coloring rows works with.

    session holds aggregates of a session that the phases' meaning depends on.
    """
    kinds = hot.groupBy("session_id").agg(*[c.alias(name) for name, c in session.items()])  # as many rows as large sessions
    marked = _null_safe(hot, F.broadcast(kinds), ["session_id"], "left").withColumns({"_begin": begin, "_end": end, "_middle": F.coalesce(middle, F.lit(False))})
    states = _with_crossing(store(_states(marked, order)), F.col("open_in"), F.coalesce(F.col("leaves_open"), F.lit(False)))
    facts = store(states.select(*PIECE, *[F.col(c).alias(f"_{c}") for c in (
        "begins", "count_in", "open_in", "last_seq", "entry_end", "entry_middle", "exit_end", "exit_middle")]))
    inside = Window.partitionBy(*PIECE).orderBy(*order)
    mark = F.when(F.col("_begin"), True).when(F.col("_end"), False)
    rows = _null_safe(marked, facts, PIECE, "left").withColumns({
        "_own": F.sum(F.col("_begin").cast("long")).over(inside.rowsBetween(Window.unboundedPreceding, 0)),
        "_was": F.last(mark, ignorenulls=True).over(inside.rowsBetween(Window.unboundedPreceding, -1))})
    rows = rows.withColumn("_count", F.col("_count_in") + F.col("_own"))
    belongs = F.col("_begin") | F.coalesce("_was", "_open_in")
    rows = rows.withColumn("seqId", F.when(belongs, F.col("_count")).otherwise(F.lit(0)))
    piece = Window.partitionBy(*PIECE, "seqId")

    def whole(local: str, name: str) -> Column:
        entry = F.when(F.col("_own") == 0, F.col(f"_entry_{name}"))
        leaving = F.when(F.col("_own") == F.col("_begins"), F.col(f"_exit_{name}"))
        return F.max(local).over(piece) | F.coalesce(entry, F.lit(False)) | F.coalesce(leaving, F.lit(False))

    rows = rows.withColumns({"_has_end": whole("_end", "end"), "_has_middle": whole("_middle", "middle")})
    return rows.drop(*session, "_middle", "_begins", "_count_in", "_open_in", "_entry_end", "_entry_middle", "_exit_end", "_exit_middle", "_own", "_was")


def tracing(hot: DataFrame, order: list[str], begin: Column, end: Column, tracked: Column, previous: dict[str, Column]) -> DataFrame:
    """hot with the columns that segmentation of Tracing rows works with: _count, _open, seqId, _has_end and previous values.

    Here a sequence runs from one begin to the next, whether it is open or not.
    """
    marked = hot.withColumns({"_begin": begin, "_end": end, "_middle": F.lit(False)})
    at = F.struct(*order)
    states = store(_states(marked, order, {f"last{name}": F.max_by(F.struct(c.alias("v")), at) for name, c in previous.items()}))
    always = F.lit(True)
    facts = store(_with_crossing(states, always, always).select(
        *PIECE, *[F.col(c).alias(f"_{c}") for c in ("begins", "count_in", "open_in", "entry_end", "exit_end", *[f"last{name}" for name in previous])]))
    inside = Window.partitionBy(*PIECE).orderBy(*order)
    mark = F.when(F.col("_begin"), True).when(F.col("_end"), False)
    rows = _null_safe(marked, facts, PIECE, "left").withColumns({
        "_own": F.sum(F.col("_begin").cast("long")).over(inside.rowsBetween(Window.unboundedPreceding, 0)),
        "_was": F.last(mark, ignorenulls=True).over(inside.rowsBetween(Window.unboundedPreceding, -1)), "_place": F.row_number().over(inside),
        **{name: F.lag(c).over(inside) for name, c in previous.items()}})
    rows = rows.withColumns({"_count": F.col("_count_in") + F.col("_own"), "_open": F.coalesce("_was", "_open_in"),
                             **{name: F.when(F.col("_place") == 1, F.col(f"_last{name}.v")).otherwise(F.col(name)) for name in previous}})
    rows = rows.withColumn("seqId", F.when(tracked, F.col("_count")).otherwise(F.lit(0)))
    ended = F.max("_end").over(Window.partitionBy(*PIECE, "_own"))
    entry, leaving = F.when(F.col("_own") == 0, F.col("_entry_end")), F.when(F.col("_own") == F.col("_begins"), F.col("_exit_end"))
    rows = rows.withColumn("_has_end", ended | F.coalesce(entry, F.lit(False)) | F.coalesce(leaving, F.lit(False)))
    return rows.drop("_begin", "_end", "_middle", "_begins", "_count_in", "_open_in", "_entry_end", "_exit_end", "_own", "_was", "_place",
                     *[f"_last{name}" for name in previous])
