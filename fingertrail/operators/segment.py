"""Splitting each finger's events into sequences, as running values over (session, finger)."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column
from pyspark.sql import functions as F

from fingertrail.functions.phases import any_phase, is_phase
from fingertrail.operators import segment_large
from fingertrail.operators.groups import LastBefore, Previous, RunningSum, Touches
from fingertrail.schema import time_order

FINGER = ["session_id", "fingerId"]
SEQUENCE = ["session_id", "fingerId", "seqId"]


def _open_before(begin: Column, end: Column) -> LastBefore:
    return LastBefore(F.when(begin, True).when(end, False))


def segment_sequences(touches: Touches) -> Touches:
    """Coloring segmentation: seqId and the four tracking columns.

    The phase alphabet is decided per session, as a recording holds one type: with any ``Began``
    the long names, else with any ``B`` the short ones (where ``S`` ends a sequence), else both.
    """
    long_names, short_names = F.col("_any_began"), F.col("_any_b")
    begin = F.when(long_names, is_phase("Began")).when(short_names, is_phase("B")).otherwise(False)
    end = (F.when(long_names, is_phase("Ended", "Canceled"))
           .when(short_names, is_phase("E", "S"))
           .otherwise(is_phase("Ended", "Canceled", "E", "S")))
    middle = F.when(long_names, is_phase("Moved", "Stationary")).when(short_names, is_phase("M"))

    order, session = time_order(touches.columns), {"_any_began": any_phase("Began"), "_any_b": any_phase("B")}
    laid = touches.arrange(FINGER, order)
    rows = (replace(laid, hot=None).totals(["session_id"], **session)
            .with_columns(_begin=begin, _end=end, _middle=F.coalesce(middle, F.lit(False))))
    rows = rows.running(_count=RunningSum(F.col("_begin").cast("long")),
                        _open=_open_before(F.col("_begin"), F.col("_end")))
    inside = F.col("_begin") | F.coalesce(F.col("_open"), F.lit(False))
    rows = rows.with_columns(seqId=F.when(inside, F.col("_count")).otherwise(F.lit(0)))
    rows = rows.totals(FINGER, _last_seq=F.max("_count"))
    rows = rows.totals(SEQUENCE, _has_end=F.max("_end"), _has_middle=F.max("_middle")).drop("_open", "_middle", *session)
    if laid.hot is not None:
        rows = replace(rows, hot=segment_large.coloring(laid.hot, order, begin, end, middle, session), stored=False)

    in_sequence = F.col("seqId") > 0
    interrupted = in_sequence & ~F.col("_has_end") & (F.col("seqId") < F.col("_last_seq"))
    return rows.with_columns(
        sequence_interrupted=interrupted,
        # an event outside a sequence is orphaned when it ends one or when an earlier one was closed
        orphaned_events=~in_sequence & (F.col("_end") | (F.col("_count") > 0)),
        # ends are counted only while a sequence is open and the first one closes it
        multiple_end_events=F.lit(False),
        improper_sequence_order=interrupted | (in_sequence & F.col("_has_end") & ~F.col("_has_middle")),
    ).drop("_begin", "_end", "_count", "_last_seq", "_has_end", "_has_middle")


def segment_tracing_sequences(touches: Touches) -> Touches:
    """Tracing segmentation: seqId and the four tracing flags as columns."""
    order = time_order(touches.columns)
    finger_text = F.col("fingerId").cast("string")
    tracked = F.coalesce(finger_text.rlike("^[0-9]+$"), F.lit(False))
    numeric = finger_text.try_cast("bigint").isNotNull()
    begin, end = is_phase("B"), is_phase("E")

    distance = F.col("distance") if "distance" in touches.columns else F.lit(None).cast("double")
    previous = {"_x": F.col("x"), "_y": F.col("y"), "_d": distance}
    laid = touches.arrange(FINGER, order)
    rows = (replace(laid, hot=None)
            .running(_count=RunningSum(begin.cast("long")), _open=_open_before(begin, end),
                     **{name: Previous(value) for name, value in previous.items()})
            .with_columns(_open=F.coalesce(F.col("_open"), F.lit(False)),
                          seqId=F.when(tracked, F.col("_count")).otherwise(F.lit(0))))
    rows = rows.totals(SEQUENCE, _has_end=F.max(end))
    if laid.hot is not None:
        rows = replace(rows, hot=segment_large.tracing(laid.hot, order, begin, end, tracked, previous), stored=False)
    still = (F.abs(F.col("x") - F.col("_x")) < 0.01) & (F.abs(F.col("y") - F.col("_y")) < 0.01)
    rows = rows.with_columns(
        ORPHANED_FINGER=tracked & is_phase("M", "S", "E") & ~F.col("_open"),
        UNTERMINATED=tracked & (F.col("seqId") > 0) & ~F.col("_has_end"),
        PHANTOM_MOVE=F.coalesce(tracked & is_phase("M") & still & (distance > F.col("_d")), F.lit(False)),
        # +1 when a finger becomes active, -1 when it stops
        _active=F.when(numeric & begin & ~F.col("_open"), 1)
                 .when(numeric & end & F.col("_open"), -1).otherwise(0).cast("long"))
    rows = rows.arrange(["session_id"], order).running(_fingers=RunningSum(F.col("_active")))
    starts = F.col("_active") == 1
    return rows.with_columns(
        OVERLAPPING_FINGERIDS=starts & (F.col("_fingers") - F.col("_active") > 0),
    ).drop("_count", "_open", "_x", "_y", "_d", "_has_end", "_active", "_fingers")
