"""Segmentation against a row-at-a-time reading, over all phase strings up to a length."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from fingertrail import session
from fingertrail.operators.groups import split_sessions
from fingertrail.operators.segment import segment_sequences, segment_tracing_sequences

LONG = {"B": "Began", "M": "Moved", "E": "Ended", "C": "Canceled", "X": "Other"}


def coloring_loop(word):
    number, is_open, middle, start, closed = 0, False, False, 0, False
    ids, broken, orphan, improper = [], [False] * len(word), [False] * len(word), [False] * len(word)
    for i, phase in enumerate(word):
        belongs = is_open
        if phase == "B":
            if is_open:
                for j in range(start, i):
                    broken[j] = improper[j] = True
            number, is_open, middle, start, belongs = number + 1, True, False, i, True
        elif phase in "EC":
            if is_open:
                if not middle:
                    for j in range(start, i + 1):
                        improper[j] = True
                is_open, closed = False, True
            else:
                orphan[i] = True
        elif is_open:
            middle = middle or phase == "M"
        else:
            orphan[i] = closed
        ids.append(number if belongs else 0)
    return list(zip(ids, broken, orphan, improper))


def tracing_loop(word):
    number, is_open, ids, orphan = 0, False, [], []
    ended = set()
    for phase in word:
        lost = False
        if phase == "B":
            number, is_open = number + 1, True
        elif phase == "E" and is_open:
            is_open = False
            ended.add(number)
        elif phase in "MSE" and not is_open:
            lost = True
        ids.append(number)
        orphan.append(lost)
    return [(i, o, i > 0 and i not in ended) for i, o in zip(ids, orphan)]


def rows_of(words, names=None):
    """Each word is a finger of its own session group; a 'B' elsewhere keeps the alphabet decided."""
    rows = []
    for n, word in enumerate(words):
        rows += [(n // 50, n % 50, float(i), i, (names or {}).get(p, p)) for i, p in enumerate(word)]
    return rows


def frame(spark, rows):
    df = spark.createDataFrame(rows, "session_id long, fingerId int, time double, event_id long, touchPhase string")
    return df.withColumns({"x": F.lit(0.0), "y": F.col("time")})


@pytest.mark.parametrize("hot_rows", [None, 120])
def test_coloring_strings(spark, hot_rows):
    words = ["".join(w) for n in range(1, 5 if hot_rows is None else 4) for w in itertools.product("BMECX", repeat=n)]
    rows = rows_of(words, LONG)
    rows += [(s, 99, 0.0, 0, "Began") for s in range(len(words) // 50 + 1)]
    found = segment_sequences(split_sessions(frame(spark, rows), hot_rows)).rows().collect()
    got = {(r.session_id, r.fingerId, r.event_id): (r.seqId, r.sequence_interrupted, r.orphaned_events,
                                                    r.improper_sequence_order) for r in found}
    for n, word in enumerate(words):
        want = coloring_loop(word)
        assert [got[(n // 50, n % 50, i)] for i in range(len(word))] == want, word
    assert not any(r.multiple_end_events for r in found)


def test_tracing_strings(spark):
    words = ["".join(w) for n in range(1, 5) for w in itertools.product("BMSEX", repeat=n)]
    found = segment_tracing_sequences(split_sessions(frame(spark, rows_of(words)))).rows().collect()
    got = {(r.session_id, r.fingerId, r.event_id): (r.seqId, r.ORPHANED_FINGER, r.UNTERMINATED) for r in found}
    for n, word in enumerate(words):
        assert [got[(n // 50, n % 50, i)] for i in range(len(word))] == tracing_loop(word), word


def long_words(seed, phases, shortest):
    """Strings far longer than a chunk, with long stretches that hold no begin or no end."""
    rng = random.Random(seed)
    weights = [rng.choice([[1] * len(phases), [1, 12, 12, 1, 1], [12, 2, 1, 1, 1], [1, 1, 12, 1, 3]]) for _ in range(12)]
    return ["".join(rng.choices(phases, w, k=rng.randint(shortest, 90))) for w in weights]


@pytest.mark.parametrize("hot_rows", [3, 7, 11, 40])
def test_borders_of_chunks_change_nothing(spark, hot_rows):
    """Sessions of one to three fingers, cut into chunks of about hot_rows rows wherever the ranges fall."""
    for phases, segment, loop in (("BMECX", segment_sequences, coloring_loop), ("BMSEX", segment_tracing_sequences, tracing_loop)):
        words = long_words(hot_rows, phases, 50)
        names = LONG if phases == "BMECX" else {}
        rows = [(n // 3, n % 3 if n % 3 else None, float(i), i, names.get(p, p)) for n, word in enumerate(words) for i, p in enumerate("B" + word)]
        parts = split_sessions(frame(spark, rows).withColumn("distance", F.col("event_id") * 1.0), hot_rows)
        assert parts.hot is not None
        done = segment(parts)
        assert done.hot.select("_chunk").distinct().count() > len(words)
        found = done.rows().collect()
        assert len(found) == len(rows)
        got = {(r.session_id, r.fingerId, r.event_id): r for r in found}
        for n, word in enumerate(words):
            own = [got[(n // 3, n % 3 if n % 3 else None, i)] for i in range(len(word) + 1)]
            if loop is coloring_loop:
                assert [(r.seqId, r.sequence_interrupted, r.orphaned_events, r.improper_sequence_order) for r in own] == loop("B" + word), word
            elif n % 3:
                assert [(r.seqId, r.ORPHANED_FINGER, r.UNTERMINATED) for r in own] == loop("B" + word), word
                assert not any(r.PHANTOM_MOVE for r in own if r.touchPhase != "M")


def test_large_sessions_are_rewritten_at_most_twice(spark, monkeypatch):
    """Wide tables (with event rows) that are stored on the way: one layout for Coloring, two for Tracing."""
    from fingertrail.operators import groups, segment_large
    stored = []

    def counting(df):
        if "event_id" in df.columns:
            stored.append(df.columns)
        return session.store(df)

    monkeypatch.setattr(groups, "store", counting)
    monkeypatch.setattr(segment_large, "store", counting)
    rows = frame(spark, [(1, 1, float(i), i, "BMME"[i % 4]) for i in range(100)])
    for segment, most in ((segment_sequences, 1), (segment_tracing_sequences, 2)):
        stored.clear()
        segment(split_sessions(rows, 10)).rows().count()
        assert 1 <= len(stored) <= most


def test_overlap_and_phantom(spark):
    rows = [(1, "1", 0.0, 0, "B", 0.0, 0.0, 0.0), (1, "2", 1.0, 1, "B", 5.0, 5.0, 0.0), (1, "1", 2.0, 2, "M", 0.0, 0.001, 4.0),
            (1, "1", 3.0, 3, "E", 0.0, 0.0, 4.0), (1, "2", 4.0, 4, "B", 5.0, 5.0, 1.0), (1, "x", 5.0, 5, "B", 0.0, 0.0, 0.0)]
    df = spark.createDataFrame(rows, "session_id long, fingerId string, time double, event_id long, touchPhase string, "
                                     "x double, y double, distance double")
    got = {r.event_id: r for r in segment_tracing_sequences(split_sessions(df)).rows().collect()}
    assert [got[i].OVERLAPPING_FINGERIDS for i in range(6)] == [False, True, False, False, False, False]
    assert got[2].PHANTOM_MOVE and not got[3].PHANTOM_MOVE
    assert got[5].seqId == 0 and not got[5].UNTERMINATED  # a finger id that is no number is left out
