"""Events kept in buckets of sessions: segmentation over them needs no exchange, and gives the same rows."""

import uuid

from fingertrail.operators.groups import split_sessions
from fingertrail.operators.segment import segment_sequences
from fingertrail.sources import sinks, tables


def rows_of(touches):
    return sorted(tuple(r) for r in touches.rows().select("session_id", "fingerId", "event_id", "seqId", "orphaned_events").collect())


def test_segmentation_over_buckets_plans_no_exchange(spark):
    name = f"events_{uuid.uuid4().hex}"
    phases = ["Began", "Moved", "Ended", "Moved"]
    df = spark.createDataFrame([(k % 7, k % 2, float(k // 14), k, phases[k // 14 % 4]) for k in range(1400)],
                               "session_id long, fingerId int, time double, event_id long, touchPhase string")
    sinks.write_event_table(df, name, 4)
    try:
        done = segment_sequences(tables.read_event_table(spark, name))
        plan = done.rows()._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Window" in plan
        assert rows_of(done) == rows_of(segment_sequences(split_sessions(df)))
        assert rows_of(segment_sequences(tables.read_event_table(spark, name, hot_rows=150))) == rows_of(done)
    finally:
        spark.sql(f"DROP TABLE {name}")
