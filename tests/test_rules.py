"""Small cases with known answers: patterns, flags, detection, features, documents."""

import math

import pytest
from pyspark.sql import functions as F

from fingertrail.operators import detect, features, metrics, quality
from fingertrail.operators.flags import apply_flag_rules
from fingertrail.operators.groups import split_sessions
from fingertrail.operators.segment import segment_sequences
from fingertrail.sources import documents

NAMES = {"B": "Began", "M": "Moved", "S": "Stationary", "E": "Ended", "C": "Canceled", "X": "Invalid"}


def touches(spark, words, step=0.1):
    rows = []
    for touch, word in words.items():
        for i, p in enumerate(word):
            rows.append(("s", touch, i, 1, touch * 10.0 + i * step, NAMES[p], 100.0 + 10 * i, 100.0 + 5 * i, "Red", "Wall", 1.0 * i))
    df = spark.createDataFrame(rows, "session_id string, Touchdata_id long, event_index long, fingerId int, time double, "
                                     "touchPhase string, x double, y double, color string, zone string, completionPerc double")
    return split_sessions(df)


VALID = ["BME", "BMMME", "BSSE", "BMSME", "BMSCE", "BE"]
INVALID = ["ME", "BM", "BMCCE", "BCME", "BMXE", "MME", "BMM", "B"]


def test_strict_pattern(spark):
    words = dict(enumerate(VALID + INVALID, 1))
    got = {r.Touchdata_id: r.is_valid for r in metrics.validate_touch_patterns(touches(spark, words)).collect()}
    assert [got[i] for i in words] == [True] * len(VALID) + [False] * len(INVALID)


def test_flags_of_small_touches(spark):
    rows = apply_flag_rules(segment_sequences(touches(spark, {1: "BMSE", 2: "BMCE", 3: "ME", 4: "BM", 5: "BCCE"}))).rows()
    flags = {}
    for r in rows.collect():
        flags.setdefault(r.Touchdata_id, set()).update(f for f in r.flags.split(",") if f)
    assert flags[1] == set()
    # a cancel closes the sequence, so the end after it is orphaned although the touch is valid
    assert flags[2] == {"orphaned_events"}
    assert flags[4] >= {"missing_Ended"} or flags[4] >= {"sequence_interrupted"}
    assert flags[5]


def detection(spark, name, phases, extra=""):
    rows = [(name, p) for p in phases]
    df = spark.createDataFrame(rows, "session_id string, touchPhase string")
    for column in extra.split():
        df = df.withColumn(column, F.lit(1))
    return detect.detect_data_type(df).first().data_type


def test_detection(spark):
    coloring, tracing = ["Began", "Moved", "Ended"], ["B", "M", "E"]
    assert detection(spark, "Coloring_a", coloring) == "Coloring"
    assert detection(spark, "Tracing_a", tracing) == "Tracing"
    assert detection(spark, "a", coloring, "color completionPerc") == "Coloring"
    assert detection(spark, "a", tracing, "distance camFrame isDragging") == "Tracing"
    assert detection(spark, "Coloring_a", tracing, "distance camFrame isDragging") == "Tracing"
    assert detection(spark, "a", ["Q"]) == "Unknown"
    assert detection(spark, "a", coloring + tracing) != "Unknown"
    with pytest.raises(ValueError):
        detect.detect_data_type(spark.range(1).withColumn("session_id", F.lit("a")))


def test_features_of_a_clean_touch(spark):
    rows = features.extract_all_features(touches(spark, {1: "BMME"}, step=100.0)).rows().orderBy("event_index").collect()
    assert [r.time_diff for r in rows] == [0, 100, 100, 100]
    assert rows[1].distance == pytest.approx(math.sqrt(125))
    assert [r.phase_transition for r in rows[:2]] == ["start_Began", "Began_to_Moved"]
    assert rows[0].sequence_valid_pattern == 1 and rows[0].zone_change == 1 and rows[1].zone_change == 0
    # the running time sums the absolute times
    assert rows[1].cumulative_time == rows[0].time + rows[1].time


def test_quality_tiers(spark):
    table = quality.sequence_quality(quality.touch_profile(touches(spark, {1: "BMME", 2: "BM", 3: "B"})))
    got = {r.Touchdata_id: r for r in table.collect()}
    assert got[1].quality_tier == "high" and got[1].ml_quality_score == pytest.approx(1.0)
    assert got[2].temporal_consistency == 0.0  # one step has no spread
    assert got[3].ml_quality_score == 0.0 and got[3].quality_tier == "low"


def test_documents(spark):
    good = '{"json": {"touchData": {"7": [{"x": 1, "time": 2.0, "touchPhase": "Began", "fingerId": 3}, {"x": 2, "time": 1.0}]}}}'
    lines = [("a", good), ("b", '{"json": {}}'), ("c", "{oops"), ("d", '{"json": {"touchData": {}}}')]
    parsed = documents.parse_document_lines(spark.createDataFrame(lines, "session_id string, document string"))
    events = documents.flatten_documents(parsed).orderBy("event_index").collect()
    assert [(e.Touchdata_id, e.event_index, e.fingerId) for e in events] == [("7", 0, "3"), ("7", 1, "7")]
    report = {r.session_id: r.status for r in documents.document_report(parsed).collect()}
    assert report == {"a": "ok", "b": "no_touch_data", "c": "invalid_json", "d": "no_touch_data"}
