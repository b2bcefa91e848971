"""Whole documents: unknown fields, headers, metadata, broken files, and the folder job."""

import json

import pytest

from fingertrail.plans.directory import enhance_document_folder
from fingertrail.sources import sinks, variants

FILES = {
    "Coloring_a": {"message": "hi", "device": {"model": "M", "sizes": [1, 2]}, "json": {
        "dataSet": "Coloring", "room": 4, "touchData": {
            "1": [{"x": 800.0, "y": 1.0, "time": 0.5, "touchPhase": "Began", "pressure": 0.25, "color": "Red", "zone": "Wall", "completionPerc": 1.0},
                  {"x": 801.0, "y": 2.0, "time": 0.6, "touchPhase": "Moved", "pen": {"tilt": [1, 2]}, "color": "Red", "zone": "Wall", "completionPerc": 1.0},
                  {"x": 802.0, "y": 2.0, "time": 0.7, "touchPhase": "Ended", "pressure": 1, "X": "upper", "color": "Red", "zone": "Wall", "completionPerc": 2.0}],
            "two \"2\"": [{"x": 5, "y": None, "time": 2.0, "touchPhase": "Began", "fingerId": 7, "color": None, "zone": "Roof"}]}}},
    "Tracing_b": {"json": {"dataSet": "Tracing", "touchData": {"0": [
        {"x": 1.0, "y": 1.0, "time": 0.0, "touchPhase": "B", "distance": 0.0, "camFrame": 1, "isDragging": True, "zone": "z"},
        {"x": 1.0, "y": 1.0, "time": 0.1, "touchPhase": "E", "distance": 1.0, "camFrame": 2, "isDragging": True, "zone": "z"}]}}},
    "Coloring_empty": {"json": {"touchData": {}}},
    "Coloring_none": {"message": "x"},
    "Coloring_bad": "{not json",
    "Coloring_list": "[1, 2]",
    "Coloring_odd": '{"json": {"touchData": {"1": [5, {"x": "far", "x": 2.5}], "2": "text"}}}',
}


@pytest.fixture
def folder(tmp_path):
    for name, content in FILES.items():
        (tmp_path / f"{name}.json").write_text(content if isinstance(content, str) else json.dumps(content, indent=1))
    return str(tmp_path)


def test_scan_keeps_every_field(spark, folder):
    parsed = variants.parse_documents(variants.read_documents(spark, folder))
    status = {r["session_id"]: (r["status"], r["touches"], r["events"]) for r in variants.document_report(parsed).collect()}
    assert status == {"Coloring_a": ("ok", 2, 4), "Tracing_b": ("ok", 1, 2), "Coloring_empty": ("no_touch_data", 0, 0), "Coloring_none": ("no_touch_data", 0, 0),
                      "Coloring_bad": ("invalid_json", 0, 0), "Coloring_list": ("no_touch_data", 0, 0), "Coloring_odd": status["Coloring_odd"]}
    events = variants.flatten_documents(parsed.filter("session_id = 'Coloring_a'"))
    rows = {(r["Touchdata_id"], r["event_index"]): r for r in variants.widen(events).collect()}
    assert len(rows) == 4 and rows[("1", 0)]["fingerId"] == "1" and rows[('two "2"', 0)]["fingerId"] == "7"
    assert [rows[("1", k)]["pressure"] for k in range(3)] == [0.25, None, 1.0]
    assert json.loads(rows[("1", 1)]["pen"]) == {"tilt": [1, 2]} and rows[("1", 2)]["X_"] == "upper" and rows[("1", 2)]["x"] == 802.0
    kinds = {r["name"]: (r["kind"], r["events"]) for r in variants.unknown_fields(events).collect()}
    assert kinds["X"] == ("STRING", 1) and kinds["pressure"][1] == 2 and set(kinds) == {"pressure", "pen", "X"}


def test_repeated_keys_and_wrong_kinds(spark, folder):
    parsed = variants.parse_documents(variants.read_documents(spark, folder)).filter("session_id = 'Coloring_odd'")
    rows = variants.flatten_documents(parsed).collect()
    assert all(r["x"] in (None, 2.5) for r in rows)


def test_documents_round_trip_with_header_and_metadata(spark, folder):
    parsed = variants.parse_documents(variants.read_documents(spark, folder)).filter("session_id = 'Coloring_a'")
    events = variants.flatten_documents(parsed).selectExpr(
        "*", "0.9D as ml_quality_score", "'high' as quality_tier", "if(event_index = 0, 'deliberate', null) as behavioral_pattern", "double('NaN') as velocity")
    columns = [c for c in events.columns if c not in ("session_id", "extra")]
    built = sinks.enhanced_documents(events, columns, variants.document_headers(parsed)).collect()
    assert len(built) == 1 and (built[0]["n_events"], built[0]["touches"]) == (4, 2)
    got, want = json.loads(built[0]["document"]), FILES["Coloring_a"]
    assert got["message"] == "hi" and got["device"] == want["device"] and got["json"]["room"] == 4 and got["json"]["dataSet"] == "Coloring"
    assert got["ml_metadata"] == {"total_sequences": 2, "total_touch_points": 4, "quality_distribution": {"high": 4, "medium": 0, "low": 0},
                                  "anomaly_count": 0, "behavioral_patterns": {"deliberate": 2}}
    for key, entries in want["json"]["touchData"].items():
        for entry, again in zip(entries, got["json"]["touchData"][key], strict=True):
            kept = {k: v for k, v in entry.items() if v is not None and k != "fingerId"}
            assert {k: again[k] for k in kept} == kept and again["quality_tier"] == "high" and "velocity" not in again
    assert set(got["json"]["touchData"]) == set(want["json"]["touchData"])


def test_long_sessions_continue_in_further_documents(spark):
    rows = spark.range(1000).selectExpr("'s' as session_id", "string(id div 100) as Touchdata_id", "id % 100 as event_index", "id * 1.5D as x",
                                        "map('n', to_variant_object(named_struct('k', id))) as extra")
    built = sinks.enhanced_documents(rows, ["x"], document_events=70, part_events=30, hot_rows=10)
    read = variants.flatten_documents(variants.parse_documents(built))
    got = sorted((int(r["Touchdata_id"]), r["event_index"], r["x"]) for r in read.collect())
    assert built.count() > 5 and got == [(k // 100, k % 100, k * 1.5) for k in range(1000)]


def test_folder_job_writes_enhanced_documents(spark, folder, tmp_path_factory):
    target = str(tmp_path_factory.mktemp("enhanced"))
    status = {r["session_id"]: r for r in enhance_document_folder(spark, folder, f"{target}/out").collect()}
    assert {k: r["status"] for k, r in status.items() if k != "Coloring_odd"} == {
        "Coloring_a": "success", "Tracing_b": "not_coloring", "Coloring_empty": "no_touch_data", "Coloring_none": "no_touch_data",
        "Coloring_bad": "invalid_json", "Coloring_list": "no_touch_data"}
    lines = spark.read.schema("session_id string, document_no bigint, document string").json(f"{target}/out/documents")
    document = json.loads(lines.filter("session_id = 'Coloring_a'").first()["document"])
    assert document["device"] == {"model": "M", "sizes": [1, 2]} and document["ml_metadata"]["total_touch_points"] == 4
    first = document["json"]["touchData"]["1"][0]
    assert first["x"] == 800.0 and first["pressure"] == 0.25 and first["quality_tier"] in ("high", "medium", "low")
    assert spark.read.option("header", True).csv(f"{target}/out/processing_summary").count() == len(FILES)
