"""Folder scans: one file per session, broken files, and the complete CSV job."""

import pytest
from pyspark.sql import functions as F

from fingertrail.operators.groups import split_sessions
from fingertrail.plans import cleaning
from fingertrail.plans.directory import process_csv_folder
from fingertrail.sources import documents, tables


def test_json_folder(spark, tmp_path):
    (tmp_path / "Coloring_a.json").write_text(
        '{"message": "ok",\n "json": {"dataSet": "Coloring", "touchData": {"1": [\n'
        '{"x": 1.0, "y": 2.0, "time": 0.5, "touchPhase": "Began", "fingerId": 0, "extra": 1}]}}}')
    (tmp_path / "b.json").write_text('{"json": ')
    (tmp_path / "c.json").write_text('{"message": "none"}')
    parsed = documents.read_session_documents(spark, str(tmp_path)).cache()
    report = {r.session_id: r.status for r in documents.document_report(parsed).collect()}
    assert report == {"Coloring_a": "ok", "b": "invalid_json", "c": "no_touch_data"}
    rows = documents.flatten_documents(parsed).collect()
    assert [(r.session_id, r.Touchdata_id, r.event_index, r.touchPhase) for r in rows] == [("Coloring_a", "1", 0, "Began")]


def test_csv_folder(spark, tmp_path):
    head = "Touchdata_id,event_index,fingerId,time,touchPhase,x,y,color,completionPerc,zone"
    source = tmp_path / "in"
    source.mkdir()
    good = [head] + [f"1,{i},0,{i / 10},{p},{i * 5},{i},Red,{i},Wall" for i, p in enumerate(["Began", "Moved", "Moved", "Ended"])]
    bad = [head] + [f"1,{i},0,{i / 10},{p},{i * 5},{i},Red,{i},Wall" for i, p in enumerate(["Began", "Moved"])]
    (source / "Coloring_good.csv").write_text("\n".join(good))
    (source / "Coloring_bad.csv").write_text("\n".join(bad))
    summary = {r.filename: r for r in process_csv_folder(spark, str(source), str(tmp_path / "out"), "simple").collect()}
    assert summary["Coloring_good"].flagged_rows == 0 and summary["Coloring_good"].total_rows == 4
    assert summary["Coloring_bad"].flag_missing_Ended == 2 and summary["Coloring_bad"].flagged_percentage == "100.0%"
    events = spark.read.option("header", True).csv(str(tmp_path / "out/coloring/events"))
    assert events.filter(F.col("session_id") == "Coloring_good").first().research_suitability is not None


def test_flagged_events_are_stored_once(spark):
    rows = [("s", 1, i, 0, i / 10, p, i * 5.0, float(i), "Red", float(i), "Wall") for i, p in enumerate(["Began", "Moved", "Ended"])]
    events = spark.createDataFrame(rows, "session_id string, Touchdata_id long, event_index long, fingerId long, time double, touchPhase string, "
                                         "x double, y double, color string, completionPerc double, zone string")
    labelled, metrics = cleaning.process_coloring(split_sessions(events), "simple")
    for table in (labelled.rows(), metrics):  # neither does the windows of segmentation again
        files = table.inputFiles()
        assert files and all("/stage-" in f for f in files)


def test_comment_lines(spark, tmp_path):
    (tmp_path / "a.csv").write_text("# made by a tool\n# on a day\nTouchdata_id,x,touchPhase\n1,2.5,Began\n")
    row = tables.read_commented_csv(spark, str(tmp_path)).first()
    assert (row.session_id, row.Touchdata_id, row.x, row.touchPhase) == ("a", 1, 2.5, "Began")


def test_each_file_by_its_own_header(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    (source / "Coloring_a.csv").write_text("Touchdata_id,event_index,fingerId,time,touchPhase,x,y,color,completionPerc,zone\n" + "\n".join(
        f"1,{i},0,{i / 10},{p},{i * 5},{i},Red,{i},Wall" for i, p in enumerate(["Began", "Moved", "Moved", "Ended"])))
    (source / "Coloring_c.csv").write_text("x,y,time,touchPhase,\"color\",completionPerc,zone,fingerId,event_index,Touchdata_id\n" + "\n".join(
        f"{i * 5},{i},{i / 10},{p},Red,{i},Wall,0,{i},7" for i, p in enumerate(["Began", "Moved", "Moved", "Ended"])))
    (source / "Tracing_b.csv").write_text("fingerId,x,y,time,touchPhase,distance,camFrame,isDragging,zone\n" + "\n".join(
        f"0,{i * 5},{i},{i / 10},{p},{i},{i},true,Wall" for i, p in enumerate(["B", "M", "M", "E"])))
    summary = {r.filename: r for r in process_csv_folder(spark, str(source), str(tmp_path / "out"), "simple").collect()}
    assert {k: (r.data_type, r.total_rows, r.flagged_rows) for k, r in summary.items()} == {
        "Coloring_a": ("Coloring", 4, 0), "Coloring_c": ("Coloring", 4, 0), "Tracing_b": ("Tracing", 4, 0)}
    traced = spark.read.option("header", True).csv(str(tmp_path / "out/tracing/events"))
    assert traced.columns == ["session_id", "fingerId", "x", "y", "time", "touchPhase", "distance", "camFrame", "isDragging", "zone", "flags",
                              "quality_score", "interaction_type", "anomaly_flag", "research_suitability"]
    assert traced.filter("quality_score is null").count() == 0


def test_document_folder_by_type(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()

    def session(name, phases, extra):
        events = ",".join(f'{{"x": {i}.0, "y": 2.0, "time": {i / 10}, "touchPhase": "{p}", "fingerId": 0, {extra}}}' for i, p in enumerate(phases))
        (source / f"{name}.json").write_text(f'{{"message": "ok", "json": {{"touchData": {{"1": [{events}]}}}}}}')

    session("Coloring_x", ["Began", "Moved", "Moved", "Ended"], '"color": "Red", "completionPerc": 1.0, "zone": "Wall"')
    session("Tracing_y", ["B", "M", "E"], '"distance": 1.5, "camFrame": 3, "isDragging": true, "zone": "Wall"')
    from fingertrail.plans.directory import process_document_folder
    summary = {r.filename: r.data_type for r in process_document_folder(spark, str(source), str(tmp_path / "out"), "simple").collect()}
    assert summary == {"Coloring_x": "Coloring", "Tracing_y": "Tracing"}
    events = spark.read.option("header", True).csv(str(tmp_path / "out/coloring/events"))
    assert {"Touchdata_id", "event_index", "color", "completionPerc", "research_suitability"} <= set(events.columns)


def test_shared_folder_is_asked_for_on_a_cluster(spark):
    from fingertrail.session import is_local, shared_dir
    assert is_local("local[8]") and is_local("local") and not is_local("local-cluster[2,1,1024]") and not is_local("yarn")

    class Cluster:
        class conf:
            get = staticmethod(lambda key, default: default)

        class sparkContext:
            master = "yarn"
            getCheckpointDir = staticmethod(lambda: None)

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(Cluster)


def test_labels_of_null_keys_do_not_depend_on_size(spark):
    from fingertrail.operators.groups import split_sessions
    rows = spark.createDataFrame([(1, "a" if k % 2 else None, k) for k in range(8)], "session_id long, key string, k long")
    names = spark.createDataFrame([(1, "a", "yes"), (1, None, "no")], "session_id long, key string, label string")
    found = []
    for limit in (100, 3):
        parts = split_sessions(rows, limit)
        assert (parts.hot is None) == (limit == 100)
        found.append(sorted((r.k, r.label) for r in parts.attach(names, ["session_id", "key"]).rows().collect()))
    assert found[0] == found[1] == [(k, "yes" if k % 2 else None) for k in range(8)]
