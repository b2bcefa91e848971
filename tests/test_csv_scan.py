"""Files of any headers in one pass: order of columns, odd lines, split files, and no second read."""

import pytest

from fingertrail.sources import csv_scan, tables

ROWS = 4000


@pytest.fixture
def small_splits(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    for k in old:
        spark.conf.set(k, "8k")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def test_odd_lines(spark, tmp_path):
    (tmp_path / "Coloring a+b.csv").write_text("﻿x,touchPhase,zone,own,x\n1.5,Began,\"Wall, left\",p,9\n\n2,Moved\nbad,Ended,,\"\",7,8,9\n3,\"a \"\"q\"\"\",\"b \\\"c\\\"\",,\n")
    (tmp_path / "c.csv").write_text("zone,x\n")
    (tmp_path / "d.csv").write_text("")
    rows = {r["touchPhase"]: r for r in tables.scan_event_csv(spark, str(tmp_path)).collect()}
    assert {r["session_id"] for r in rows.values()} == {"Coloring a+b"}
    assert (rows["Began"]["x"], rows["Began"]["zone"], rows["Began"]["extra"]) == (1.5, "Wall, left", {"own": "p"})
    assert (rows["Moved"]["x"], rows["Moved"]["zone"]) == (2.0, None) and rows["Ended"]["x"] is None
    assert rows['a "q"']["zone"] == 'b "c"'
    wide = tables.read_event_csv(spark, str(tmp_path))
    assert set(wide.columns) == {"x", "touchPhase", "zone", "own", "session_id"} and wide.count() == 4


def test_no_files(spark, tmp_path):
    (tmp_path / "other.txt").write_text("x\n1\n")
    assert tables.read_event_csv(spark, str(tmp_path)).count() == 0
    assert tables.scan_event_csv(spark, str(tmp_path)).count() == 0


def write_files(folder):
    want = set()
    for f in range(3):
        names = ["x", "y", "touchPhase", f"own{f}", "event_index"]
        names = names[f:] + names[:f]
        lines = ["# written by a tool", ",".join(names)]
        for k in range(ROWS if f < 2 else 5):
            values = {"x": str(k * 0.5), "y": str(f), "touchPhase": "Moved", f"own{f}": f"o{k}", "event_index": str(k)}
            lines.append(",".join(values[n] for n in names))
            want.add((f"s{f}", k, k * 0.5, float(f), "Moved", f"own{f}", f"o{k}"))
        (folder / f"s{f}.csv").write_text("\n".join(lines) + "\n")
    return want


def scanned(spark, folder):
    rows = tables.scan_event_csv(spark, str(folder), comment="#").collect()
    return [(r["session_id"], r["event_index"], r["x"], r["y"], r["touchPhase"], *next(iter(r["extra"].items()))) for r in rows]


def test_lines_of_later_splits_meet_their_header(spark, tmp_path, small_splits):
    want = write_files(tmp_path)
    got = scanned(spark, tmp_path)
    assert len(got) == len(want) and set(got) == want
    assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 10


def test_whole_files_are_read_once_without_a_store(spark, tmp_path):
    want = write_files(tmp_path)
    assert set(scanned(spark, tmp_path)) == want
    plan = tables.scan_event_csv(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Exchange" not in plan and "Union" not in plan


def test_many_headers_do_not_grow_the_plan(spark, tmp_path):
    for k in range(300):
        (tmp_path / f"f{k}.csv").write_text(f"x,only{k}\n{k},v\n")
    events = tables.read_event_csv(spark, str(tmp_path))
    assert len(events.columns) == 302 and events.count() == 300
    assert csv_scan.session_name("file:/a/b%20c.csv") == "b c"
    assert events._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
