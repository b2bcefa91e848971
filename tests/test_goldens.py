"""Known results of real recordings, where they are at hand.

GOLDEN_RAW names a folder of event CSV files, GOLDEN_FLAGGED the folder of their flagged tables.
"""

import csv
import os
from pathlib import Path

import pytest

from fingertrail.operators import features, labels, quality
from fingertrail.operators.groups import split_sessions
from fingertrail.plans import cleaning
from fingertrail.sources.tables import read_event_csv

RAW, DONE = (Path(os.environ.get(name, "/nonexistent")) for name in ("GOLDEN_RAW", "GOLDEN_FLAGGED"))
pytestmark = pytest.mark.skipif(not (RAW.exists() and DONE.exists()), reason="no known results at hand")


def golden():
    for path in sorted(DONE.glob("Coloring*.csv")):
        with open(path) as handle:
            lines = csv.reader(handle)
            head = next(lines)
            for line in lines:
                yield path.stem, dict(zip(head[:15], line[:15]))


@pytest.mark.parametrize("hot_rows", [None, 50])
def test_flags(spark, hot_rows):
    rows = cleaning.flag_coloring(split_sessions(read_event_csv(spark, str(RAW)), hot_rows)).rows().collect()
    got = {(r.session_id, r.Touchdata_id, r.event_index): r.flags for r in rows}
    lines = list(golden())
    assert len(lines) == 485
    for name, line in lines:
        assert got[(name, int(line["Touchdata_id"]), int(line["event_index"]))] == line["flags"]


def test_primary_labels(spark):
    rows = cleaning.flag_coloring(split_sessions(read_event_csv(spark, str(RAW))))
    table = labels.consolidated_labels(quality.touch_profile(features.extract_all_features(rows)))
    got = {(r.session_id, r.Touchdata_id): r for r in table.collect()}
    for name, line in golden():
        found = got[(name, int(line["Touchdata_id"]))]
        assert found.quality_score == int(float(line["quality_score"]))
        assert found.interaction_type == line["interaction_type"]
