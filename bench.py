"""Time the headline queries on local[$BENCH_CPUS] over $BENCH_SF_DIR; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from fingertrail.checks import load_queries  # noqa: E402
from fingertrail.checks.catalog import QUERIES  # noqa: E402
from fingertrail.session import build_session  # noqa: E402

HEADLINE = ["corpus_summary", "coloring_segmentation", "tracing_segmentation", "coloring_sequence_flags",
            "tracing_row_flags", "session_type_detection", "completeness", "sequence_quality_features",
            "sequence_feature_table", "sequence_quality", "consolidated_labels", "statistical_outliers",
            "flagged_row_ranges", "csv_event_scan", "json_session_scan", "mixed_folder_job", "nearest_imputation",
            "isolation_forest", "density_clusters"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    load_queries()
    QUERIES["sequence_listing"](spark, sf_dir).count()  # start-up is not measured
    seconds = {}
    for name in HEADLINE:
        start = time.time()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.time() - start, 3)
    print(json.dumps({"metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": Path(sf_dir).name.removeprefix("sf")}))


if __name__ == "__main__":
    main()
