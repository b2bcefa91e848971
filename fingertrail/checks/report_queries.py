"""Queries over reports, output orders, sinks and re-assembled documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from fingertrail.checks.catalog import query
from fingertrail.checks.core_queries import EVENTS, flagged, traced_flags
from fingertrail.checks.feature_queries import out
from fingertrail.checks.label_queries import DESCRIBED, RULES, _RULES
from fingertrail.checks.sql import FLAGS, STEPS, TOUCH, TRACE_FLAGS, sql, tidy as t
from fingertrail.operators import features, flags, metrics, projections, reports
from fingertrail.operators.metrics import TOUCH as TOUCH_KEYS
from fingertrail.plans import cleaning
from fingertrail.schema import ALL_FLAGS, TRACING_ROW_FLAGS
from fingertrail.session import scratch_path
from fingertrail.sources import documents, sinks
from fingertrail.sources.touch_view import touch_view

_OCCUR = """,
names AS (SELECT DISTINCT session_id, unnest(string_split(flags, ',')) AS flag FROM flagged WHERE flags <> '')"""


@query("flagged_row_counts", sql(FLAGS, """
SELECT session_id, count(*) FILTER (flags <> '') AS flagged_rows, count(*) AS total_rows,
       round(count(*) FILTER (flags <> '') / count(*) * 100, 2) AS flagged_percentage FROM flagged GROUP BY session_id"""))
def flagged_row_counts(spark, sf_dir):
    return reports.count_flagged_rows(flagged(spark, sf_dir).rows())


@query("flag_row_counts", sql(FLAGS + _OCCUR, """
SELECT session_id, flag, (SELECT count(*) FROM flagged f WHERE f.session_id = names.session_id AND contains(f.flags, flag)) AS rows
FROM names"""))
def flag_row_counts(spark, sf_dir):
    return reports.flag_row_counts(flagged(spark, sf_dir).rows())


def _summary_column(flag):
    return (f"CASE WHEN bool_or(list_contains(string_split(flags, ','), '{flag}')) "
            f"THEN count(*) FILTER (contains(flags, '{flag}')) END AS flag_{flag}")


@query("corpus_summary", sql(FLAGS, f"""
SELECT session_id AS filename, 'Coloring' AS data_type, count(*) FILTER (flags <> '') AS flagged_rows, count(*) AS total_rows,
       round(count(*) FILTER (flags <> '') / count(*) * 100, 2)::VARCHAR || '%' AS flagged_percentage,
       {', '.join(_summary_column(f) for f in ALL_FLAGS)} FROM flagged GROUP BY session_id"""))
def corpus_summary(spark, sf_dir):
    return reports.corpus_summary(flagged(spark, sf_dir).rows(), F.lit("Coloring"))


@query("corpus_summary_tracing", sql(TRACE_FLAGS, f"""
SELECT session_id AS filename, 'Tracing' AS data_type, count(*) FILTER (flags <> '') AS flagged_rows, count(*) AS total_rows,
       round(count(*) FILTER (flags <> '') / count(*) * 100, 2)::VARCHAR || '%' AS flagged_percentage,
       {', '.join(_summary_column(f) for f in ALL_FLAGS)} FROM tflagged GROUP BY session_id"""))
def corpus_summary_tracing(spark, sf_dir):
    return reports.corpus_summary(traced_flags(spark, sf_dir).rows(), F.lit("Tracing"))


@query("high_flag_sessions", sql(FLAGS, """
SELECT session_id, round(count(*) FILTER (flags <> '') / count(*) * 100, 2) AS flagged_percentage,
       CASE WHEN round(count(*) FILTER (flags <> '') / count(*) * 100, 2) > 99 THEN 'high' ELSE 'normal' END AS alert
FROM flagged GROUP BY session_id"""))
def high_flag_sessions(spark, sf_dir):
    """Alert level of each session, with a limit of 99 percent."""
    return reports.high_flag_sessions(flagged(spark, sf_dir).rows(), limit=99.0).select(
        "session_id", "flagged_percentage", "alert")


def _with_flag(flag):
    return f"count(DISTINCT Touchdata_id) FILTER (contains(flags, '{flag}'))"


@query("completeness", sql(FLAGS + f""",
cq AS (SELECT session_id, count(*) AS rows, count(DISTINCT Touchdata_id) AS total,
         greatest({', '.join(_with_flag(f) for f in reports.COMPLETENESS_REPORT)}) AS worst,
         {', '.join(f"count(*) FILTER (contains(flags, '{f}')) AS {f}" for f in reports.COMPLETENESS_REPORT)},
         {', '.join(f"{_with_flag(f)} AS s_{f}" for f in reports.COMPLETENESS_REPORT)}
       FROM flagged GROUP BY session_id)""", f"""
SELECT session_id, rows AS total_rows, total AS total_sequences, 0 AS rows_with_no_sequence,
       total - worst AS complete_sequences, worst AS incomplete_sequences,
       printf('%.2f%%', round((total - worst) / total * 100, 2)) AS percent_complete_sequences,
       {', '.join(reports.COMPLETENESS_REPORT)},
       {', '.join(f's_{f} AS sequences_with_{f}' for f in reports.COMPLETENESS_REPORT)},
       {', '.join(f"printf('%.2f%%', round(s_{f} / total * 100, 2)) AS percent_sequences_with_{f}" for f in reports.COMPLETENESS_REPORT)}
FROM cq"""))
def completeness(spark, sf_dir):
    return reports.completeness(flagged(spark, sf_dir).rows())


@query("tracing_completeness", sql(TRACE_FLAGS, f"""
SELECT session_id, count(*) AS total_rows, count(*) FILTER (flags <> '') AS flagged_rows,
       printf('%.2f%%', round(count(*) FILTER (flags <> '') / count(*) * 100, 2)) AS flagged_percentage,
       {', '.join(f"count(*) FILTER (contains(flags, '{f}')) AS {f}" for f in TRACING_ROW_FLAGS)}
FROM tflagged GROUP BY session_id"""))
def tracing_completeness(spark, sf_dir):
    return reports.tracing_completeness(traced_flags(spark, sf_dir).rows())


_SETS = """,
sets AS (SELECT session_id, Touchdata_id, count(*) AS points, max(time) - min(time) AS duration, bool_or(flags <> '') AS has_flags
         FROM flagged GROUP BY session_id, Touchdata_id)"""


@query("flagged_comparison_by_finger", sql(FLAGS + """,
fsets AS (SELECT session_id, fingerId, seqId, count(*) AS points, max(time) - min(time) AS duration, bool_or(flags <> '') AS has_flags
          FROM flagged WHERE seqId > 0 GROUP BY session_id, fingerId, seqId)""", f"""
SELECT has_flags, count(*) AS sequences, round(count(*) / sum(count(*)) OVER () * 100, 2) AS share,
       {t('avg(points)')} AS mean_points, {t('median(points)')} AS median_points, {t('avg(duration)')} AS mean_duration,
       {t('median(duration)')} AS median_duration FROM fsets GROUP BY has_flags"""))
def flagged_comparison_by_finger(spark, sf_dir):
    """The comparison where events have no touch ids: a sequence is (finger, seqId)."""
    table = reports.compare_flagged(flagged(spark, sf_dir).drop("Touchdata_id", "event_index"))
    return out(table, {"sequences": None, "share": None, "mean_points": 6, "median_points": 6, "mean_duration": 6,
                       "median_duration": 6}, ("has_flags",))


@query("flagged_comparison", sql(FLAGS + _SETS, f"""
SELECT has_flags, count(*) AS sequences, round(count(*) / sum(count(*)) OVER () * 100, 2) AS share,
       {t('avg(points)')} AS mean_points, {t('median(points)')} AS median_points, {t('avg(duration)')} AS mean_duration,
       {t('median(duration)')} AS median_duration FROM sets GROUP BY has_flags"""))
def flagged_comparison(spark, sf_dir):
    table = reports.compare_flagged(flagged(spark, sf_dir))
    return out(table, {"sequences": None, "share": None, "mean_points": 6, "median_points": 6, "mean_duration": 6,
                       "median_duration": 6}, ("has_flags",))


@query("flag_sequence_counts", sql(FLAGS, """
SELECT flag, count(DISTINCT (session_id, Touchdata_id)) AS sequences
FROM (SELECT session_id, Touchdata_id, unnest(string_split(flags, ',')) AS flag FROM flagged WHERE flags <> '') GROUP BY flag"""))
def flag_sequence_counts(spark, sf_dir):
    return reports.flag_sequence_counts(flags.sequence_flag_sets(flagged(spark, sf_dir)))


@query("packed_sequences", sql(FLAGS, f"""
SELECT session_id, Touchdata_id, event_index // 40 AS part, count(*) AS n_events,
       string_agg(touchPhase[1:1] || CAST(x AS BIGINT), '-' ORDER BY event_index) AS points,
       any_value(has_flags) AS has_flags
FROM flagged JOIN (SELECT session_id, Touchdata_id, bool_or(flags <> '') AS has_flags FROM flagged GROUP BY ALL)
     USING (session_id, Touchdata_id) GROUP BY session_id, Touchdata_id, event_index // 40"""))
def packed_sequences(spark, sf_dir):
    """Points of each touch in parts of 40, as text."""
    packed = reports.pack_sequences(flagged(spark, sf_dir), part_events=40)
    text = F.transform("points", lambda p: F.concat(F.substring(p["touchPhase"], 1, 1), p["x"].cast("bigint")))
    return packed.select(*TOUCH_KEYS, "part", "n_events", F.array_join(text, "-").alias("points"), "has_flags")


@query("packing_totals", sql(FLAGS + _SETS, """
SELECT count(*) AS total_sequences, count(*) FILTER (has_flags) AS flagged_sequences, count(*) FILTER (NOT has_flags) AS normal_sequences,
       round(count(*) FILTER (has_flags) / count(*) * 100, 1) AS flagged_percentage FROM sets"""))
def packing_totals(spark, sf_dir):
    return reports.packing_totals(flags.sequence_flag_sets(flagged(spark, sf_dir)))


@query("normalised_time", sql(TOUCH, f"""
SELECT event_id, {t('(time - lo) / (hi - lo)')} AS norm_time
FROM (SELECT *, min(time) OVER (PARTITION BY session_id) AS lo, max(time) OVER (PARTITION BY session_id) AS hi,
        count(*) OVER (PARTITION BY session_id, Touchdata_id) AS n FROM touch) WHERE n > 1"""))
def normalised_time(spark, sf_dir):
    return out(reports.normalised_time(touch_view(spark, sf_dir)).rows(), {"norm_time": 6})


@query("time_ticks", sql(TOUCH, """
SELECT session_id, printf('%.1fs', lo) AS tick_0, printf('%.1fs', lo + (hi - lo) * 0.25::DOUBLE) AS tick_25,
       printf('%.1fs', lo + (hi - lo) * 0.5::DOUBLE) AS tick_50, printf('%.1fs', lo + (hi - lo) * 0.75::DOUBLE) AS tick_75,
       printf('%.1fs', hi) AS tick_100
FROM (SELECT session_id, min(time) AS lo, max(time) AS hi FROM touch GROUP BY session_id)"""))
def time_ticks(spark, sf_dir):
    return reports.time_ticks(touch_view(spark, sf_dir).rows())


@query("sequence_listing", sql(TOUCH, "SELECT DISTINCT session_id, Touchdata_id FROM touch"))
def sequence_listing(spark, sf_dir):
    return reports.sequence_listing(touch_view(spark, sf_dir).rows())


@query("distance_histogram", sql(TOUCH + STEPS, """
SELECT CAST(least(29, floor((distance - lo) / ((hi - lo) / 30))) AS INTEGER) AS bin, count(*) AS rows
FROM f3, (SELECT min(distance) AS lo, max(distance) AS hi FROM f3 WHERE distance BETWEEN 0 AND 1500) WHERE distance BETWEEN 0 AND 1500 GROUP BY 1"""))
def distance_histogram(spark, sf_dir):
    rows = features.basic_features(touch_view(spark, sf_dir)).rows()
    return reports.histogram(rows, "distance", 30, 0, 1500)


@query("completion_histogram", sql(TOUCH, """
SELECT CAST(least(19, floor((completionPerc - lo) / ((hi - lo) / 20))) AS INTEGER) AS bin, count(*) AS rows
FROM touch, (SELECT min(completionPerc) AS lo, max(completionPerc) AS hi FROM touch) GROUP BY 1"""))
def completion_histogram(spark, sf_dir):
    return reports.histogram(touch_view(spark, sf_dir).rows(), "completionPerc", 20)


@query("zone_value_counts", sql(TOUCH, "SELECT zone AS value, count(*) AS rows FROM touch GROUP BY zone"))
def zone_value_counts(spark, sf_dir):
    return reports.value_counts(touch_view(spark, sf_dir).rows(), "zone")


@query("flagged_row_ranges", sql(FLAGS, """
SELECT session_id, min(r) AS "start", max(r) AS "end"
FROM (SELECT session_id, r, r - row_number() OVER (PARTITION BY session_id ORDER BY r) AS island
      FROM (SELECT session_id, flags, row_number() OVER (PARTITION BY session_id ORDER BY Touchdata_id, event_index) - 1 AS r FROM flagged)
      WHERE flags <> '') GROUP BY session_id, island"""))
def flagged_row_ranges(spark, sf_dir):
    return reports.flagged_row_ranges(flagged(spark, sf_dir), ["Touchdata_id", "event_index"])


@query("merged_touch_ranges", sql(TOUCH + """,
iv AS (SELECT session_id, CAST(floor(min(time)) AS BIGINT) AS s, CAST(floor(max(time)) AS BIGINT) AS e FROM touch GROUP BY session_id, Touchdata_id),
ir AS (SELECT *, max(e) OVER (PARTITION BY session_id ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM iv),
ii AS (SELECT *, sum(CASE WHEN reach IS NULL OR s > reach + 1 THEN 1 ELSE 0 END) OVER (PARTITION BY session_id ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS island FROM ir)""", """
SELECT session_id, min(s) AS "start", max(e) AS "end" FROM ii GROUP BY session_id, island"""))
def merged_touch_ranges(spark, sf_dir):
    """Overlapping and adjacent time ranges of touches, merged."""
    touches = touch_view(spark, sf_dir)
    spans = touches.aggregate(TOUCH_KEYS, _s=F.min("time"), _e=F.max("time"))
    ranges = spans.select("session_id", F.floor("_s").alias("start"), F.floor("_e").alias("end"))
    return reports.merge_ranges(ranges, touches.hot_rows, touches.at_most)


# ---- output orders and sinks ------------------------------------------------------------------

@query("coloring_output", sql(RULES, """
SELECT session_id, Touchdata_id, event_index, x, y, round(time, 6) AS time, touchPhase, fingerId, color,
       round(completionPerc, 6) AS completionPerc, zone, flags, qs AS quality_score, it AS interaction_type,
       af AS anomaly_flag, rs AS research_suitability
FROM flagged JOIN r2 USING (session_id, Touchdata_id)"""))
def coloring_output(spark, sf_dir):
    from fingertrail.operators import labels, quality
    rows = flagged(spark, sf_dir)
    chosen = labels.rule_labels(quality.touch_profile(rows))
    table = rows.attach(chosen.select(*TOUCH_KEYS, "quality_score", "interaction_type", "anomaly_flag",
                                      "research_suitability"), TOUCH_KEYS).rows()
    return projections.coloring_output(table).withColumns({c: F.round(c, 6) for c in ("time", "completionPerc")})


@query("coloring_output_legacy", sql(FLAGS, """
SELECT session_id, fingerId, seqId, x, y, round(time, 6) AS time, touchPhase, color,
       round(completionPerc, 6) AS completionPerc, zone, 'None' AS anomaly_flag
FROM seg"""))
def coloring_output_legacy(spark, sf_dir):
    """The order for data without touch ids."""
    from fingertrail.checks.core_queries import segmented
    rows = segmented(spark, sf_dir).rows().drop("Touchdata_id", "event_index").withColumn("anomaly_flag", F.lit("None"))
    return projections.coloring_output(rows).withColumns({c: F.round(c, 6) for c in ("time", "completionPerc")})


@query("tracing_output", sql(TRACE_FLAGS, """
SELECT session_id, fingerId, x, y, round(time, 6) AS time, touchPhase, distance, camFrame, isDragging, zone, flags FROM tflagged"""))
def tracing_output(spark, sf_dir):
    return projections.tracing_output(traced_flags(spark, sf_dir).rows()).withColumn("time", F.round("time", 6))


@query("event_export", sql(TOUCH, f"""
SELECT session_id, Touchdata_id, event_index, touchPhase, {t('time')} AS time, {t('x')} AS x, zone FROM touch"""))
def event_export(spark, sf_dir):
    """Flat events written per session as Parquet, read back."""
    path = scratch_path(spark, "events")
    sinks.write_events(touch_view(spark, sf_dir).rows().select("session_id", "event_id", *EVENTS), path)
    rows = spark.read.parquet(path).withColumn("session_id", F.col("session_id").cast("bigint"))
    return out(rows, {"session_id": None, "Touchdata_id": None, "event_index": None, "touchPhase": None, "time": 6,
                      "x": 6, "zone": None}, ())


@query("flagged_export", sql(FLAGS, """
SELECT 'events' AS tbl, count(*) AS rows, count(*) FILTER (flags <> '') AS flagged FROM flagged
UNION ALL SELECT 'metrics', count(*), count(*) FILTER (seqId > 0 AND len(flag_list) > 0) FROM listed"""))
def flagged_export(spark, sf_dir):
    """Events and metrics written as CSV, read back and counted."""
    rows = flagged(spark, sf_dir)
    table = flags.attach_metric_flags(metrics.compute_sequence_metrics(rows), flags.sequence_flag_table(rows))
    path = scratch_path(spark, "flagged")
    sinks.write_flagged(rows.rows(), table, path)
    stored = None
    for name in ("events", "metrics"):
        part = spark.read.option("header", True).csv(f"{path}/{name}")
        line = part.agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.coalesce(F.col("flags"), F.lit("")) != "").alias("flagged"))
        line = line.select(F.lit(name).alias("tbl"), "*")
        stored = line if stored is None else stored.unionByName(line)
    return stored


@query("side_by_side_paste", sql(FLAGS, """
SELECT e.session_id, e.r AS position, Touchdata_id, event_index, m.fingerId AS metric_finger, m.seqId AS metric_sequence
FROM (SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY Touchdata_id, event_index) - 1 AS r FROM flagged) e
LEFT JOIN (SELECT session_id, fingerId, seqId, row_number() OVER (PARTITION BY session_id ORDER BY fingerId, seqId) - 1 AS r FROM listed) m
  ON m.session_id = e.session_id AND m.r = e.r"""))
def side_by_side_paste(spark, sf_dir):
    rows = flagged(spark, sf_dir)
    pasted = sinks.paste_side_by_side(rows, metrics.compute_sequence_metrics(rows))
    return pasted.select("session_id", F.col("_pos").alias("position"), "Touchdata_id", "event_index",
                         F.col("`     fingerId`").alias("metric_finger"), F.col("`     seqId`").alias("metric_sequence"))


@query("report_export", sql(FLAGS, """
SELECT session_id AS filename, count(*) AS total_rows, round(count(*) FILTER (flags <> '') / count(*) * 100, 2)::VARCHAR || '%' AS flagged_percentage
FROM flagged GROUP BY session_id"""))
def report_export(spark, sf_dir):
    """The summary written as CSV and read back."""
    path = scratch_path(spark, "summary")
    sinks.write_report(reports.corpus_summary(flagged(spark, sf_dir).rows(), F.lit("Coloring")), path)
    stored = spark.read.option("header", True).csv(path)
    return stored.select(F.col("filename").cast("bigint").alias("filename"),
                         F.col("total_rows").cast("bigint").alias("total_rows"), "flagged_percentage")


@query("touch_documents", sql(TOUCH, """
SELECT session_id, Touchdata_id, event_index // 30 AS part, count(*) AS n_events, min(event_index) AS first_index,
       string_agg(touchPhase[1:1], '' ORDER BY event_index) AS phases
FROM touch GROUP BY session_id, Touchdata_id, event_index // 30"""))
def touch_documents(spark, sf_dir):
    """JSON per touch part; phases and indexes are read back from the text."""
    built = sinks.touch_documents(touch_view(spark, sf_dir).rows(), EVENTS, part_events=30)
    parsed = F.from_json("document", "json struct<touchData map<string, array<struct<touchPhase string, event_index long>>>>")
    events = F.element_at(parsed["json"]["touchData"], F.col("Touchdata_id").cast("string"))
    return built.withColumn("_e", events).select(
        *TOUCH_KEYS, "part", "n_events", F.col("_e")[0]["event_index"].alias("first_index"),
        F.array_join(F.transform("_e", lambda e: F.substring(e["touchPhase"], 1, 1)), "").alias("phases"))


@query("session_documents", sql(TOUCH + """,
sizes AS (SELECT session_id, Touchdata_id, count(*) AS n FROM touch GROUP BY session_id, Touchdata_id),
placed AS (SELECT *, (sum(n) OVER (PARTITION BY session_id ORDER BY Touchdata_id) - n) // 200 AS doc FROM sizes)""", """
SELECT session_id, CAST(doc AS BIGINT) AS document_no, count(*) AS touches, CAST(sum(n) AS BIGINT) AS n_events, CAST(sum(n) AS BIGINT) AS events_in_text
FROM placed GROUP BY session_id, doc"""))
def session_documents(spark, sf_dir):
    """Session documents of about 200 events; the events are counted again in the parsed text."""
    touches = touch_view(spark, sf_dir)
    built = sinks.session_documents(touches.rows(), ["touchPhase", "x", "y", "time"], document_events=200,
                                    hot_rows=touches.hot_rows, at_most=touches.at_most)
    report = documents.parse_document_lines(built.select(
        F.concat_ws("/", "session_id", "document_no").alias("session_id"), "document"))
    counted = documents.document_report(report).select(
        F.split("session_id", "/")[0].cast("bigint").alias("session_id"),
        F.split("session_id", "/")[1].cast("bigint").alias("document_no"), F.col("events").cast("bigint").alias("events_in_text"))
    return built.select("session_id", "document_no", "touches", "n_events").join(counted, ["session_id", "document_no"])


def _kept(name):
    return f"count(*) FILTER ({_RULES[name][0]})"


@query("subset_export", sql(DESCRIBED, " UNION ALL ".join(
    f"SELECT '{name}' AS subset, {_kept(name)} AS points, round({_kept(name)} * 100.0 / count(*), 1)::DOUBLE AS retention FROM described"
    for name in _RULES)))
def subset_export(spark, sf_dir):
    """Subsets written, non-empty ones read back and counted."""
    path = scratch_path(spark, "subsets")
    columns = ["event_id", "session_id", "ml_quality_score", "quality_tier", "temporal_consistency",
               "spatial_consistency", "anomaly_type", "time_gap_outlier", "distance_outlier", "velocity_outlier"]
    rows = cleaning.describe(touch_view(spark, sf_dir)).rows().select(*columns)
    retention = sinks.write_subsets(rows, path)
    stored = None
    for row in retention.collect():  # four rows
        part = spark.read.parquet(f"{path}/{row.subset}") if row.points else rows.limit(0)
        line = part.agg(F.count(F.lit(1)).alias("points")).select(
            F.lit(row.subset).alias("subset"), "points", F.lit(row.retention).alias("retention"))
        stored = line if stored is None else stored.unionByName(line)
    return stored


@query("directory_job_status", sql(RULES, """
SELECT session_id, 'ok' AS status, count(*) AS events, count(*) FILTER (flags <> '') AS flagged_rows FROM flagged
WHERE session_id % 4 <> 0 GROUP BY session_id
UNION ALL SELECT DISTINCT session_id, 'invalid_json', 0, 0 FROM flagged WHERE session_id % 4 = 0"""))
def directory_job_status(spark, sf_dir):
    """One job over a folder of documents, every fourth broken: status and summary per session."""
    from fingertrail.plans.directory import process_documents
    touches = touch_view(spark, sf_dir)
    built = sinks.session_documents(touches.rows(), [c for c in EVENTS if c not in ("Touchdata_id", "event_index")],
                                    hot_rows=touches.hot_rows, at_most=touches.at_most)
    damaged = F.when(F.col("session_id") % 4 == 0, F.concat(F.lit("["), F.col("document"))).otherwise(F.col("document"))
    path = scratch_path(spark, "folder")
    built.select(F.col("session_id").cast("string"), damaged.alias("document")).write.json(path)
    stored = spark.read.schema("session_id string, document string").json(path)
    _, status = process_documents(documents.parse_document_lines(stored))
    return status.select(F.col("session_id").cast("bigint").alias("session_id"), "status", "events", "flagged_rows")


_FOLDER = TRACE_FLAGS + ", " + FLAGS.strip().replace("raw AS (", "raw_c AS (", 1).replace("FROM raw)", "FROM raw_c)", 1)


@query("mixed_folder_job", sql(_FOLDER, """
SELECT session_id, 'Coloring' AS data_type, touchPhase, flags, count(*) AS events, count(*) AS labelled, CAST(sum(Touchdata_id + event_index) AS BIGINT) AS checksum
FROM flagged GROUP BY session_id, touchPhase, flags
UNION ALL SELECT session_id + 1000000, 'Tracing', touchPhase, flags, count(*), count(*), CAST(sum(camFrame) AS BIGINT) FROM tflagged GROUP BY session_id, touchPhase, flags"""))
def mixed_folder_job(spark, sf_dir):
    """A folder of CSV files with three headers (Coloring, Coloring in another order, Tracing): flagged, labelled, written, read back."""
    from fingertrail.plans.directory import process_csv_folder
    path, target = scratch_path(spark, "mixed"), scratch_path(spark, "processed")
    colored = touch_view(spark, sf_dir).rows().select("session_id", "event_id", *EVENTS)
    traced = touch_view(spark, sf_dir, "tracing").rows().withColumn("session_id", F.col("session_id") + 1000000)
    odd = F.col("session_id") % 2 == 1
    for table in (colored.filter(~odd), colored.filter(odd).select(*reversed(colored.columns)),
                  traced.select("fingerId", "event_id", "isDragging", "x", "y", "time", "touchPhase", "distance", "camFrame", "zone", "session_id")):
        table.write.mode("append").option("header", True).csv(path)
    process_csv_folder(spark, path, target, anomalies="simple", session_column="session_id")
    result = None
    for kind, key in (("coloring", F.col("Touchdata_id").cast("bigint") + F.col("event_index").cast("bigint")), ("tracing", F.col("camFrame").cast("bigint"))):
        rows = spark.read.option("header", True).csv(f"{target}/{kind}/events")
        part = rows.groupBy(F.col("session_id").cast("bigint").alias("session_id"), F.lit(kind.capitalize()).alias("data_type"),
                            "touchPhase", F.coalesce("flags", F.lit("")).alias("flags")).agg(
            F.count(F.lit(1)).alias("events"), F.count("research_suitability").alias("labelled"), F.sum(key).alias("checksum"))
        result = part if result is None else result.unionByName(part)
    return result
