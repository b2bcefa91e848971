"""Queries over sources, detection, segmentation, metrics and flags."""

from __future__ import annotations

from pyspark.sql import functions as F

from fingertrail.checks.catalog import query
from fingertrail.checks.sql import (FLAGS, PATTERN, SEGMENT, TOUCH, TRACE, TRACE_FLAGS,
                                    TRACE_SEGMENT, sql)
from fingertrail.operators import detect, flags, metrics, projections, segment
from fingertrail.operators.groups import Touches
from fingertrail.session import scratch_path
from fingertrail.sources import documents, sinks, tables
from fingertrail.sources.touch_view import base_touches, events_table, touch_view

EVENTS = ["Touchdata_id", "event_index", "x", "y", "time", "touchPhase", "fingerId", "color",
          "completionPerc", "zone"]
DOCUMENT_PART = 25


def segmented(spark, sf_dir) -> Touches:
    return segment.segment_sequences(touch_view(spark, sf_dir))


def flagged(spark, sf_dir) -> Touches:
    return flags.apply_flag_rules(segmented(spark, sf_dir))


def traced(spark, sf_dir) -> Touches:
    return segment.segment_tracing_sequences(touch_view(spark, sf_dir, "tracing"))


def traced_flags(spark, sf_dir) -> Touches:
    return flags.apply_tracing_flag_rules(traced(spark, sf_dir))


# ---- sources ----------------------------------------------------------------------------------

_EVENT_OUT = ["session_id", "Touchdata_id", "event_index", "fingerId", "x", "y", "time", "touchPhase",
              "color", "zone", "completionPerc"]


def _event_rows(df):
    return df.select(
        F.col("session_id").cast("bigint"), F.col("Touchdata_id").cast("bigint"), "event_index",
        F.col("fingerId").cast("bigint"), "x", "y", F.round("time", 6).alias("time"), "touchPhase",
        "color", "zone", F.round("completionPerc", 6).alias("completionPerc"))


def _event_sql(index: str) -> str:
    return f"""
SELECT session_id, Touchdata_id, {index} AS event_index, CAST(fingerId AS BIGINT) AS fingerId, x, y,
       round(time, 6) AS time, touchPhase, color, zone, round(completionPerc, 6) AS completionPerc
FROM touch"""


def _document_lines(spark, sf_dir, columns):
    rows = touch_view(spark, sf_dir).rows()
    packed = sinks.touch_documents(rows, columns, DOCUMENT_PART)
    return packed.select(F.col("session_id").cast("string"), "document")


@query("json_session_scan", sql(TOUCH, _event_sql("event_index")))
def json_session_scan(spark, sf_dir):
    """Documents without own ids: touch from the map key, index from the position in the array and the part's offset."""
    columns = [c for c in EVENTS if c not in ("Touchdata_id", "event_index")]
    lines = _document_lines(spark, sf_dir, columns)
    return _event_rows(documents.flatten_documents(documents.parse_document_lines(lines)))


@query("json_session_scan_own_ids", sql(TOUCH, _event_sql("event_index")))
def json_session_scan_own_ids(spark, sf_dir):
    """Documents whose events carry ids: those are kept."""
    lines = _document_lines(spark, sf_dir, EVENTS)
    parsed = documents.parse_document_lines(lines)
    return _event_rows(documents.flatten_documents(parsed, keep_own_ids=True))


@query("json_finger_from_key", sql(TOUCH, """
SELECT session_id, Touchdata_id, Touchdata_id AS fingerId, count(*) AS events
FROM touch GROUP BY session_id, Touchdata_id"""))
def json_finger_from_key(spark, sf_dir):
    """Events without fingerId take the key of the map."""
    lines = _document_lines(spark, sf_dir, ["x", "y", "time", "touchPhase"])
    events = documents.flatten_documents(documents.parse_document_lines(lines))
    return (events.groupBy(*[F.col(c).cast("bigint").alias(c)
                             for c in ("session_id", "Touchdata_id", "fingerId")])
            .agg(F.count(F.lit(1)).alias("events")))


@query("json_directory_report", sql(TOUCH, f"""
SELECT CASE WHEN session_id % 5 = 0 THEN 'invalid_json' WHEN session_id % 5 = 1 THEN 'no_touch_data'
            ELSE 'ok' END AS status,
       count(DISTINCT (session_id, Touchdata_id, event_index // {DOCUMENT_PART})) AS documents,
       count(*) FILTER (session_id % 5 > 1) AS events
FROM touch GROUP BY 1"""))
def json_directory_report(spark, sf_dir):
    """A written folder of documents, some broken and some without touches, scanned and reported."""
    lines = _document_lines(spark, sf_dir, EVENTS)
    kind = F.col("session_id").cast("int") % 5
    damaged = (F.when(kind == 0, F.concat(F.lit("{"), F.col("document")))
               .when(kind == 1, F.lit('{"json": {"dataSet": "Coloring"}}')).otherwise(F.col("document")))
    path = scratch_path(spark, "documents")
    lines.select("session_id", damaged.alias("document")).write.json(path)
    stored = spark.read.schema("session_id string, document string").json(path)
    report = documents.document_report(documents.parse_document_lines(stored))
    return report.groupBy("status").agg(F.count(F.lit(1)).alias("documents"),
                                        F.sum("events").alias("events"))


@query("csv_event_scan", sql(TOUCH, _event_sql("event_index")))
def csv_event_scan(spark, sf_dir):
    """Events written as CSV with a header and read back with types."""
    path = scratch_path(spark, "csv")
    names = ["session_id", *EVENTS]
    touch_view(spark, sf_dir).rows().select(*names).write.option("header", True).csv(path)
    return _event_rows(tables.scan_event_csv(spark, path, session_column="session_id"))


@query("csv_comment_scan", sql(TOUCH, _event_sql("event_index")))
def csv_comment_scan(spark, sf_dir):
    """CSV with comment lines before the data of each touch."""
    path = scratch_path(spark, "csv")
    names = ["session_id", *EVENTS]
    rows = touch_view(spark, sf_dir).rows()
    note = F.when(F.col("event_index") == 0, F.concat(F.lit("# touch "), F.col("Touchdata_id")))
    lines = rows.select(F.explode(F.array_compact(F.array(note, F.to_csv(F.struct(*names))))).alias("value"))
    lines.write.text(path)
    scanned = tables.read_event_csv(spark, path, columns=names, comment="#", header=False,
                                    file_glob="*.txt", session_column="session_id")
    return _event_rows(scanned)


@query("two_table_split", sql(FLAGS, """
SELECT e.session_id, events, flagged_events, least(m.sequences, e.events) AS sequences,
       CASE WHEN m.sequences <= e.events THEN m.flagged_sequences END AS flagged_sequences
FROM (SELECT session_id, count(*) AS events, count(*) FILTER (flags <> '') AS flagged_events
      FROM flagged GROUP BY session_id) e
JOIN (SELECT session_id, count(*) AS sequences, count(*) FILTER (seqId > 0 AND len(flag_list) > 0) AS flagged_sequences
      FROM listed GROUP BY session_id) m USING (session_id)"""))
def two_table_split(spark, sf_dir):
    """Events and metrics pasted side by side, then split again."""
    rows = flagged(spark, sf_dir)
    table = flags.attach_metric_flags(metrics.compute_sequence_metrics(rows), flags.sequence_flag_table(rows))
    pasted = sinks.paste_side_by_side(rows, table).drop("_pos")
    events, found = tables.split_two_tables(pasted)
    left = events.groupBy("session_id").agg(
        F.count(F.lit(1)).alias("events"), F.count_if(F.size("flags") > 0).alias("flagged_events"))
    right = found.groupBy("session_id").agg(
        F.count(F.lit(1)).alias("sequences"), F.count_if(F.size("flags") > 0).alias("flagged_sequences"))
    return left.join(right, "session_id")


@query("file_union_statistics", sql(TOUCH, """
SELECT session_id, count(*) AS points, count(DISTINCT Touchdata_id) AS sequences,
       round(avg(completionPerc / 100), 6) AS quality_avg
FROM touch GROUP BY session_id"""))
def file_union_statistics(spark, sf_dir):
    """Files with different columns united, with statistics per file."""
    rows = touch_view(spark, sf_dir).rows().withColumn("ml_quality_score", F.col("completionPerc") / 100)
    even = rows.filter(F.col("session_id") % 2 == 0).drop("color")
    odd = rows.filter(F.col("session_id") % 2 == 1).drop("zone", "completionPerc")
    stats = tables.file_statistics(tables.union_files([even, odd]))
    return stats.withColumn("quality_avg", F.round("quality_avg", 6))


# ---- detection and projections ----------------------------------------------------------------

# Names and contents are mixed on purpose, so that every rule of the detection decides somewhere.
_MIXED = TRACE.replace("\nraw AS", "\ntraw AS").replace("FROM raw", "FROM traw") + "," + TOUCH + """,
mixed AS (
  SELECT session_id, touchPhase, color, completionPerc, NULL AS distance, NULL AS camFrame
  FROM touch WHERE session_id % 3 < 2
  UNION ALL
  SELECT session_id, touchPhase, NULL, NULL, distance, camFrame FROM trace
  WHERE session_id % 3 = 2 OR (session_id % 3 = 1 AND event_id % 3 = 0)),
facts AS (
  SELECT session_id, ['Tracing_a', 'Coloring_b', 'Tracing c', 'Coloring d', 'e'][session_id % 5 + 1] AS name,
         count(distance) > 0 AND count(camFrame) > 0 AS tcols, count(color) > 0 AND count(completionPerc) > 0 AS ccols,
         count(*) FILTER (touchPhase IN ('B', 'M', 'S', 'E')) / count(touchPhase) AS tr,
         count(*) FILTER (touchPhase IN ('Began', 'Moved', 'Stationary', 'Ended', 'Canceled')) / count(touchPhase) AS cr,
         bool_or(touchPhase = 'B') AND bool_or(touchPhase = 'E') AS be,
         bool_or(touchPhase = 'Began') AND bool_or(touchPhase = 'Ended') AS began_ended
  FROM mixed GROUP BY session_id),
scores AS (
  SELECT *,
    CASE WHEN name LIKE 'Tracing\\_%' ESCAPE '\\' THEN 0.6::DOUBLE WHEN name LIKE 'Tracing%' THEN 0.4::DOUBLE ELSE 0::DOUBLE END
    + CASE WHEN tcols THEN 0.3::DOUBLE ELSE 0::DOUBLE END
    + CASE WHEN tr > 0.1 AND cr > 0.1 THEN CASE WHEN tr > cr THEN 0.2::DOUBLE * tr ELSE 0::DOUBLE END
           WHEN tr > 0.5 THEN 0.2::DOUBLE ELSE 0::DOUBLE END
    + CASE WHEN be THEN 0.1::DOUBLE ELSE 0::DOUBLE END AS ts,
    CASE WHEN name LIKE 'Coloring\\_%' ESCAPE '\\' THEN 0.6::DOUBLE WHEN name LIKE 'Coloring%' THEN 0.4::DOUBLE ELSE 0::DOUBLE END
    + CASE WHEN ccols AND NOT tcols THEN 0.3::DOUBLE ELSE 0::DOUBLE END
    + CASE WHEN tr > 0.1 AND cr > 0.1 THEN CASE WHEN tr <= cr THEN 0.2::DOUBLE * cr ELSE 0::DOUBLE END
           WHEN tr <= 0.5 AND cr > 0.5 THEN 0.2::DOUBLE ELSE 0::DOUBLE END
    + CASE WHEN began_ended THEN 0.1::DOUBLE ELSE 0::DOUBLE END AS cs
  FROM facts),
types AS (
  SELECT session_id, ts, cs,
    CASE WHEN name LIKE 'Coloring\\_%' ESCAPE '\\' AND ts >= 0.3 THEN 'Tracing'
         WHEN name LIKE 'Tracing\\_%' ESCAPE '\\' AND cs >= 0.3 THEN 'Coloring'
         WHEN ts > cs THEN 'Tracing' WHEN cs > ts THEN 'Coloring' ELSE 'Unknown' END AS data_type
  FROM scores)
"""


def _mixed_rows(spark, sf_dir):
    events = events_table(spark, sf_dir)
    keep = ["event_id", "session_id", "touchPhase", "color", "completionPerc", "distance", "camFrame",
            "isDragging"]
    third = F.col("session_id") % 3
    coloring = base_touches(events, "coloring").filter(third < 2)
    tracing = base_touches(events, "tracing").filter(
        (third == 2) | ((third == 1) & (F.col("event_id") % 3 == 0)))
    return coloring.unionByName(tracing, allowMissingColumns=True).select(*keep)


def _mixed_name():
    names = ["Tracing_a", "Coloring_b", "Tracing c", "Coloring d", "e"]
    return F.element_at(F.array(*[F.lit(n) for n in names]), (F.col("session_id") % 5 + 1).cast("int"))


@query("session_type_detection", sql(_MIXED, """
SELECT session_id, round(ts, 6) AS tracing_score, round(cs, 6) AS coloring_score, data_type FROM types"""))
def session_type_detection(spark, sf_dir):
    types = detect.detect_data_type(_mixed_rows(spark, sf_dir), _mixed_name())
    return types.select("session_id", F.round("tracing_score", 6).alias("tracing_score"),
                        F.round("coloring_score", 6).alias("coloring_score"), "data_type")


@query("session_type_simple", sql(_MIXED, """
SELECT session_id, CASE WHEN ccols THEN 'Coloring' ELSE 'Tracing' END AS data_type FROM facts"""))
def session_type_simple(spark, sf_dir):
    return detect.simple_data_type(_mixed_rows(spark, sf_dir))


@query("session_routing", sql(_MIXED, """
SELECT data_type, touchPhase, count(*) AS events FROM mixed JOIN types USING (session_id)
WHERE data_type <> 'Unknown' GROUP BY ALL"""))
def session_routing(spark, sf_dir):
    rows = _mixed_rows(spark, sf_dir)
    routed = detect.route_sessions(rows, detect.detect_data_type(rows, _mixed_name()))
    return routed.groupBy("data_type", "touchPhase").agg(F.count(F.lit(1)).alias("events"))


@query("detection_statistics", sql(_MIXED, """
SELECT data_type, count(*) AS sessions FROM types GROUP BY data_type"""))
def detection_statistics(spark, sf_dir):
    return detect.detection_statistics(detect.detect_data_type(_mixed_rows(spark, sf_dir), _mixed_name()))


@query("sequence_filter_flagged", sql(FLAGS, """
SELECT f.event_id, f.session_id, f.Touchdata_id, f.flags FROM flagged f
WHERE EXISTS (SELECT 1 FROM flagged g WHERE g.session_id = f.session_id AND g.Touchdata_id = f.Touchdata_id
  AND len(list_intersect(string_split(g.flags, ','), ['sequence_gap', 'has_canceled'])) > 0)"""))
def sequence_filter_flagged(spark, sf_dir):
    rows = flagged(spark, sf_dir)
    shown = projections.show_sequences(rows.rows(), flags.sequence_flag_sets(rows), metrics.TOUCH,
                                       "flagged", ["sequence_gap", "has_canceled"])
    return shown.select("event_id", "session_id", "Touchdata_id", "flags")


@query("sequence_filter_unflagged", sql(FLAGS, """
SELECT f.event_id, f.session_id, f.Touchdata_id, f.flags FROM flagged f
WHERE NOT EXISTS (SELECT 1 FROM flagged g WHERE g.session_id = f.session_id AND g.Touchdata_id = f.Touchdata_id
  AND len(list_intersect(string_split(g.flags, ','), ['sequence_gap', 'has_canceled'])) > 0)"""))
def sequence_filter_unflagged(spark, sf_dir):
    rows = flagged(spark, sf_dir)
    shown = projections.show_sequences(rows.rows(), flags.sequence_flag_sets(rows), metrics.TOUCH,
                                       "non_flagged", ["sequence_gap", "has_canceled"])
    return shown.select("event_id", "session_id", "Touchdata_id", "flags")


# ---- segmentation, metrics, patterns ----------------------------------------------------------

@query("coloring_segmentation", sql(SEGMENT, """
SELECT event_id, session_id, fingerId, touchPhase, seqId, sequence_interrupted, orphaned_events,
       multiple_end_events, improper_sequence_order FROM seg"""))
def coloring_segmentation(spark, sf_dir):
    return segmented(spark, sf_dir).rows().select(
        "event_id", "session_id", "fingerId", "touchPhase", "seqId", "sequence_interrupted",
        "orphaned_events", "multiple_end_events", "improper_sequence_order")


@query("tracing_segmentation", sql(TRACE_SEGMENT, """
SELECT event_id, session_id, fingerId, touchPhase, seqId, ORPHANED_FINGER, UNTERMINATED, PHANTOM_MOVE,
       OVERLAPPING_FINGERIDS FROM tseg"""))
def tracing_segmentation(spark, sf_dir):
    return traced(spark, sf_dir).rows().select(
        "event_id", "session_id", "fingerId", "touchPhase", "seqId", "ORPHANED_FINGER", "UNTERMINATED",
        "PHANTOM_MOVE", "OVERLAPPING_FINGERIDS")


@query("coloring_metrics", sql(FLAGS, """
SELECT session_id, fingerId, seqId, round(startTime, 6) AS startTime, round(endTime, 6) AS endTime,
       round(durationSec, 6) AS durationSec, nPoints, hasCanceled FROM listed"""))
def coloring_metrics(spark, sf_dir):
    table = metrics.compute_sequence_metrics(segmented(spark, sf_dir))
    return table.withColumns({c: F.round(c, 6) for c in ("startTime", "endTime", "durationSec")})


_TRACE_METRICS = TRACE_SEGMENT + """,
tm AS (
  SELECT session_id, fingerId, seqId, min(time) AS s, max(time) FILTER (touchPhase = 'E') AS e,
         count(*) AS nPoints, sum(distance) AS d, bool_or(ORPHANED_FINGER) AS hasOrphanedFinger,
         bool_or(UNTERMINATED) AS isUnterminated, bool_or(OVERLAPPING_FINGERIDS) AS hasOverlappingFingers,
         bool_or(PHANTOM_MOVE) AS hasPhantomMove
  FROM tseg GROUP BY session_id, fingerId, seqId)"""


@query("tracing_metrics", sql(_TRACE_METRICS, """
SELECT session_id, fingerId, seqId, round(s, 6) AS startTime, round(e, 6) AS endTime,
       round(e - s, 6) AS durationSec, nPoints, round(d, 4) AS totalDistance, hasOrphanedFinger,
       isUnterminated, hasOverlappingFingers, hasPhantomMove FROM tm"""))
def tracing_metrics(spark, sf_dir):
    table = metrics.compute_tracing_metrics(traced(spark, sf_dir))
    return table.withColumns({"totalDistance": F.round("totalDistance", 4), **{
        c: F.round(c, 6) for c in ("startTime", "endTime", "durationSec")}})


@query("strict_touch_pattern", sql(TOUCH + PATTERN, "SELECT session_id, Touchdata_id, is_valid FROM pattern"))
def strict_touch_pattern(spark, sf_dir):
    return metrics.validate_touch_patterns(touch_view(spark, sf_dir))


@query("strict_sequence_pattern", sql(SEGMENT, """
SELECT session_id, fingerId, seqId, regexp_full_match(string_agg(
         CASE touchPhase WHEN 'Began' THEN 'B' WHEN 'Moved' THEN 'M' WHEN 'Stationary' THEN 'S'
              WHEN 'Ended' THEN 'E' ELSE 'C' END, '' ORDER BY time, event_id), 'B[MS]*C?E') AS is_valid
FROM seg WHERE seqId > 0 GROUP BY session_id, fingerId, seqId"""))
def strict_sequence_pattern(spark, sf_dir):
    return metrics.validate_sequence_patterns(segmented(spark, sf_dir))


@query("loose_touch_pattern", sql(TOUCH + PATTERN, """
SELECT session_id, Touchdata_id, is_loose AS sequence_valid_pattern FROM pattern"""))
def loose_touch_pattern(spark, sf_dir):
    return metrics.check_loose_patterns(touch_view(spark, sf_dir))


# ---- flags ------------------------------------------------------------------------------------

@query("coloring_row_flags", sql(FLAGS, "SELECT event_id, session_id, fingerId, seqId, flags FROM flagged"))
def coloring_row_flags(spark, sf_dir):
    return flagged(spark, sf_dir).rows().select("event_id", "session_id", "fingerId", "seqId", "flags")


@query("coloring_sequence_flags", sql(FLAGS, """
SELECT session_id, fingerId, seqId, nPoints, round(durationSec, 6) AS durationSec,
       CASE WHEN seqId > 0 THEN array_to_string(flag_list, ',') ELSE '' END AS flags FROM listed"""))
def coloring_sequence_flags(spark, sf_dir):
    rows = flagged(spark, sf_dir)
    table = flags.attach_metric_flags(metrics.compute_sequence_metrics(rows), flags.sequence_flag_table(rows))
    return table.select("session_id", "fingerId", "seqId", "nPoints",
                        F.round("durationSec", 6).alias("durationSec"), "flags")


@query("gap_flags_small_limit", sql(FLAGS, """
SELECT session_id, fingerId, seqId, bool_or(coalesce(step > 5, FALSE)) AND NOT arg_min(is_valid, (time, event_id)) AS gap
FROM stepped WHERE seqId > 0 GROUP BY session_id, fingerId, seqId"""))
def gap_flags_small_limit(spark, sf_dir):
    """The gap limit is a parameter: 5 instead of 100."""
    rows = flags.apply_flag_rules(segmented(spark, sf_dir), max_gap=5.0)
    return flags.sequence_flag_table(rows).select(
        "session_id", "fingerId", "seqId", F.contains("flags", F.lit("sequence_gap")).alias("gap"))


@query("coloring_rules_on_tracing", sql(TRACE + """,
tr AS (SELECT *, CAST(sum(CASE WHEN touchPhase = 'B' THEN 1 ELSE 0 END) OVER f AS BIGINT) AS cb,
         coalesce(last_value(CASE WHEN touchPhase = 'B' THEN 1 WHEN touchPhase IN ('E', 'S') THEN 0 END IGNORE NULLS)
           OVER (PARTITION BY session_id, fingerId ORDER BY time, event_id
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS o
  FROM trace WINDOW f AS (PARTITION BY session_id, fingerId ORDER BY time, event_id)),
tn AS (SELECT *, CASE WHEN touchPhase = 'B' OR o = 1 THEN cb ELSE 0 END AS seqId,
         max(cb) OVER (PARTITION BY session_id, fingerId) AS last_cb FROM tr),
ts AS (SELECT *, time - lag(time) OVER (PARTITION BY session_id, fingerId, seqId ORDER BY time, event_id) AS step FROM tn),
tq AS (SELECT session_id, fingerId, seqId, count(*) AS n, bool_or(touchPhase = 'E') AS has_e,
         bool_or(touchPhase IN ('E', 'S')) AS has_end, bool_or(touchPhase = 'M') AS has_mid,
         bool_or(touchPhase = 'X') AS bad, sum(distance) AS d, bool_or(coalesce(step > 100, FALSE)) AS gap,
         max(last_cb) > seqId AS later FROM ts WHERE seqId > 0 GROUP BY session_id, fingerId, seqId)""", """
SELECT session_id, fingerId, seqId, array_to_string([f for f in [
  CASE WHEN NOT has_e AND NOT (NOT has_end AND later) THEN 'missing_E' END,
  CASE WHEN bad THEN 'invalid_TouchPhase' END, CASE WHEN n > 1 AND d = 0 THEN 'zero_distance' END,
  CASE WHEN gap THEN 'time_gap' END, CASE WHEN NOT has_end AND later THEN 'sequence_interrupted' END,
  CASE WHEN (NOT has_end AND later) OR (has_end AND NOT has_mid) THEN 'improper_sequence_order' END] if f IS NOT NULL], ',') AS flags FROM tq"""))
def coloring_rules_on_tracing(spark, sf_dir):
    """Tracing data on the general path: short phase names, S ends a sequence, Tracing rule flags."""
    rows = segment.segment_sequences(touch_view(spark, sf_dir, "tracing"))
    return flags.sequence_flag_table(flags.apply_flag_rules(rows))


@query("tracing_row_flags", sql(TRACE_FLAGS, "SELECT event_id, session_id, fingerId, seqId, flags FROM tflagged"))
def tracing_row_flags(spark, sf_dir):
    return traced_flags(spark, sf_dir).rows().select("event_id", "session_id", "fingerId", "seqId", "flags")


@query("tracing_sequence_flags", sql(_TRACE_METRICS, """
SELECT session_id, fingerId, seqId, CASE WHEN seqId = 0 THEN '' ELSE
  concat_ws(',', CASE WHEN hasOrphanedFinger THEN 'ORPHANED_FINGER' END, CASE WHEN isUnterminated THEN 'UNTERMINATED' END,
            CASE WHEN hasOverlappingFingers THEN 'OVERLAPPING_FINGERIDS' END,
            CASE WHEN hasPhantomMove THEN 'PHANTOM_MOVE' END) END AS flags FROM tm"""))
def tracing_sequence_flags(spark, sf_dir):
    table = flags.tracing_sequence_flags(metrics.compute_tracing_metrics(traced(spark, sf_dir)))
    return table.select("session_id", "fingerId", "seqId", "flags")


# Contradictions are resolved before they are stored, so the check data joins the flags of two
# sequences: those of a sequence and an interrupted or orphaned mark on every third of them.
_CLASH = """
CASE seqId % 3 WHEN 0 THEN flags || ',sequence_interrupted,missing_Ended'
               WHEN 1 THEN 'orphaned_events,missing_Began,' || flags ELSE flags END"""


def _clashing(spark, sf_dir):
    rows = flagged(spark, sf_dir)
    third = F.col("seqId") % 3
    return rows.with_columns(flags=(
        F.when(third == 0, F.concat("flags", F.lit(",sequence_interrupted,missing_Ended")))
        .when(third == 1, F.concat(F.lit("orphaned_events,missing_Began,"), F.col("flags")))
        .otherwise(F.col("flags"))))


_CONTRADICTIONS = FLAGS + f""",
clash AS (SELECT session_id, fingerId, seqId, count(*) AS nPoints, arg_min({_CLASH}, (time, event_id)) AS flags
          FROM flagged WHERE seqId > 0 GROUP BY session_id, fingerId, seqId),
found AS (SELECT *, string_split(flags, ',') AS l,
  [f for f in [
    CASE WHEN list_contains(l, 'orphaned_events') AND list_contains(l, 'missing_Began') THEN 'orphaned_events + missing_Began' END,
    CASE WHEN list_contains(l, 'sequence_interrupted') AND list_contains(l, 'missing_Ended') THEN 'sequence_interrupted + missing_Ended' END] if f IS NOT NULL] AS pairs FROM clash)"""


@query("flag_contradictions", sql(_CONTRADICTIONS, """
SELECT session_id, fingerId, seqId, flags, array_to_string(pairs, ', ') AS contradictions, nPoints
FROM found WHERE len(pairs) > 0"""))
def flag_contradictions(spark, sf_dir):
    return flags.validate_flag_consistency(_clashing(spark, sf_dir))


@query("flag_consistency_summary", sql(_CONTRADICTIONS, """
SELECT session_id, n - 1 AS total_sequences, coalesce(c, 0) AS contradictions_found
FROM (SELECT session_id, count(DISTINCT seqId) AS n FROM flagged GROUP BY session_id)
LEFT JOIN (SELECT session_id, count(*) AS c FROM found WHERE len(pairs) > 0 GROUP BY session_id) USING (session_id)"""))
def flag_consistency_summary(spark, sf_dir):
    return flags.flag_consistency_summary(_clashing(spark, sf_dir))


@query("flag_consistency_totals", sql(_CONTRADICTIONS, """
SELECT (SELECT count(DISTINCT session_id) FROM flagged) AS total_files,
       count(DISTINCT session_id) AS files_with_contradictions, count(*) AS total_contradictions
FROM found WHERE len(pairs) > 0"""))
def flag_consistency_totals(spark, sf_dir):
    return flags.flag_consistency_totals(flags.flag_consistency_summary(_clashing(spark, sf_dir)))


@query("parsed_row_flags", sql(FLAGS, """
SELECT event_id, array_to_string([trim(f) for f in string_split(t, ',') if trim(f) <> ''], '|') AS flag_list
FROM (SELECT event_id, CASE event_id % 4 WHEN 0 THEN flags || ' , ' WHEN 1 THEN ', ' || flags ELSE flags END AS t FROM flagged)"""))
def parsed_row_flags(spark, sf_dir):
    """Flag texts with stray blanks and commas, parsed to lists."""
    fourth = F.col("event_id") % 4
    rows = flagged(spark, sf_dir).with_columns(flags=(
        F.when(fourth == 0, F.concat("flags", F.lit(" , ")))
        .when(fourth == 1, F.concat(F.lit(", "), F.col("flags"))).otherwise(F.col("flags"))))
    return flags.row_flag_list(rows).rows().select(
        "event_id", F.array_join("flag_list", "|").alias("flag_list"))


@query("sequence_flag_sets", sql(FLAGS, """
SELECT session_id, Touchdata_id, coalesce(array_to_string(list_sort(list_distinct(flatten(list(string_split(flags, ','))
         FILTER (flags <> '')))), '|'), '') AS flag_set, bool_or(flags <> '') AS has_flags
FROM flagged GROUP BY session_id, Touchdata_id"""))
def sequence_flag_sets(spark, sf_dir):
    sets = flags.sequence_flag_sets(flagged(spark, sf_dir))
    return sets.withColumn("flag_set", F.array_join("flag_set", "|"))
