"""Queries over whole session documents: unknown fields, headers, metadata, and their way through files and back."""

from __future__ import annotations

from pyspark.sql import functions as F

from fingertrail.checks.catalog import query
from fingertrail.checks.sql import TOUCH, sql
from fingertrail.session import scratch_path
from fingertrail.sources import sinks, variants
from fingertrail.sources.touch_view import touch_view

TYPED = ["x", "y", "time", "touchPhase", "fingerId", "color", "zone", "completionPerc"]


def odd_touches(spark, sf_dir):
    """Touch events of which some have fields that no schema names, and quality columns."""
    k = F.col("event_id")
    return touch_view(spark, sf_dir).with_columns(
        pressure=F.when(k % 3 == 0, k % 1000 / 8), note=F.when(k % 7 == 0, F.concat(F.lit('"n" '), k.cast("string"))),
        still=F.when(k % 5 == 0, k % 2 == 0), mixed=F.when(k % 11 == 0, F.when(k % 2 == 0, k.cast("string")).otherwise("odd")),
        tags=F.when(k % 13 == 0, F.array(F.lit("a"), (k % 4).cast("string"))),
        quality_tier=F.when(k % 4 == 0, "low").when(k % 4 == 1, "high").otherwise("medium"),
        behavioral_pattern=F.when(k % 9 < 2, "steady").when(k % 9 < 5, "fast"),
        anomaly_type=F.when(k % 50 == 0, "outlier").otherwise("normal"))


def odd_headers(rows):
    """A header per session with fields that no schema names."""
    session = F.col("session_id").cast("string")
    text = F.concat(F.lit('{"device":{"id":'), session, F.lit(',"tilt":[1,2.5]},"message":"m'), session, F.lit('"}'))
    inner = F.concat(F.lit('{"dataSet":"Coloring","maxTapCount":'), session, F.lit(',"room":"r'), session, F.lit('"}'))
    kind = variants.EXTRA
    return rows.select("session_id").distinct().select(
        "session_id", F.variant_get(F.parse_json(text), "$", kind).alias("header"), F.variant_get(F.parse_json(inner), "$", kind).alias("json_header"))


def odd_documents(spark, sf_dir, document_events=400):
    touches = odd_touches(spark, sf_dir)
    rows = touches.rows()
    columns = [*TYPED, "event_id", "pressure", "note", "still", "mixed", "tags", "quality_tier", "behavioral_pattern", "anomaly_type"]
    built = sinks.enhanced_documents(rows, columns, odd_headers(rows), document_events=document_events, part_events=60,
                                     hot_rows=touches.hot_rows, at_most=touches.at_most)
    return built.select(F.concat_ws("/", "session_id", "document_no").alias("session_id"), "document", "document_no")


_SESSION = "CAST(session_id AS BIGINT) AS session_id"
_NOTE = "'\"n\" ' || event_id"


@query("json_unknown_fields", sql(TOUCH, f"""
SELECT {_SESSION}, CAST(Touchdata_id AS BIGINT) AS Touchdata_id, event_index, x, touchPhase, CAST(event_id AS BIGINT) AS event_id,
       CASE WHEN event_id % 3 = 0 THEN (event_id % 1000) / 8.0::DOUBLE END AS pressure, CASE WHEN event_id % 7 = 0 THEN {_NOTE} END AS note,
       CASE WHEN event_id % 5 = 0 THEN event_id % 2 = 0 END AS still,
       CASE WHEN event_id % 13 = 0 THEN '["a","' || event_id % 4 || '"]' END AS tags
FROM touch"""))
def json_unknown_fields(spark, sf_dir):
    """Fields that the schema does not know, written into documents, scanned and widened to typed columns."""
    parsed = variants.parse_documents(odd_documents(spark, sf_dir))
    wide = variants.widen(variants.flatten_documents(parsed))
    return wide.select(F.split("session_id", "/")[0].cast("bigint").alias("session_id"), F.col("Touchdata_id").cast("bigint"), "event_index", "x",
                       "touchPhase", "event_id", F.col("pressure").cast("double"), "note", "still", "tags")


@query("json_field_catalog", sql(TOUCH, """
SELECT unnest(['event_id', 'pressure', 'note', 'still', 'mixed', 'tags', 'quality_tier', 'behavioral_pattern', 'anomaly_type']) AS name,
  unnest([count(*), count(*) FILTER (event_id % 3 = 0), count(*) FILTER (event_id % 7 = 0), count(*) FILTER (event_id % 5 = 0),
          count(*) FILTER (event_id % 11 = 0), count(*) FILTER (event_id % 13 = 0), count(*), count(*) FILTER (event_id % 9 < 5), count(*)]) AS events
FROM touch"""))
def json_field_catalog(spark, sf_dir):
    """The unknown fields of all documents, by one combinable aggregate."""
    return variants.unknown_fields(variants.flatten_documents(variants.parse_documents(odd_documents(spark, sf_dir)))).select("name", "events")


@query("json_headers", sql(TOUCH, """
SELECT DISTINCT CAST(session_id AS BIGINT) AS session_id, 'm' || session_id AS message, CAST(session_id AS BIGINT) AS device, 'r' || session_id AS room,
  CAST(session_id AS BIGINT) AS tap_count, 'Coloring' AS data_set
FROM touch"""))
def json_headers(spark, sf_dir):
    """What stood around the touches is there again after re-assembly, in every document of a session."""
    headers = variants.document_headers(variants.parse_documents(odd_documents(spark, sf_dir)))
    top, inner = F.col("header"), F.col("json_header")
    return headers.select(
        F.split("session_id", "/")[0].cast("bigint").alias("session_id"), F.variant_get(top["message"], "$", "string").alias("message"),
        F.variant_get(top["device"], "$.id", "bigint").alias("device"), F.variant_get(inner["room"], "$", "string").alias("room"),
        F.variant_get(inner["maxTapCount"], "$", "bigint").alias("tap_count"), F.variant_get(inner["dataSet"], "$", "string").alias("data_set")).distinct()


@query("enhanced_document_metadata", sql(TOUCH, """
SELECT CAST(session_id AS BIGINT) AS session_id, count(DISTINCT Touchdata_id) AS total_sequences, count(*) AS total_touch_points,
  count(*) FILTER (event_id % 4 = 1) AS high, count(*) FILTER (event_id % 4 > 1) AS medium, count(*) FILTER (event_id % 4 = 0) AS low,
  count(*) FILTER (event_id % 50 = 0) AS anomaly_count, count(*) FILTER (event_id % 9 < 2) AS steady,
  count(*) FILTER (event_id % 9 BETWEEN 2 AND 4) AS fast, count(*) AS events_in_text
FROM touch GROUP BY session_id"""))
def enhanced_document_metadata(spark, sf_dir):
    """Enhanced documents written as JSON lines and read back: their metadata, and the events that they hold."""
    path = scratch_path(spark, "enhanced")
    sinks.write_documents(odd_documents(spark, sf_dir), path)
    lines = spark.read.schema("session_id string, document_no bigint, document string").json(path)
    parsed = variants.parse_documents(lines)
    report = variants.document_report(parsed).select("session_id", "events")
    meta = F.from_json(F.to_json(F.variant_get("document", "$.ml_metadata", "variant")), """
        total_sequences bigint, total_touch_points bigint, quality_distribution struct<high bigint, medium bigint, low bigint>,
        anomaly_count bigint, behavioral_patterns map<string, bigint>""")
    rows = parsed.select("session_id", meta.alias("m")).join(report, "session_id").withColumn("session_id", F.split("session_id", "/")[0].cast("bigint"))
    return rows.groupBy(
        "session_id", "m.total_sequences", "m.total_touch_points", "m.quality_distribution.high", "m.quality_distribution.medium",
        "m.quality_distribution.low", "m.anomaly_count", F.coalesce(F.col("m.behavioral_patterns")["steady"], F.lit(0)).alias("steady"),
        F.coalesce(F.col("m.behavioral_patterns")["fast"], F.lit(0)).alias("fast")).agg(F.sum("events").cast("bigint").alias("events_in_text"))
