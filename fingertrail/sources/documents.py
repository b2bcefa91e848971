"""Nested JSON session documents: one file or one text per session, flattened to event rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fingertrail.schema import EVENT_FIELDS, SESSION_DOCUMENT

EVENT_COLUMNS = ["session_id", "Touchdata_id", "event_index", *[name for name, _ in EVENT_FIELDS]]


def _explode_touches(documents: DataFrame, keep_own_ids: bool) -> DataFrame:
    """(session_id, json) -> one row per event.

    The key of the map names the touch and stands in for a missing fingerId; a continued touch counts on from
    its part offset. With ``keep_own_ids``
    an event's own Touchdata_id and event_index win over the key and the position.
    """
    touches = documents.select("session_id", F.col("json.partOffset").alias("_offsets"),
                               F.explode("json.touchData").alias("_key", "_events"))
    start = F.coalesce(F.element_at("_offsets", F.col("_key")), F.lit(0))
    events = touches.select("session_id", "_key", start.alias("_start"), F.posexplode("_events").alias("_pos", "_e"))
    touch, index = F.col("_key"), F.col("_start") + F.col("_pos").cast("long")
    if keep_own_ids:
        touch = F.coalesce(F.col("_e.Touchdata_id"), touch)
        index = F.coalesce(F.col("_e.event_index"), index)
    fields = [F.col(f"_e.{name}").alias(name) if name != "fingerId"
              else F.coalesce(F.col("_e.fingerId"), F.col("_key")).alias("fingerId")
              for name, _ in EVENT_FIELDS]
    return events.select("session_id", touch.alias("Touchdata_id"), index.alias("event_index"), *fields)


def _usable() -> Column:
    return F.col("_corrupt_record").isNull() & (F.size(F.col("json.touchData")) > 0)


def read_session_documents(spark: SparkSession, path: str) -> DataFrame:
    """Raw documents of all ``*.json`` files of a folder; each file is one session."""
    return (spark.read.schema(SESSION_DOCUMENT)
            .option("multiLine", True).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", "_corrupt_record")
            .option("pathGlobFilter", "*.json").json(path)
            .withColumn("session_id", F.regexp_replace(F.col("_metadata.file_name"), r"\.json$", "")))


def flatten_documents(documents: DataFrame, keep_own_ids: bool = False) -> DataFrame:
    """Event rows of the usable documents; the others are left out (see ``document_report``)."""
    return _explode_touches(documents.filter(_usable()), keep_own_ids)


def document_report(documents: DataFrame) -> DataFrame:
    """Status of every document: read, without touch data, or not valid JSON."""
    status = (F.when(F.col("_corrupt_record").isNotNull(), "invalid_json")
              .when(F.coalesce(F.size(F.col("json.touchData")), F.lit(-1)) <= 0, "no_touch_data")
              .otherwise("ok"))
    events = F.aggregate(
        F.map_values(F.col("json.touchData")), F.lit(0), lambda acc, e: acc + F.size(e))
    return documents.select(
        "session_id", status.alias("status"),
        F.when(status == "ok", F.size(F.map_keys("json.touchData"))).otherwise(0).alias("touches"),
        F.when(status == "ok", events).otherwise(0).alias("events"))


def parse_document_lines(lines: DataFrame, text: str = "document") -> DataFrame:
    """Documents held one per row as text (session_id, text): the form for many small sessions,
    as splittable JSON lines or a Parquet column scan far better than one file per session."""
    parsed = F.from_json(F.col(text), SESSION_DOCUMENT, {"mode": "PERMISSIVE",
                                                         "columnNameOfCorruptRecord": "_corrupt_record"})
    return lines.select("session_id", parsed.alias("_d")).select("session_id", "_d.*")
