"""Folder jobs: scan many sessions at once, process each by its recording type, and report their status."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fingertrail.operators import detect, reports
from fingertrail.operators.groups import Touches, split_sessions
from fingertrail.plans import cleaning
from fingertrail.session import store
from fingertrail.sources import documents, sinks, tables, variants


TOUCH_IDS = ["Touchdata_id", "event_index"]


def by_layout(events: DataFrame, types: DataFrame) -> dict[tuple[str, bool], Touches]:
    """The sessions of each known type, those with touch ids apart from those without, which lose the empty
    columns; sessions of unknown type and empty groups are left out.

    A united table has the columns of all its files, so what a session has is decided by its values. The routed
    rows are stored once, since each path reads them several times.
    """
    ids = F.max(F.col("Touchdata_id").isNotNull()) if "Touchdata_id" in events.columns else F.lit(False)
    layouts = types.join(events.groupBy("session_id").agg(ids.alias("has_ids")), "session_id")
    routed = store(events.join(layouts.filter("data_type <> 'Unknown'").select("session_id", "data_type", "has_ids"), "session_id"))
    sizes = routed.groupBy("data_type", "has_ids").count().collect()  # at most four rows
    return {(r.data_type, r.has_ids): split_sessions(
        routed.filter((F.col("data_type") == r.data_type) & (F.col("has_ids") == r.has_ids))
        .drop("data_type", "has_ids", *([] if r.has_ids else TOUCH_IDS)), at_most=r["count"]) for r in sizes}


def process_documents(parsed: DataFrame, name: F.Column | None = None) -> tuple[dict[str, Touches], DataFrame]:
    """Flag the events of all usable documents by their type; report every document's status.

    A broken document costs only its own session: it is reported and left out. ``name`` is the text that may name
    a session's type, its id by default. Sessions of unknown type are reported with no flagged rows.
    """
    events = documents.flatten_documents(parsed)
    types = store(detect.detect_data_type(events, name))
    flag = {"Coloring": cleaning.flag_coloring, "Tracing": cleaning.flag_tracing}
    rows = {kind: flag[kind](part) for (kind, _), part in by_layout(events, types).items()}  # documents always have ids
    counts = [reports.count_flagged_rows(part.rows()) for part in rows.values()]
    none = types.limit(0).select("session_id", F.lit(0).cast("long").alias("total_rows"), F.lit(0).cast("long").alias("flagged_rows"))
    counts = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), counts, none)
    report = documents.document_report(parsed).groupBy("session_id").agg(
        F.max_by("status", F.col("status") == "ok").alias("status"), F.sum("events").alias("events"))
    status = (report.join(types.select("session_id", "data_type"), "session_id", "left").join(counts, "session_id", "left")
              .select("session_id", "status", "data_type", "events",
                      F.coalesce("flagged_rows", F.lit(0)).alias("flagged_rows")))
    return rows, status


def process_events(events: DataFrame, target: str, anomalies: str = "forest") -> DataFrame:
    """Flag and label sessions by their type, write results and reports below ``target``, return the summary.

    Each type goes its own way and is written in its own order: Coloring with its metrics, Tracing without; the usual layouts
    (Coloring with touch ids, Tracing without) are in ``coloring`` and ``tracing``, the others in ``coloring_legacy`` and
    ``tracing_touches``. The labelled rows are stored once and
    serve both the export and the summary.
    """
    types = store(detect.detect_data_type(events))
    summary = None
    for (kind, has_ids), part in sorted(by_layout(events, types).items()):
        folder = f"{target}/" + {("Coloring", True): "coloring", ("Coloring", False): "coloring_legacy",
                                 ("Tracing", False): "tracing", ("Tracing", True): "tracing_touches"}[kind, has_ids]
        if kind == "Coloring":
            labelled, metrics = cleaning.process_coloring(part, anomalies)
            rows = store(labelled.rows())
            sinks.write_flagged(rows, metrics, folder)
        else:
            rows = store(cleaning.process_tracing(part)[0].rows())
            sinks.write_tracing(rows, folder)
        own = reports.corpus_summary(rows, F.lit(kind))
        summary = own if summary is None else summary.unionByName(own, allowMissingColumns=True)
    sinks.write_report(detect.detection_statistics(types), f"{target}/detection")
    if summary is None:
        return types.limit(0).select(F.col("session_id").alias("filename"), "data_type")
    summary = store(summary)
    sinks.write_report(summary, f"{target}/summary")
    return summary


def process_csv_folder(spark: SparkSession, source: str, target: str, anomalies: str = "forest",
                       session_column: str | None = None) -> DataFrame:
    """Flag and label all CSV sessions of a folder, whatever their headers; see ``process_events``."""
    raw = tables.read_event_csv(spark, source, session_column=session_column)
    for column, kind in (("distance", "double"), ("camFrame", "bigint"), ("isDragging", "boolean"), ("color", "string"),
                         ("completionPerc", "double"), ("Touchdata_id", "bigint"), ("event_index", "bigint"), ("zone", "string")):
        if column not in raw.columns:  # no file of the folder has it
            raw = raw.withColumn(column, F.lit(None).cast(kind))
    return process_events(raw, target, anomalies)


def process_document_folder(spark: SparkSession, source: str, target: str, anomalies: str = "forest") -> DataFrame:
    """The same for a folder of JSON session documents, one session per file."""
    parsed = documents.read_session_documents(spark, source)
    return process_events(documents.flatten_documents(parsed), target, anomalies)


def enhance_document_folder(spark: SparkSession, source: str, target: str, full: bool = False, per_session: bool = False) -> DataFrame:
    """Clean the Coloring documents of a folder and write them again, enhanced, below ``target``; return a row per file.

    Documents keep their header and all fields of their events, known or not, and gain the computed columns and
    ``ml_metadata``. ``full`` takes the path with all features in place of the simple one. A file that is no JSON, has no
    touches, or is of another type costs only itself: its status says why it has no document.
    """
    parsed = variants.parse_documents(variants.read_documents(spark, source))
    events = store(variants.flatten_documents(parsed))
    types = store(detect.detect_data_type(events))
    coloring = events.join(types.filter("data_type = 'Coloring'").select("session_id"), "session_id")
    touches = split_sessions(coloring)
    cleaned = cleaning.clean_and_enhance(touches) if full else cleaning.clean_simple(touches)
    rows = store(cleaned.rows())
    columns = [c for c in rows.columns if c not in ("session_id", "extra")]
    built = store(sinks.enhanced_documents(rows, columns, variants.document_headers(parsed)))
    sinks.write_documents(built, f"{target}/documents", per_session)
    counts = built.groupBy("session_id").agg(F.count(F.lit(1)).alias("documents"), F.sum("n_events").alias("events"))
    report = variants.document_report(parsed).select("session_id", F.col("status").alias("read"))
    status = report.join(types.select("session_id", "data_type"), "session_id", "left").join(counts, "session_id", "left").select(
        "session_id", F.when(F.col("read") != "ok", F.col("read")).when(F.col("documents").isNull(), "not_coloring").otherwise("success").alias("status"),
        "data_type", F.coalesce("documents", F.lit(0)).alias("documents"), F.coalesce("events", F.lit(0)).alias("events"))
    sinks.write_report(status, f"{target}/processing_summary")
    return status
