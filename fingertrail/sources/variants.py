"""Session documents read whole: known event fields typed, everything else carried along as VARIANT.

A document that a session's schema does not foresee loses nothing here. Each event keeps its unknown fields in a map
``extra`` of name to VARIANT, and each document keeps what stands around its touches as a header. The names and types
of unknown fields are found by one combinable aggregate, by which an export can be widened to real columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fingertrail.schema import EVENT_FIELDS

#: Event fields that are columns of their own; all others are unknown.
KNOWN = [name for name, _ in EVENT_FIELDS] + ["Touchdata_id", "event_index"]
EXTRA = "map<string, variant>"
#: Unknown names that an export may be widened by; a table with more keeps them in ``extra``.
MOST_FIELDS = 1_000


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """All ``*.json`` files of a folder, each a session: session_id and its text, read once."""
    files = spark.read.text(path, wholetext=True, pathGlobFilter="*.json")
    return files.select(F.regexp_replace(F.col("_metadata.file_name"), r"\.json$", "").alias("session_id"),
                        F.col("value").alias("document"))


def parse_documents(lines: DataFrame, text: str = "document") -> DataFrame:
    """session_id, document (VARIANT or null), status and the document's touches.

    The status tells apart texts that are no JSON, documents without touches, and those read. Of a repeated key the
    last one counts if ``spark.sql.variant.allowDuplicateKeys`` is set, as ``build_session`` does.
    """
    parsed = lines.select("session_id", F.try_parse_json(F.col(text)).alias("document"))
    touches = parsed.withColumn("touches", F.try_variant_get("document", "$.json.touchData", "map<string, array<variant>>"))
    status = (F.when(F.col("document").isNull(), "invalid_json").when(F.coalesce(F.size("touches"), F.lit(0)) <= 0, "no_touch_data").otherwise("ok"))
    return touches.withColumn("status", status)


def document_report(documents: DataFrame) -> DataFrame:
    """Status, touches and events of every document."""
    usable = F.col("status") == "ok"
    events = F.aggregate(F.map_values("touches"), F.lit(0), lambda n, e: n + F.coalesce(F.size(e), F.lit(0)))
    return documents.select("session_id", "status", F.when(usable, F.size("touches")).otherwise(0).alias("touches"),
                            F.when(usable, events).otherwise(0).alias("events"))


def flatten_documents(documents: DataFrame, keep_own_ids: bool = False) -> DataFrame:
    """One row per event of the usable documents: the known fields, and ``extra`` with all others.

    The touch's key names the touch and stands in for a missing fingerId; a continued touch counts on from its part
    offset. With ``keep_own_ids`` an event's own Touchdata_id and event_index win. A value of the wrong kind in a known
    field is null. An entry that is no object has no fields.
    """
    offsets = F.try_variant_get("document", "$.json.partOffset", "map<string, bigint>")
    touches = documents.filter(F.col("status") == "ok").select("session_id", offsets.alias("_offsets"), F.explode("touches").alias("_key", "_events"))
    start = F.coalesce(F.element_at("_offsets", F.col("_key")), F.lit(0))
    events = touches.select("session_id", "_key", start.alias("_start"), F.posexplode("_events").alias("_pos", "_e"))
    events = events.withColumn("_fields", F.try_variant_get("_e", "$", EXTRA))

    def own(name: str, kind: str) -> Column:
        return F.try_variant_get(F.element_at("_fields", name), "$", kind)

    touch, index = F.col("_key"), F.col("_start") + F.col("_pos").cast("long")
    if keep_own_ids:
        touch, index = F.coalesce(own("Touchdata_id", "string"), touch), F.coalesce(own("event_index", "bigint"), index)
    fields = {name: own(name, kind.simpleString()) for name, kind in EVENT_FIELDS}
    fields["fingerId"] = F.coalesce(fields["fingerId"], F.col("_key"))
    extra = F.map_filter("_fields", lambda name, _: ~name.isin(KNOWN))
    return events.select("session_id", touch.alias("Touchdata_id"), index.alias("event_index"),
                         *[column.alias(name) for name, column in fields.items()], F.coalesce(extra, F.create_map().cast(EXTRA)).alias("extra"))


def document_headers(documents: DataFrame) -> DataFrame:
    """What stands around the touches of each usable document: ``header`` beside ``json``, ``json_header`` inside it."""
    top = F.try_variant_get("document", "$", EXTRA)
    inner = F.try_variant_get("document", "$.json", EXTRA)
    return documents.filter(F.col("status") == "ok").select(
        "session_id", F.map_filter(top, lambda name, _: ~name.isin("json", "ml_metadata")).alias("header"),
        F.map_filter(inner, lambda name, _: ~name.isin("touchData", "partOffset")).alias("json_header"))


def unknown_fields(events: DataFrame) -> DataFrame:
    """name, kind and number of events of every unknown field; kinds of all events merge in one combinable aggregate."""
    entries = events.select(F.explode("extra").alias("name", "value"))
    return entries.groupBy("name").agg(F.schema_of_variant_agg("value").alias("kind"), F.count(F.lit(1)).alias("events"))


def _column_kind(kind: str) -> str:
    """The type of a column that holds all values of a merged kind; what has no common type stays JSON text."""
    if kind.startswith("DECIMAL"):
        return "double"
    return kind if kind in ("BIGINT", "DOUBLE", "FLOAT", "BOOLEAN", "STRING", "DATE") else "string"


def widen(events: DataFrame) -> DataFrame:
    """Events with a column for each unknown field, in place of ``extra``.

    Numbers, booleans and texts have their own type, arrays, objects and mixed kinds are JSON text. A name that differs
    from another column only by case gets underscores. Tables with more than MOST_FIELDS unknown names are left as they are.
    """
    fields = unknown_fields(events).orderBy("name").limit(MOST_FIELDS + 1).collect()
    if len(fields) > MOST_FIELDS:
        return events
    taken = {c.lower() for c in events.columns} - {"extra"}
    columns = []
    for field in fields:
        name = field["name"]
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        value, kind = F.element_at("extra", F.lit(field["name"])), _column_kind(field["kind"])
        typed = F.try_variant_get(value, "$", kind) if kind != "string" or field["kind"] == "STRING" else F.to_json(value)
        columns.append(typed.alias(name))
    return events.select(*[c for c in events.columns if c != "extra"], *columns)
