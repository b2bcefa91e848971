"""Writers, the positional paste of two tables, and re-assembly of JSON session documents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fingertrail.operators.groups import Position, RunningSum, Touches, split_sessions
from fingertrail.operators.projections import coloring_output, subset_rules, tracing_output

PART_EVENTS = 10_000       # events of one touch held in one array
DOCUMENT_EVENTS = 100_000  # events of one session document
FILE_ROWS = 5_000_000      # rows of one exported file


def flat_events(df: DataFrame) -> DataFrame:
    """Sorted column names, so files of different sessions agree on the order."""
    return df.select(*sorted(c for c in df.columns if c != "session_id"), "session_id")


def write_events(df: DataFrame, path: str, fmt: str = "parquet", per_session: bool = False) -> None:
    """Flat event export, rows by session and time inside each file.

    Rows are laid out by ranges of (session, time) of equal size, so files hold about ``FILE_ROWS`` rows whatever
    the sizes of sessions, and file statistics let readers find a session. ``per_session`` makes one
    folder per session instead, for a small number of sessions.
    """
    ordered = flat_events(df).repartitionByRange("session_id", "time").sortWithinPartitions("session_id", "time")
    writer = ordered.write.mode("errorifexists").option("header", True).option("maxRecordsPerFile", FILE_ROWS).format(fmt)
    (writer.partitionBy("session_id") if per_session else writer).save(path)


def write_event_table(df: DataFrame, name: str, buckets: int) -> None:
    """Events as a table of the session's catalogue in so many buckets of whole sessions, each bucket in order.

    Jobs by session over such a table (``tables.read_event_table``) start without an exchange, however often they run.
    """
    flat_events(df).repartition(buckets, "session_id").write.mode("errorifexists").format("parquet").bucketBy(buckets, "session_id").sortBy(
        "session_id", "fingerId", "time").saveAsTable(name)


def write_flagged(events: DataFrame, metrics: DataFrame, path: str, fmt: str = "csv") -> None:
    """Flagged export of Coloring data: events and metrics as two tables."""
    coloring_output(events, "Coloring").write.option("header", True).format(fmt).save(f"{path}/events")
    metrics.drop("hasCanceled").write.option("header", True).format(fmt).save(f"{path}/metrics")


def write_tracing(events: DataFrame, path: str, fmt: str = "csv") -> None:
    """Export of labelled Tracing data: one table, no sequence numbers, no metrics."""
    tracing_output(events).write.option("header", True).format(fmt).save(f"{path}/events")


def write_report(df: DataFrame, path: str, fmt: str = "csv") -> None:
    """Summary, contradiction and consistency reports: one row per session or per finding."""
    df.write.option("header", True).format(fmt).save(path)


def paste_side_by_side(events: Touches, metrics: DataFrame, order: Sequence[str] = ("Touchdata_id", "event_index"),
                       pad: str = "     ") -> DataFrame:
    """Metrics beside events, matched by position in the session; surplus metric rows are cut off,
    as the pasted file has as many rows as the session has events."""
    left = events.arrange(["session_id"], list(order)).running(_pos=Position()).rows()
    kept = [c for c in coloring_output(left, "Coloring").columns if c != "session_id"]
    right = (split_sessions(metrics.drop("hasCanceled"), events.hot_rows, events.at_most)
             .arrange(["session_id"], ["fingerId", "seqId"]).running(_pos=Position()).rows())
    names = [c for c in right.columns if c not in ("session_id", "_pos")]
    right = right.select(F.col("session_id"), F.col("_pos"), *[F.col(c).alias(pad + c) for c in names])
    joined = left.join(right, ["session_id", "_pos"], "left")
    return joined.select("session_id", "_pos", *kept, F.lit("").alias(pad),
                         *[F.col(f"`{pad}{c}`") for c in names])


def touch_parts(df: DataFrame, columns: Sequence[str], part_events: int = PART_EVENTS,
                extra: dict | None = None) -> DataFrame:
    """(session, touch, part) with the ordered events of the part as an array of structs.

    A part holds at most ``part_events`` events, so no array grows with the size of a touch.
    """
    keyed = df.filter(F.col("Touchdata_id").isNotNull()).withColumn(
        "part", F.floor(F.col("event_index") / part_events).cast("long"))
    grouped = keyed.groupBy("session_id", "Touchdata_id", "part").agg(
        F.count(F.lit(1)).alias("n_events"), F.min("event_index").alias("first_index"),
        F.array_sort(F.collect_list(F.struct("event_index", F.struct(*columns).alias("e")))).alias("_events"),
        *[column.alias(name) for name, column in (extra or {}).items()])
    return grouped.withColumn("events", F.transform("_events", lambda e: e["e"])).drop("_events")


def touch_documents(df: DataFrame, columns: Sequence[str], part_events: int = PART_EVENTS) -> DataFrame:
    """One JSON document per touch part, in the shape of a session document; nulls are left out.

    A later part names its first event_index as ``partOffset`` of the touch, so indexes go on when read.
    """
    parts = touch_parts(df, columns, part_events)
    touch = F.col("Touchdata_id").cast("string")
    body = F.create_map(touch, F.col("events"))
    offset = F.when(F.col("first_index") > 0, F.create_map(touch, F.col("first_index")))
    document = F.to_json(F.struct(F.struct(body.alias("touchData"), offset.alias("partOffset")).alias("json")))
    return parts.select("session_id", "Touchdata_id", "part", "n_events", document.alias("document"))


def session_documents(df: DataFrame, columns: Sequence[str], document_events: int = DOCUMENT_EVENTS,
                      part_events: int = PART_EVENTS, hot_rows: int | None = None,
                      at_most: int | None = None) -> DataFrame:
    """Session documents with all touches of the session.

    A session above ``document_events`` events continues in further documents (``document_no``), so a
    document stays bounded and nothing is cut. A touch that goes on in a further document has its first
    event_index there as ``partOffset``.
    """
    parts = touch_parts(df, columns, part_events)
    placed = (split_sessions(parts, hot_rows, at_most).arrange(["session_id"], ["Touchdata_id", "part"])
              .running(_upto=RunningSum(F.col("n_events"))).rows())
    placed = placed.withColumn(
        "document_no", F.floor((F.col("_upto") - F.col("n_events")) / document_events).cast("long"))
    # a touch with several parts in one document gets one entry again
    per_touch = placed.groupBy("session_id", "document_no", "Touchdata_id").agg(
        F.sum("n_events").alias("n_events"), F.min("first_index").alias("first_index"),
        F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("part", "events"))),
                              lambda p: p["events"])).alias("events"))
    touch = F.col("Touchdata_id").cast("string")
    entries = F.collect_list(F.struct(touch, "events"))
    offsets = F.collect_list(F.when(F.col("first_index") > 0, F.struct(touch, "first_index")))
    return (per_touch.groupBy("session_id", "document_no")
            .agg(F.sum("n_events").alias("n_events"), F.count(F.lit(1)).alias("touches"),
                 F.map_from_entries(entries).alias("touchData"),
                 F.when(F.size(offsets) > 0, F.map_from_entries(offsets)).alias("partOffset"))
            .select("session_id", "document_no", "n_events", "touches",
                    F.to_json(F.struct(F.struct("touchData", "partOffset").alias("json"))).alias("document")))


def ml_metadata(df: DataFrame) -> DataFrame:
    """Per session the summary that an enhanced document carries, as ``ml_metadata`` (JSON text).

    Distinct touches (events without one count as one), events, events by quality tier, outliers, and events by
    behavioural pattern, as far as the columns are there. Counts of (session, touch) and (session, pattern) combine
    before they are put together, so a large session is counted in many tasks.
    """
    tiers = {name: F.count_if(F.col("quality_tier") == name) if "quality_tier" in df.columns else F.lit(0)
             for name in ("high", "medium", "low")}
    outliers = F.count_if(F.col("anomaly_type") == "outlier") if "anomaly_type" in df.columns else F.lit(0)
    touches = df.groupBy("session_id", "Touchdata_id").agg(
        F.count(F.lit(1)).alias("n"), outliers.cast("long").alias("outliers"), *[c.cast("long").alias(name) for name, c in tiers.items()])
    totals = touches.groupBy("session_id").agg(
        F.count(F.lit(1)).alias("total_sequences"), F.sum("n").alias("total_touch_points"),
        F.struct(*[F.sum(name).alias(name) for name in tiers]).alias("quality_distribution"), F.sum("outliers").alias("anomaly_count"))
    patterns = F.create_map().cast("map<string, bigint>")
    if "behavioral_pattern" in df.columns:
        counts = df.filter(F.col("behavioral_pattern").isNotNull()).groupBy("session_id", "behavioral_pattern").agg(F.count(F.lit(1)).alias("n"))
        named = counts.groupBy("session_id").agg(F.map_from_entries(F.collect_list(F.struct("behavioral_pattern", "n"))).alias("_patterns"))
        totals, patterns = totals.join(named, "session_id", "left"), F.coalesce("_patterns", patterns)
    return totals.select("session_id", F.to_json(F.struct(
        "total_sequences", "total_touch_points", "quality_distribution", "anomaly_count", patterns.alias("behavioral_patterns"))).alias("ml_metadata"))


def _members(text: F.Column) -> F.Column:
    """The members of a JSON object's text, without its braces."""
    return F.substring(text, F.lit(2), F.length(text) - 2)


def _object(*members: F.Column) -> F.Column:
    """An object's text from texts of members; null or empty ones are left out."""
    kept = F.filter(F.array(*members), lambda m: F.coalesce(m, F.lit("")) != "")
    return F.concat(F.lit("{"), F.array_join(kept, ","), F.lit("}"))


def _quoted(text: F.Column) -> F.Column:
    return _members(F.to_json(F.array(text)))


def enhanced_documents(df: DataFrame, columns: Sequence[str], headers: DataFrame | None = None, metadata: bool = True,
                       document_events: int = DOCUMENT_EVENTS, part_events: int = PART_EVENTS,
                       hot_rows: int | None = None, at_most: int | None = None) -> DataFrame:
    """Session documents rebuilt around their original header: session_id, document_no, n_events, touches, document.

    Events hold the given columns, arrays as arrays, and what ``extra`` holds besides (an original field of a
    computed column's name is replaced); nulls and NaN are left out. ``headers`` (session_id, header, json_header) go
    back to where they stood, and the session's ``ml_metadata`` is added. A session above ``document_events`` events
    continues in further documents, each with header and metadata; a touch that goes on names its first event_index
    there as ``partOffset``.
    """
    def plain(name: str) -> F.Column:
        column = F.col(f"`{name}`")
        return (F.when(~F.isnan(column), column) if df.schema[name].dataType.typeName() in ("double", "float") else column).alias(name)

    entry = F.to_json(F.struct(*[plain(c) for c in columns]))
    if "extra" in df.columns:
        left = F.to_json(F.map_filter("extra", lambda name, value: ~name.isin(list(columns)) & value.isNotNull()))
        entry = _object(_members(entry), _members(left))
    parts = touch_parts(df.withColumn("_entry", entry), ["_entry"], part_events)
    parts = parts.withColumn("events", F.array_join(F.transform("events", lambda e: e["_entry"]), ","))
    placed = (split_sessions(parts, hot_rows, at_most).arrange(["session_id"], ["Touchdata_id", "part"])
              .running(_upto=RunningSum(F.col("n_events"))).rows())
    placed = placed.withColumn("document_no", F.floor((F.col("_upto") - F.col("n_events")) / document_events).cast("long"))
    per_touch = placed.groupBy("session_id", "document_no", "Touchdata_id").agg(
        F.sum("n_events").alias("n_events"), F.min("first_index").alias("first_index"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part", "events"))), lambda p: p["events"]), ",").alias("events"))
    key = _quoted(F.col("Touchdata_id").cast("string"))
    body = F.concat(key, F.lit(":["), F.col("events"), F.lit("]"))
    offset = F.when(F.col("first_index") > 0, F.concat(key, F.lit(":"), F.col("first_index").cast("string")))
    documents = per_touch.groupBy("session_id", "document_no").agg(
        F.sum("n_events").alias("n_events"), F.count(F.lit(1)).alias("touches"),
        F.array_join(F.array_sort(F.collect_list(body)), ",").alias("_touches"), F.array_join(F.array_sort(F.collect_list(offset)), ",").alias("_offsets"))
    top = inner = summary = F.lit(None).cast("string")
    if headers is not None:
        once = headers.dropDuplicates(["session_id"])
        documents = documents.join(once, "session_id", "left")
        top, inner = _members(F.to_json("header")), _members(F.to_json("json_header"))
    if metadata:
        documents = documents.join(ml_metadata(df), "session_id", "left")
        summary = F.concat(F.lit('"ml_metadata":'), F.col("ml_metadata"))
    offsets = F.when(F.col("_offsets") != "", F.concat(F.lit('"partOffset":{'), F.col("_offsets"), F.lit("}")))
    session = _object(inner, F.concat(F.lit('"touchData":{'), F.col("_touches"), F.lit("}")), offsets)
    return documents.select("session_id", "document_no", "n_events", "touches",
                            _object(top, F.concat(F.lit('"json":'), session), summary).alias("document"))


def write_documents(documents: DataFrame, path: str, per_session: bool = False) -> None:
    """Documents as JSON lines of session_id, document_no and the document itself; a reader parses the inner text.

    ``per_session`` writes each document as a text file of its own below its session's folder, for a small number of
    sessions: ``session_id=.../document_no=.../``.
    """
    if per_session:
        documents.select("session_id", "document_no", "document").write.partitionBy("session_id", "document_no").text(path)
    else:
        documents.select("session_id", "document_no", "document").write.json(path)


def write_subsets(df: DataFrame, path: str, fmt: str = "parquet") -> DataFrame:
    """Write the non-empty named subsets (saved forms), and return how much each one kept.

    One pass counts all subsets first; empty ones are not written.
    """
    from fingertrail.operators.projections import subset_retention
    retention = subset_retention(df, saved=True).collect()  # four rows
    for row in retention:
        if row.points:
            df.filter(subset_rules(saved=True)[row.subset]).write.format(fmt).save(f"{path}/{row.subset}")
    return df.sparkSession.createDataFrame(retention)
