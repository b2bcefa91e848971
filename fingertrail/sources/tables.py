"""CSV scans: event files, files with a comment preamble, and two-table exports."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fingertrail.operators.groups import Touches, split_sessions
from fingertrail.session import store
from fingertrail.sources import csv_scan

# Column types of known event and result columns; anything else is read as text.
_DOUBLES = {"x", "y", "time", "accx", "accy", "accz", "completionPerc", "distance", "startTime",
            "endTime", "durationSec", "totalDistance", "ml_quality_score", "temporal_consistency",
            "spatial_consistency", "velocity", "time_diff", "anomaly_score"}
_LONGS = {"event_id", "Touchdata_id", "event_index", "camFrame", "seqId", "nPoints", "quality_score"}
_BOOLEANS = {"isDragging"}


def _typed(df: DataFrame) -> DataFrame:
    """Cast known columns; a value of the wrong kind becomes null instead of failing the job."""
    columns = []
    for name in df.columns:
        column = F.col(f"`{name}`")
        if name in _DOUBLES:
            column = column.try_cast("double")
        elif name in _LONGS:
            column = column.try_cast("double").cast("bigint") if name == "quality_score" else column.try_cast("bigint")
        elif name in _BOOLEANS:
            column = column.try_cast("boolean")
        columns.append(column.alias(name))
    return df.select(*columns)


def _file_name() -> F.Column:
    return F.regexp_replace(F.url_decode(F.regexp_replace(F.col("_metadata.file_name"), r"\+", "%2B")),
                            r"\.csv$", "")


def read_event_csv(spark: SparkSession, path: str, columns: list[str] | None = None,
                   comment: str | None = None, header: bool = True, file_glob: str = "*.csv",
                   session_column: str | None = None) -> DataFrame:
    """Event rows of all matching files of a folder; each file is a session, or a column names it.

    Each file is read by its own header, in one pass over all files whose rows are stored (see ``csv_scan``), and has
    the columns of all headers; names that differ by case only are one column. With ``columns`` all files have these.
    Rows are not sorted here; every ordered operation states its own order.
    """
    def read(names: list[str], files: str | list[str]) -> DataFrame:
        schema = T.StructType([T.StructField(name, T.StringType()) for name in names])
        reader = (spark.read.schema(schema).option("header", header).option("enforceSchema", True)
                  .option("pathGlobFilter", file_glob).option("mode", "PERMISSIVE"))
        if comment:
            reader = reader.option("comment", comment)
        session = _file_name() if session_column is None else F.col(session_column)
        return _typed(reader.csv(files).withColumn("session_id", session))

    if columns:
        return read(columns, path)
    rows = store(csv_scan.scan_lines(spark, path, comment, file_glob))
    names: dict[str, list[str]] = {}
    for name in csv_scan.column_names(rows):
        names.setdefault(name.lower(), []).append(name)
    values = [F.coalesce(*[F.col(n) if n in csv_scan.KNOWN else F.element_at("extra", n) for n in same]).alias(same[0])
              for same in names.values() if same[0].lower() != "session_id"]
    own = csv_scan.with_session(rows.filter("_names is null"), session_column)
    if not values:
        values = [F.lit(None).cast("string").alias("touchPhase")]
    return _typed(own.select(*values, "session_id"))


def scan_event_csv(spark: SparkSession, path: str, comment: str | None = None, file_glob: str = "*.csv",
                   session_column: str | None = None) -> DataFrame:
    """The same lazily and with fixed columns: session_id, the known event columns, and ``extra`` with all others as text."""
    rows = csv_scan.with_session(csv_scan.scan_lines(spark, path, comment, file_glob).filter("_names is null"), session_column)
    return _typed(rows.select("session_id", *csv_scan.KNOWN, "extra"))


def read_event_table(spark: SparkSession, name: str, hot_rows: int | None = None) -> Touches:
    """Events of a table in buckets of sessions, ready for jobs by session: the buckets take the place of the exchange.

    Sessions too large for one task are still set apart and laid out in chunks.
    """
    touches = split_sessions(spark.table(name), hot_rows)
    return replace(touches, clustered=touches.hot is None)


def read_commented_csv(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """CSV whose first lines are ``#`` comments."""
    return read_event_csv(spark, path, columns, comment="#")


def split_two_tables(df: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """Events left of the blank-named column, sequence metrics right of it.

    The metric columns lose their padding and become typed; all-null metric rows (the metrics table
    is shorter than the events table) are dropped. Flags become lists, a missing text an empty one.
    """
    blank = [i for i, name in enumerate(df.columns) if name.strip() == ""]

    def listed(table: DataFrame) -> DataFrame:
        if "flags" not in table.columns:
            return table
        text = F.col("flags")
        parts = F.when(F.coalesce(text, F.lit("")) == "", F.array().cast("array<string>")).otherwise(
            F.split(text, ","))
        return table.withColumn("flags", parts)

    if not blank:
        return listed(_typed(df)), None
    at = blank[0]
    left = [c for c in df.columns[:at] if c != "session_id"]
    right = [c for c in df.columns[at + 1:] if c != "session_id"]
    tail = ["session_id"] if "session_id" in df.columns else []
    events = df.select(*[F.col(f"`{c}`") for c in [*left, *tail]])
    metrics = df.select(*[F.col(f"`{c}`").alias(c.strip()) for c in right], *tail)
    metrics = metrics.dropna(how="all", subset=[c.strip() for c in right])
    return listed(_typed(events)), listed(_typed(metrics))


def union_files(tables: list[DataFrame]) -> DataFrame:
    """Concatenate tables with different columns."""
    result = tables[0]
    for table in tables[1:]:
        result = result.unionByName(table, allowMissingColumns=True)
    return result


def file_statistics(df: DataFrame, file_column: str = "session_id") -> DataFrame:
    """Per file: points, distinct touches, mean quality. Distinct touches are formed before the
    per-file count, so a large file is combined in many tasks first."""
    touches = (df.groupBy(file_column, "Touchdata_id")
               .agg(F.count(F.lit(1)).alias("_n"), F.sum("ml_quality_score").alias("_q"),
                    F.count("ml_quality_score").alias("_nq")))
    return touches.groupBy(file_column).agg(
        F.sum("_n").alias("points"), F.count("Touchdata_id").alias("sequences"),
        F.try_divide(F.sum("_q"), F.sum("_nq")).alias("quality_avg"))
