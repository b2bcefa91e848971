"""Event files of any headers in one pass: the task that reads a file takes its header and puts the columns in place.

Lines are read as text, so large files are split and small ones share tasks. A task parses the lines of each file under
the file's own header into one fixed row: the known event columns, and a map of all others. No file is opened twice, no
plan grows with the number of headers, and no list of files is put together. Only where files are large enough to be
split, lines of a later split have no header in their task; these are stored as they are and meet the header by a join.
"""

from __future__ import annotations

import csv
import io
from collections.abc import Iterator
from urllib.parse import unquote

import pyarrow as pa
import pyarrow.csv as pa_csv
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fingertrail.schema import EVENT_FIELDS
from fingertrail.session import store

#: Columns of the fixed row; a file's other columns are in ``extra``.
KNOWN = [name for name, _ in EVENT_FIELDS] + ["Touchdata_id", "event_index", "event_id", "seqId", "flags"]
#: Headers of so many split files may be broadcast to their lines; more are joined by a shuffle.
MOST_FILES = 100_000
#: Different column names that a folder may have.
MOST_NAMES = 10_000

_KIND = pa.schema([("_file", pa.string()), *[(name, pa.string()) for name in KNOWN], ("extra", pa.map_(pa.string(), pa.string())),
                   ("_names", pa.list_(pa.string())), ("_line", pa.string())])
_DDL = ", ".join(["_file string", *[f"{name} string" for name in KNOWN], "extra map<string, string>", "_names array<string>", "_line string"])


def _filled(size: int, **columns: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([columns[f.name] if f.name in columns else pa.nulls(size, f.type) for f in _KIND], schema=_KIND)


def header_names(line: str) -> list[str]:
    """Column names of a header line; a byte order mark is left out."""
    return next(csv.reader([line.removeprefix("\ufeff")]), [])


def parse_lines(lines: list[str], names: list[str], file: str) -> pa.RecordBatch:
    """Lines under a header. Missing values are null, surplus ones are left out; of repeated names the first counts."""
    width = len(names)
    odd: dict[int, list[str | None]] = {}

    def wrong(row: pa_csv.InvalidRow) -> str:
        values: list[str | None] = next(csv.reader([row.text]), [])
        odd[len(odd)] = [(v or None) for v in values[:width]] + [None] * (width - len(values))
        return "skip"

    keys = [str(k) for k in range(width)]
    table = pa_csv.read_csv(
        io.BytesIO("\n".join(lines).encode("utf-8", "replace")),
        read_options=pa_csv.ReadOptions(column_names=keys, use_threads=False, block_size=1 << 26),
        parse_options=pa_csv.ParseOptions(escape_char="\\", double_quote=True, invalid_row_handler=wrong),
        convert_options=pa_csv.ConvertOptions(column_types={k: pa.string() for k in keys}, null_values=[""], strings_can_be_null=True,
                                              quoted_strings_can_be_null=False))
    columns = [c.combine_chunks() for c in table.columns]
    if odd:
        columns = [pa.concat_arrays([c, pa.array([row[k] for row in odd.values()], pa.string())]) for k, c in enumerate(columns)]
    size = len(columns[0]) if columns else 0
    place: dict[str, pa.Array] = {}
    for name, column in zip(names, columns):
        place.setdefault(name, column)
    out = {name: column for name, column in place.items() if name in KNOWN}
    others = {name: column.to_pylist() for name, column in place.items() if name not in KNOWN and name.strip()}
    if others:
        rows = [[(name, values[k]) for name, values in others.items() if values[k] is not None] for k in range(size)]
        out["extra"] = pa.array(rows, pa.map_(pa.string(), pa.string()))
    return _filled(size, _file=pa.array([file] * size, pa.string()), **out)


def _scan(comment: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, names = None, None
        for batch in batches:
            values, files, starts = (batch.column(k).to_pylist() for k in range(3))
            at = 0
            while at < len(values):
                end = at + 1
                while end < len(values) and files[end] == files[at] and starts[end] == starts[at]:
                    end += 1
                if files[at] != file:
                    file, names = files[at], None
                lines = [v for v in values[at:end] if v and not (comment and v.startswith(comment))]
                if names is None and starts[at] == 0 and lines:
                    names = header_names(lines.pop(0))
                    yield _filled(1, _file=pa.array([file]), _names=pa.array([names], pa.list_(pa.string())))
                if lines and names is None:
                    yield _filled(len(lines), _file=pa.array([file] * len(lines)), _line=pa.array(lines, pa.string()))
                elif lines and names:
                    yield parse_lines(lines, names, file)
                at = end
    return run


def _late(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines of later splits, each with its file and the names of the file's header."""
    for batch in batches:
        by_file: dict[str, tuple[list[str], list[str]]] = {}
        for file, line, names in zip(*(batch.column(k).to_pylist() for k in range(3))):
            by_file.setdefault(file, (names, []))[1].append(line)
        for file, (names, lines) in by_file.items():
            if names:
                yield parse_lines(lines, names, file)


def _may_be_split(spark: SparkSession, path: str, file_glob: str) -> bool:
    """Whether any file is larger than the smallest split that Spark may choose; only sizes are read."""
    lengths = spark.read.format("binaryFile").option("pathGlobFilter", file_glob).load(path).agg(F.max("length")).first()[0] or 0
    sizes = [spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(name))
             for name in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")]
    return lengths > min(sizes)


def scan_lines(spark: SparkSession, path: str, comment: str | None = None, file_glob: str = "*.csv") -> DataFrame:
    """The fixed rows of all files, as text, and besides a row for each file with the names of its header in ``_names``."""
    lines = spark.read.text(path, pathGlobFilter=file_glob).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))
    rows = lines.mapInArrow(_scan(comment), _DDL)
    if not _may_be_split(spark, path, file_glob):
        return rows.drop("_line")
    rows = store(rows)
    headers = rows.filter("_names is not null").select("_file", "_names")
    headers = F.broadcast(headers) if headers.count() <= MOST_FILES else headers
    late = rows.filter("_line is not null").select("_file", "_line").join(headers, "_file").select("_file", "_line", "_names").mapInArrow(_late, _DDL)
    return rows.filter("_line is null").unionByName(late).drop("_line")


def session_name(path: str) -> str:
    return unquote(path.rsplit("/", 1)[-1]).removesuffix(".csv")


def with_session(rows: DataFrame, session_column: str | None) -> DataFrame:
    """session_id from the file's name, or from a column."""
    if session_column is None:
        name = F.regexp_replace(F.element_at(F.split("_file", "/"), -1), r"\+", "%2B")
        session = F.regexp_replace(F.url_decode(name), r"\.csv$", "")
    else:
        session = F.col(session_column) if session_column in KNOWN else F.element_at("extra", session_column)
    return rows.withColumn("session_id", session)


def column_names(rows: DataFrame) -> list[str]:
    """All names of all headers, in alphabetical order; more than MOST_NAMES are refused, as no table has so many columns."""
    names = rows.filter("_names is not null").select(F.explode("_names").alias("name")).distinct().orderBy("name").limit(MOST_NAMES + 1).collect()
    if len(names) > MOST_NAMES:
        raise ValueError(f"the files have more than {MOST_NAMES} different column names")
    return [r["name"] for r in names if r["name"].strip()]
