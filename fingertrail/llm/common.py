"""Helpers shared by the operators: tables, per-text Arrow functions, the split of documents by their id."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

#: Characters of text that a per-text function handles at once; longer texts come alone, and whole.
SLICE_CHARS = 2_000_000
#: Texts of a batch that are Python strings at one time.
SLICE_TEXTS = 512


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def slices(texts: list[str | None], limit: int = SLICE_CHARS) -> Iterator[list[str]]:
    """Lists of whole texts of about `limit` characters together; null becomes empty."""
    part, size = [], 0
    for text in texts:
        text = text or ""
        if part and size + len(text) > limit:
            yield part
            part, size = [], 0
        part.append(text)
        size += len(text)
    if part:
        yield part


def text_slices(texts: pa.Array, limit: int = SLICE_CHARS) -> Iterator[list[str]]:
    """`slices` of an Arrow column, of which only some texts are converted at a time."""
    for at in range(0, len(texts), SLICE_TEXTS):
        yield from slices(texts.slice(at, SLICE_TEXTS).to_pylist(), limit)


@contextmanager
def small_batches(spark: SparkSession, rows: int = 1_000) -> Iterator[None]:
    """Jobs started inside send texts to Python in batches of so many rows, which bounds what both sides hold."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def release() -> None:
    """Give freed memory back to the system: workers stay, and what they hold counts. C libraries without a trim keep theirs."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def per_text(fn: Callable[[list[str]], list], result: T.DataType, limit: int = SLICE_CHARS) -> Callable[[Column], Column]:
    """An Arrow function of a text column: `fn` maps a list of texts to a list of results."""
    kind = to_arrow_type(result)

    def run(texts: pa.Array) -> pa.Array:
        out: list[pa.Array] = [pa.array([], kind)]
        for part in text_slices(texts, limit):
            out.append(pa.array(fn(part), kind))
        joined = pa.concat_arrays(out)
        del out
        release()
        return joined

    run.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    return F.arrow_udf(run, result)


def id_remainder(doc_id: Column, mod: int) -> Column:
    """crc32 of the id as text, modulo `mod`; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % F.lit(mod)


def ascii_lower(text: Column) -> Column:
    upper = "".join(map(chr, range(65, 91)))
    return F.translate(text, upper, upper.lower())


def quoted(names: list[str]) -> list[Column]:
    """Columns by their plain names, whatever characters these have."""
    return [F.col("`" + name.replace("`", "``") + "`") for name in names]


def fresh(name: str, taken: list[str]) -> str:
    """The name, with underscores added until no column has it in any case."""
    low = {t.lower() for t in taken}
    while name.lower() in low:
        name += "_"
    return name
