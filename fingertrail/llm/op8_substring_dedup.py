"""Substring deduplication by sliding sentence spans.

A text is cut into sentences, also at clauses. Stretches of up to ten words are cut after eight; in longer ones
each six neighbouring gaps give up the one whose two words have the smallest hash, so that cuts depend on the words
around them alone, and a passage of 50 words or more holds a whole run that is the same wherever it stands. From every
sentence starts a run: as many consecutive sentences as are needed for 30 words. Runs are hashed and joined over all documents; a run
whose first document is another one, or that stands earlier in the same text, is a repeat, and all sentences that
a repeat covers are removed. Runs of a text are computed once and stored. Only hashes and ids are shuffled until the
texts are joined with their own repeats: all runs once, with a combined count, then only those that a bitmap of fixed size says may be repeated.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from fingertrail.llm.catalog import query
from fingertrail.llm.common import fresh, per_text, quoted, table
from fingertrail.session import store

#: Words in a run, and the most words of a sentence before it is cut.
RUN_WORDS, LONGEST = 30, 8
#: Stretches of more words than FIXED are cut at the smallest hash of each GAPS neighbouring gaps, others after LONGEST words.
#: A passage of 4 * GAPS + 26 words has its whole run in it; FIXED must stay below 22 less the first run's latest start.
FIXED, GAPS = 10, 6
#: Bits of the broadcast filter of repeated runs (16 MB); the more runs repeat, the less it spares.
FILTER_BITS = 1 << 27
# Classes of characters: 1 space or tab, 2 other white space, 4 a mark that ends a piece; places in a word have odd factors.
_CLASS = np.zeros(129, np.uint8)
_CLASS[[9, 32]], _CLASS[10:14], _CLASS[[ord(c) for c in ".!?,;:"]] = 1, 2, 4
_PLACES = np.random.default_rng(8).integers(0, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def gap_keys(codes: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """A hash of the two words around each gap, from the codes of their letters."""
    size = last - first + 1
    ends = np.cumsum(size)
    at = np.arange(ends[-1]) - np.repeat(ends - size, size)
    letters = (codes[np.repeat(first, size) + at].astype(np.uint64) + np.uint64(1)) * _PLACES[at & 63]
    own = np.add.reduceat(letters, ends - size)
    keys = own[:-1] * _PLACES[0] + own[1:] * _PLACES[1]
    return (keys ^ keys >> np.uint64(31)) * _PLACES[2]


def sentences(text: str) -> list[str]:
    """Pieces that together are the text; white space before the first word belongs to the first piece."""
    low = text.replace("\u0130", "i").lower()  # the one letter whose lower case is longer
    codes = np.frombuffer(low.encode(), np.uint8) if low.isascii() else np.frombuffer(low.encode("utf-32-le", "surrogatepass"), np.uint32)
    kind = _CLASS[np.minimum(codes, 128)]
    word = kind & 3 == 0
    first = np.flatnonzero(word & np.r_[True, ~word[:-1]])
    if not len(first):
        return []
    last = np.flatnonzero(word & np.r_[~word[1:], True])
    n = len(first)
    cut = kind[last] == 4
    ended = np.searchsorted(first, np.flatnonzero(kind == 2)) - 1
    cut[ended[ended >= 0]] = True
    cut[-1] = True
    begins = np.r_[0, np.flatnonzero(cut)[:-1] + 1]
    sizes = np.diff(np.r_[begins, n])
    cut[begins[(sizes > LONGEST) & (sizes <= FIXED)] + LONGEST - 1] = True
    if sizes.max() > FIXED:
        stretch = np.repeat(np.where(sizes > FIXED, np.arange(len(sizes)), -1), sizes)
        keys = gap_keys(codes, first, last)
        windows = n - GAPS
        least, place = keys[GAPS - 1:], np.full(windows, GAPS - 1)
        for k in range(GAPS - 2, -1, -1):
            less = keys[k:k + windows] < least
            least, place = np.where(less, keys[k:k + windows], least), np.where(less, k, place)
        whole = np.flatnonzero((stretch[:-GAPS] >= 0) & (stretch[:-GAPS] == stretch[GAPS:]))
        cut[whole + place[whole]] = True
    starts = [0, *first[np.flatnonzero(cut[:-1]) + 1].tolist(), len(text)]
    return [text[a:b] for a, b in zip(starts, starts[1:])]


def runs(parts: list[str], run_words: int = RUN_WORDS) -> list[tuple[int, int, int]]:
    """Hash, first sentence and sentence after the end of each run, upper and lower case and white space folded."""
    words = [p.lower().split() for p in parts]
    ends = np.cumsum([len(w) for w in words])
    if not len(ends) or ends[-1] < run_words:
        return []
    before = np.r_[0, ends[:-1]]
    after = np.searchsorted(ends, before + run_words) + 1
    own = np.array([xxhash.xxh3_64_intdigest(" ".join(w)) for w in words], dtype="<u8").tobytes()
    return [(xxhash.xxh3_64_intdigest(own[8 * i:8 * j]) - (1 << 63), i, j)
            for i, j in enumerate(after.tolist()) if j <= len(parts)]


def repeats_within(found: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Spans of runs that stand earlier in the same text, without touching that earlier place."""
    first: dict[int, int] = {}
    out = []
    for h, i, j in found:
        if i >= first.setdefault(h, j):
            out.append((i, j))
    return out


def without(text: str, foreign: list[int] | None, run_words: int = RUN_WORDS) -> dict:
    """The text without repeats: runs in `foreign`, and those that it holds twice itself."""
    parts = sentences(text)
    found = runs(parts, run_words)
    gone = np.zeros(len(parts), bool)
    others = set(foreign or ())
    for i, j in [*repeats_within(found), *((i, j) for h, i, j in found if h in others)]:
        gone[i:j] = True
    kept = "".join(p for p, g in zip(parts, gone) if not g) if gone.any() else text
    return {"text": kept, "n_removed": int(gone.sum())}


FACTS = T.StructType([T.StructField("n_sentences", T.LongType()), T.StructField("twice", T.BooleanType()),
                      T.StructField("runs", T.ArrayType(T.LongType()))])


def facts_of(text: str, run_words: int) -> dict:
    """Number of sentences, whether the text repeats a run of its own, and its different runs."""
    parts = sentences(text)
    found = runs(parts, run_words)
    return {"n_sentences": len(parts), "twice": bool(repeats_within(found)), "runs": list({h for h, _, _ in found})}


def run_filter(repeated: DataFrame) -> np.ndarray:
    """A bitmap of FILTER_BITS bits with those of all repeated runs: of fixed size, whatever their number."""
    at = F.pmod("run", F.lit(FILTER_BITS))
    rows = repeated.groupBy(F.bitmap_bucket_number(at).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bits")).collect()  # FILTER_BITS / 32768 rows of 4 KB at most
    bits = np.zeros(FILTER_BITS // 8 + 8192, np.uint8)
    for r in rows:  # bucket 0 holds the number 0 alone, at its first bit
        start = r["bucket"] * 4096
        bits[start:start + len(r["bits"])] |= np.frombuffer(bytes(r["bits"]), np.uint8)
    return bits


def in_filter(bits: np.ndarray, found: np.ndarray) -> np.ndarray:
    """Which runs may be repeated ones; the arithmetic is that of the bitmap functions."""
    at = found % FILTER_BITS
    bucket, place = np.where(at > 0, 1 + (at - 1) // 32768, 0), np.where(at > 0, (at - 1) % 32768, 0)
    return bits[bucket * 4096 + place // 8] >> (place % 8).astype(np.uint8) & 1 > 0


def deduplicate(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", run_words: int = RUN_WORDS) -> DataFrame:
    """docs with the repeats taken out of their text, and with n_sentences and n_removed (underscores follow if docs has such columns).

    The first document of a run is the one with the smallest id; rows of one id count as one document, and rows
    without an id come last, as one. A text of fewer than `run_words` words is left as it is; a null text stays null.
    Texts are cut once for their runs, and once more only where something is to be taken out.
    """
    names = list(docs.columns)
    order, key, foreign, twice, clean, many, gone = (fresh(n, names) for n in ("_order", "_text", "_foreign", "_twice", "_clean", "n_sentences", "n_removed"))
    place = F.coalesce(F.col(doc_id).cast("long"), F.lit(2**63 - 1))
    facts = per_text(lambda texts: [facts_of(t, run_words) for t in texts], FACTS)
    known = store(docs.select(place.alias("order"), F.xxhash64(text).alias("key"), facts(F.col(text)).alias("f")).select("order", "key", "f.*"))
    first = (known.select("order", F.explode("runs").alias("run")).groupBy("run")
             .agg(F.min("order").alias("first"), F.max("order").alias("last")).filter("last > first").select("run", "first"))
    first = store(first)
    bits = known.sparkSession.sparkContext.broadcast(run_filter(first))

    def likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            found = lists.flatten().to_numpy(zero_copy_only=False)
            owner = pc.list_parent_indices(lists).to_numpy(zero_copy_only=False)
            keep = in_filter(bits.value, found)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(owner[keep])), batch.column(1).take(pa.array(owner[keep])),
                                              pa.array(found[keep])], names=["order", "key", "run"])

    spans = known.select("order", "key", "runs").mapInArrow(likely, "order long, key long, run long")
    others = (spans.join(first, "run").filter(F.col("order") > F.col("first"))
              .groupBy("order", "key").agg(F.collect_set("run").alias("foreign")))  # runs of one text
    own = known.select("order", "key", "n_sentences", "twice").dropDuplicates(["order", "key"]).join(others, ["order", "key"], "left").select(
        F.col("order").alias(order), F.col("key").alias(key), F.col("n_sentences").alias(many), F.col("twice").alias(twice), F.col("foreign").alias(foreign))
    joined = docs.withColumns({order: place, key: F.xxhash64(text)}).join(own, [order, key])
    changed = F.col(twice) | F.col(foreign).isNotNull()
    cleaned = joined.withColumn(clean, _clean_udf(run_words)(F.when(changed, F.col(text)), F.col(foreign)))
    value = F.when(changed, F.col(f"{clean}.text")).otherwise(F.col(text)).alias(text)
    return cleaned.select(*[value if c == text else column for c, column in zip(names, quoted(names))], many,
                          F.coalesce(F.col(f"{clean}.n_removed"), F.lit(0).cast("long")).alias(gone))


def _clean_udf(run_words: int):
    kind = T.StructType([T.StructField("text", T.StringType()), T.StructField("n_removed", T.LongType())])
    arrow = to_arrow_type(kind)

    def run(texts: pa.Array, foreign: pa.Array) -> pa.Array:
        return pa.array([None if t is None else without(t, f, run_words) for t, f in zip(texts.to_pylist(), foreign.to_pylist())], arrow)

    run.__annotations__ = {"texts": pa.Array, "foreign": pa.Array, "return": pa.Array}
    return F.arrow_udf(run, kind)


@query("op8_substring_dedup")
def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return deduplicate(docs)
