"""Packing by power-of-two decomposition.

A document's token ids, closed by an end id, are cut into pieces whose lengths are powers of two: as many of
the full length as fit, then the binary digits of the rest, largest first. A sequence is one piece, so none
crosses documents and none needs padding; pieces of one length form a bucket, from which batches of one shape
are drawn. Cutting is a per-document function, so the job has no shuffle at all.
"""

from __future__ import annotations

import base64
import json
import zlib
from functools import lru_cache

import numpy as np
import public_tokenizers
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fingertrail.llm.catalog import query
from fingertrail.llm.common import fresh, per_text, quoted, table

MAX_TOKENS = 2048
END_ID = 1
#: The ranks file holds the vocabulary of byte_bpe_50k.json and gives the same ids several times faster.
VOCABULARY = "byte_bpe_50k.tiktoken"
#: Its added tokens are single ids wherever they stand in a text, as the tokenizers library has it by default.
TOKENIZER = "byte_bpe_50k.json"

PIECE = [T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
         T.StructField("ids_crc32", T.LongType())]
IDS = T.StructField("ids", T.ArrayType(T.IntegerType()))


def added_tokens(tokenizer: str | None) -> tuple[tuple[str, int], ...]:
    """The added tokens that a tokenizer file lists, with their ids; none without such a file."""
    if not tokenizer:
        return ()
    with open(tokenizer, encoding="utf-8") as text:
        return tuple((t["content"], t["id"]) for t in json.load(text)["added_tokens"])


@lru_cache(maxsize=2)
def encoding(path: str, added: tuple[tuple[str, int], ...]) -> tiktoken.Encoding:
    """The ranks of a vocabulary, with added tokens. Workers read no tokenizer file, whose parsed tree would be their peak."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=dict(added))


def piece_lengths(n: int, most: int = MAX_TOKENS) -> list[int]:
    """Lengths of the pieces of n tokens: full ones, then the powers of two that add up to the rest."""
    rest = n % most
    return [most] * (n // most) + [1 << k for k in range(rest.bit_length() - 1, -1, -1) if rest >> k & 1]


def pack(docs: DataFrame, text: str = "text", *, max_tokens: int = MAX_TOKENS, end_id: int = END_ID,
         vocabulary: str | None = None, tokenizer: str | None = None, keep_ids: bool = True) -> DataFrame:
    """One row per piece: the columns of docs except the text, then start, length, ids_crc32, ids (if kept),
    doc_tokens, sequence_id and offset, with underscores where docs has a column of that name.

    `max_tokens` is a power of two. A null or empty text packs its end id alone. Repeated rows are packed
    each, whatever their ids. Added tokens of the `tokenizer` file are single ids; an own vocabulary without such a file has
    none. sequence_id is unique but has gaps; the bucket of a sequence is its length.
    """
    if max_tokens & (max_tokens - 1):
        raise ValueError("max_tokens is a power of two")
    path = vocabulary or public_tokenizers.path(VOCABULARY)
    added = added_tokens(tokenizer or (None if vocabulary else public_tokenizers.path(TOKENIZER)))

    def cut(texts: list[str]) -> list[dict]:
        encode = encoding(path, added).encode
        out = []
        for value in texts:
            ids = np.array([*encode(value, allowed_special="all"), end_id], dtype="<u4")
            pieces, start = [], 0
            for length in piece_lengths(len(ids), max_tokens):
                part = ids[start:start + length]
                piece = {"start": start, "length": length, "ids_crc32": zlib.crc32(part.tobytes())}
                pieces.append(piece | {"ids": part.astype("i4")} if keep_ids else piece)
                start += length
            out.append({"doc_tokens": len(ids), "pieces": pieces})
        return out

    piece = T.StructType([*PIECE, IDS] if keep_ids else PIECE)
    packed = per_text(cut, T.StructType([T.StructField("doc_tokens", T.LongType()),
                                         T.StructField("pieces", T.ArrayType(piece))]))
    kept = [c for c in docs.columns if c != text]
    names = {name: fresh(name, kept) for name in [*piece.names, "doc_tokens", "sequence_id", "offset"]}
    whole, one = fresh("_packed", kept), fresh("_piece", kept)
    rows = docs.select(*quoted(kept), packed(F.col(text)).alias(whole))
    rows = rows.select(*quoted(kept), F.col(f"{whole}.doc_tokens").alias(names["doc_tokens"]), F.explode(f"{whole}.pieces").alias(one))
    return rows.select(*quoted(kept), *[F.col(f"{one}.{c}").alias(names[c]) for c in piece.names], names["doc_tokens"],
                       F.monotonically_increasing_id().alias(names["sequence_id"]), F.lit(0).cast("long").alias(names["offset"]))


def write_buckets(pieces: DataFrame, path: str) -> None:
    """Write sequences into one folder per length, so that a reader takes batches of one shape."""
    pieces.withColumn("bucket", F.col("length")).write.mode("overwrite").partitionBy("bucket").parquet(path)


@query("op10_packing")
def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pack(docs, keep_ids=False)
