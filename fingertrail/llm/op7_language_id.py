"""Language identification with hyperdimensional profiles.

Each letter has a random vector of signs. A trigram binds its letters' vectors, rotated by their place, into
one; a document bundles the vectors of all its trigrams, a language bundles those of its training documents.
The language whose prototype has the largest cosine with the document wins.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fingertrail.llm.catalog import query
from fingertrail.llm.common import fresh, id_remainder, per_text, slices, table

DIMENSIONS = 1024
UNKNOWN = "und"
#: Languages that profiles may be learned for; a column with more values is no language column and is refused.
MOST_LANGUAGES = 1_000
#: Cells of a counting table that may be laid out whole, and pairs of text and trigram that are bound at once beyond that.
CUBE, BLOCK = 1 << 24, 1 << 13

# For the characters of the basic plane: the lower-case letter, or 0 where the character is no letter. Others use str.
_LETTER = np.zeros(1 << 16, np.uint32)
for _c in range(1 << 16):
    if chr(_c).isalpha():
        _low = chr(_c).lower()
        _LETTER[_c] = ord(_low) if len(_low) == 1 else _c


def letter_vectors(letters: np.ndarray, dimensions: int = DIMENSIONS) -> np.ndarray:
    """Random signs drawn from the letter's own code, the same everywhere; 0 stands for the gap between words."""
    return np.stack([np.random.default_rng(int(c) + 7).choice(np.float32([-1, 1]), dimensions) for c in letters])


def tallies(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The distinct trigrams of some texts as rows of three letters; then, for each pair that occurs, the text, the trigram and the count.

    Runs of other characters count as one gap. Texts start and end with a gap; those without letters have none.
    """
    codes = np.frombuffer("\0".join(["", *texts, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    letters = _LETTER[np.minimum(codes, 0xFFFF)]
    for at in np.flatnonzero(codes > 0xFFFF):
        low = chr(codes[at]).lower()
        letters[at] = ord(low) if low.isalpha() and len(low) == 1 else 0
    ends = np.cumsum([1, *(len(t) + 1 for t in texts)])
    doc = np.repeat(np.arange(len(texts) + 1), np.diff([0, *ends]))[:len(letters)] - 1
    keep = (letters > 0) | (np.r_[np.uint32(1), letters[:-1]] > 0)
    letters, doc = letters[keep], doc[keep]
    present, small = np.unique(letters, return_inverse=True)
    size = len(present)
    inner = letters[1:-1] > 0
    code = ((small[:-2] * size + small[1:-1]) * size + small[2:])[inner]
    owner = doc[1:-1][inner]
    if not len(code):
        return np.zeros((0, 3), np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.float32)
    if size ** 3 <= max(CUBE, 4 * len(code)):
        used = np.flatnonzero(np.bincount(code, minlength=1))
        table = np.zeros(used[-1] + 1, np.int64)
        table[used] = np.arange(len(used))
        place = table[code]
    else:
        used, place = np.unique(code, return_inverse=True)
    grams = present[np.stack([used // (size * size), used // size % size, used % size], axis=1)]
    pair = owner * len(used) + place
    if len(texts) * len(used) <= max(CUBE, 4 * len(code)):
        counts = np.bincount(pair, minlength=1)
        pair = np.flatnonzero(counts)
        counts = counts[pair]
    else:
        pair, counts = np.unique(pair, return_counts=True)
    own, place = np.divmod(pair, len(used))
    return grams, own, place, counts.astype(np.float32)


def trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The distinct trigrams of a few texts, and how often each text has each, as a whole table."""
    grams, own, place, counts = tallies(texts)
    table = np.zeros((len(texts), len(grams)), np.float32)
    table[own, place] = counts
    return grams, table


def gram_vectors(grams: np.ndarray, dimensions: int = DIMENSIONS) -> np.ndarray:
    """The bound vector of each trigram."""
    if not len(grams):
        return np.zeros((0, dimensions), np.float32)
    letters, at = np.unique(grams, return_inverse=True)
    v, at = letter_vectors(letters, dimensions), at.reshape(-1, 3)
    return np.roll(v, 2, axis=1)[at[:, 0]] * np.roll(v, 1, axis=1)[at[:, 1]] * v[at[:, 2]]


class Letters:
    """The letters' vectors of many trigrams, from which blocks of these are bound."""

    def __init__(self, grams: np.ndarray, dimensions: int):
        letters, at = np.unique(grams, return_inverse=True)
        own = letter_vectors(letters, dimensions).astype(np.int8) if len(letters) else np.zeros((0, dimensions), np.int8)
        self.turned, self.at = [np.roll(own, k, axis=1) for k in (2, 1, 0)], at.reshape(-1, 3)

    def bound(self, which) -> np.ndarray:
        at = self.at[which]
        return (self.turned[0][at[:, 0]] * self.turned[1][at[:, 1]] * self.turned[2][at[:, 2]]).astype(np.float32)


def bundles(texts: list[str], dimensions: int = DIMENSIONS) -> np.ndarray:
    """The sum of each text's trigram vectors, in blocks of bounded size."""
    grams, own, place, counts = tallies(texts)
    out = np.zeros((len(texts), dimensions), np.float32)
    if len(texts) * len(grams) <= CUBE and len(grams) <= 2 * CUBE // dimensions:
        table = np.zeros((len(texts), len(grams)), np.float32)
        table[own, place] = counts
        return table @ gram_vectors(grams, dimensions)
    letters = Letters(grams, dimensions)
    for k in range(0, len(own), BLOCK):
        block = own[k:k + BLOCK]
        rows = letters.bound(place[k:k + BLOCK]) * counts[k:k + BLOCK, None]
        starts = np.flatnonzero(np.r_[True, block[1:] != block[:-1]])
        out[block[starts]] += np.add.reduceat(rows, starts, axis=0)
    return out


@dataclass
class Profiles:
    languages: list[str]
    unit: np.ndarray  # one row of length 1 per language
    dimensions: int = DIMENSIONS

    def predict(self, texts: list[str]) -> list[dict]:
        vectors = bundles(texts, self.dimensions)
        size = np.sqrt((vectors * vectors).sum(1))
        some = [any(map(str.isalpha, t)) for t in texts]
        if not self.languages:
            return [{"lang_pred": UNKNOWN, "score": 0.0} for _ in texts]
        cosine = vectors @ self.unit.T / np.maximum(size, 1e-9)[:, None]
        best = cosine.argmax(1)
        value = np.clip(cosine[np.arange(len(texts)), best], 0, 1)
        return [{"lang_pred": self.languages[b] if s else UNKNOWN, "score": float(x) if s else 0.0}
                for b, x, s in zip(best, value, some)]


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", dimensions: int = DIMENSIONS) -> Profiles:
    """Prototypes from all rows of docs with a language.

    A task bundles the documents it reads into one vector per language; Spark adds these by language and
    dimension. Every document weighs the same. The driver gets one vector per language.
    """
    rows = docs.filter(F.col(lang).isNotNull()).select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"))

    def bundle(batches):
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            languages, at = batch.column("lang").to_pylist(), 0
            for part in slices(batch.column("text").to_pylist()):
                grams, owner, place, counts = tallies(part)
                share = counts / np.maximum(np.bincount(owner, counts, len(part)), 1)[owner]
                names, own = np.unique(np.array(languages[at:at + len(part)]), return_inverse=True)
                at += len(part)
                order = np.argsort(place, kind="stable")
                owner, place, share = owner[order], place[order], share[order]
                width = max(1, min(BLOCK, CUBE // len(names)))
                vectors, letters = np.zeros((len(names), dimensions)), Letters(grams, dimensions)
                for j in range(0, len(grams), width):
                    x, y = np.searchsorted(place, [j, j + width])
                    weight = np.bincount(own[owner[x:y]] * width + place[x:y] - j, share[x:y], len(names) * width)
                    block = slice(j, j + width)
                    bound = letters.bound(block)
                    vectors += weight.reshape(len(names), width)[:, :len(bound)].astype(np.float32) @ bound
                for name, vector in zip(names.tolist(), vectors):
                    total[name] = total.get(name, 0) + vector
        for name, vector in total.items():
            yield pa.RecordBatch.from_pydict({"lang": [name] * dimensions, "d": np.arange(dimensions, dtype=np.int32),
                                              "v": np.asarray(vector, np.float64)})

    summed = rows.mapInArrow(bundle, "lang string, d int, v double").groupBy("lang", "d").agg(F.sum("v").alias("v"))
    found = summed.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("d", "v"))).alias("v")).orderBy("lang").limit(MOST_LANGUAGES + 1).collect()
    if len(found) > MOST_LANGUAGES:
        raise ValueError(f"the language column has more than {MOST_LANGUAGES} values")
    unit = np.array([[x["v"] for x in r["v"]] for r in found], np.float32).reshape(-1, dimensions)
    unit /= np.maximum(np.sqrt((unit * unit).sum(1, keepdims=True)), 1e-9)
    return Profiles([r["lang"] for r in found], unit, dimensions)


def identify(docs: DataFrame, profiles: Profiles, text: str = "text") -> DataFrame:
    """docs with one more column at the end, `_lang` (underscores follow if docs has it): struct of lang_pred and score.

    `und` with score 0 where the text is null, has no letter, or nothing was learned; equal cosines go to the
    language first in the alphabet.
    """
    kind = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return docs.withColumn(fresh("_lang", docs.columns), per_text(profiles.predict, kind)(F.col(text)))


@query("op7_language_id")
def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = id_remainder(F.col("doc_id"), 3) == 1
    profiles = fit(docs.filter(~held_out))
    found = identify(docs.select("doc_id", "text"), profiles)
    return found.select("doc_id", held_out.alias("held_out"), "_lang.lang_pred", "_lang.score")
