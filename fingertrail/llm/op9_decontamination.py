"""Benchmark decontamination by pigeonhole edit matching.

An item of m characters may differ from a passage by a budget of edits. Cut into one piece more than the
budget, at least one piece must occur unchanged; all pieces of a block of items are searched at once in each
text, and each hit's surroundings are verified with Myers' bit-parallel edit distance. Both sides are
lower-cased and their white space is folded first. A passage begins and ends at word borders, so that a short item
does not count inside longer words.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fingertrail.llm.catalog import query
from fingertrail.llm.common import fresh, per_text, table
from fingertrail.session import store

#: One edit for every so many characters of an item; shorter items must occur unchanged.
CHARS_PER_EDIT = 12
#: Characters of items searched in one pass over the documents; larger benchmarks take several passes.
BLOCK_CHARS = 2_000_000


def folded(text: str) -> str:
    return " ".join(text.lower().split())


def budget(item: str) -> int:
    return len(item) // CHARS_PER_EDIT


def pieces(item: str) -> list[tuple[int, str]]:
    """Start and text of budget + 1 pieces of nearly equal length."""
    count = budget(item) + 1
    cuts = [len(item) * k // count for k in range(count + 1)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


def scan(pattern: str, text: str, anchored: bool = False) -> Iterator[int]:
    """Edit distance of the pattern to the best passage that ends at each character (Myers, one word of any width).
    Anchored: to the whole text up to there."""
    m = len(pattern)
    full, top, equal = (1 << m) - 1, 1 << (m - 1), defaultdict(int)
    for k, c in enumerate(pattern):
        equal[c] |= 1 << k
    plus, minus, score = full, 0, m
    for c in text:
        eq = equal.get(c, 0)
        vertical = eq | minus
        horizontal = (((eq & plus) + plus) ^ plus) | eq
        up, down = minus | (full & ~(horizontal | plus)), plus & horizontal
        score += 1 if up & top else -1 if down & top else 0
        up, down = up << 1 | anchored, down << 1
        plus, minus = (down | ~(vertical | up)) & full, up & vertical & full
        yield score


def at_border(text: str, k: int) -> bool:
    """Whether no word goes on over the place before character k."""
    return k <= 0 or k >= len(text) or not (text[k - 1].isalnum() and text[k].isalnum())


def best_passage(item: str, text: str, most: int, low: int = 0, high: int | None = None) -> tuple[int, int, int] | None:
    """Distance, start and end of the closest passage of text[low:high] within the budget that begins and ends at word borders;
    ties go to the leftmost end, then the shortest passage."""
    part, best = text[low:high], None
    for j, d in enumerate(scan(item, part)):
        end = j + 1
        if d > most or best and d >= best[0] or not at_border(text, low + end):
            continue
        back = part[:end][::-1][:len(item) + most]
        for k, own in enumerate(scan(item[::-1], back, True)):
            if own <= most and (best is None or own < best[0]) and at_border(text, low + end - k - 1):
                best = (own, low + end - k - 1, low + end)
    return best


class Matcher:
    """All pieces of a block of items in one automaton."""

    def __init__(self, items: tuple[tuple[int, str], ...]):
        self.items = items
        places = defaultdict(list)
        for number, (_, item) in enumerate(items):
            for start, piece in pieces(item):
                places[piece].append((number, start))
        self.automaton = ahocorasick.Automaton()
        for piece, found in places.items():
            self.automaton.add_word(piece, (len(piece), found))
        if places:
            self.automaton.make_automaton()
        self.empty = not places

    def search(self, text: str) -> list[tuple[int, int, int, int]]:
        """Item id, distance, start and end in the folded text of the best passage of each item found."""
        if self.empty:
            return []
        starts = defaultdict(set)
        for last, (size, found) in self.automaton.iter(text):
            for number, offset in found:
                starts[number].add(last + 1 - size - offset)
        out = []
        for number, at in starts.items():
            item_id, item = self.items[number]
            exact = min((a for a in at if a >= 0 and text.startswith(item, a) and at_border(text, a) and at_border(text, a + len(item))), default=None)
            if exact is not None:
                out.append((item_id, 0, exact, exact + len(item)))
                continue
            most, m, windows = budget(item), len(item), []
            if not most:
                continue
            for a in sorted(at):
                low, high = max(0, a - most), a + m + most
                if windows and low <= windows[-1][1]:
                    windows[-1][1] = high
                else:
                    windows.append([low, high])
            found = [hit for low, high in windows if (hit := best_passage(item, text, most, low, high))]
            if found:
                out.append((item_id, *min(found)))
        return out


@lru_cache(maxsize=2)
def matcher(items: tuple[tuple[int, str], ...]) -> Matcher:
    return Matcher(items)


def unfolded(text: str, start: int, end: int) -> tuple[int, int]:
    """The passage of the original text that a passage of the folded text comes from."""
    at, out = 0, [0, len(text)]
    for word in re.finditer(r"\S+", text):
        size = len(word.group().lower())
        if at <= start < at + size + 1:
            out[0] = min(word.start() + start - at, word.end())
        if at < end <= at + size + 1:
            out[1] = min(word.start() + end - at, word.end())
        at += size + 1
    return out[0], out[1]


HITS = T.ArrayType(T.StructType([T.StructField("item_id", T.LongType()), T.StructField("distance", T.IntegerType()),
                                 T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))


def item_blocks(benchmark: DataFrame, text: str = "text", item_id: str = "item_id",
                most: int = BLOCK_CHARS) -> Iterator[tuple[tuple[int, str], ...]]:
    """The items in blocks of about `most` characters, dealt by hash; one block at a time is on the driver.

    Items with a null id, or without a character besides white space, are left out; repeated items count once.
    """
    rows = (benchmark.select(F.col(item_id).cast("long").alias("i"), F.col(text).alias("t"))
            .filter(F.col("i").isNotNull() & F.col("t").isNotNull()))
    total = rows.agg(F.sum(F.length("t"))).first()[0] or 0
    count = -(-total // most) or 1
    for block in range(count):
        own = rows.filter(F.pmod(F.xxhash64("i", "t"), F.lit(count)) == block) if count > 1 else rows
        yield tuple(sorted({(r["i"], f) for r in own.collect() if (f := folded(r["t"]))}))


def with_hits(docs: DataFrame, items: tuple[tuple[int, str], ...], hits: str, text: str = "text") -> DataFrame:
    """docs with one more column `hits`: the items of one block that a text holds. Null and empty texts hold none."""
    def run(texts: list[str]) -> list:
        search = matcher(items).search
        return [[{"item_id": i, "distance": d, **dict(zip(("start", "end"), unfolded(value, a, b)))}
                 for i, d, a, b in sorted(search(folded(value)))] for value in texts]

    return docs.withColumn(hits, per_text(run, HITS)(F.col(text)))


def leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per document and item found in it: doc_id, item_id, distance, start and end (code points) of the
    closest passage. Repeated documents give repeated rows."""
    found = None
    for items in item_blocks(benchmark):
        rows = with_hits(docs.select(doc_id, text), items, "_hits", text).select(F.col(doc_id).alias("doc_id"), F.explode("_hits").alias("_h"))
        rows = rows.select("doc_id", "_h.*")
        found = rows if found is None else store(found).unionByName(rows)
    return found


def without_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The documents that hold no item, with their columns."""
    for number, items in enumerate(item_blocks(benchmark)):
        if number:
            docs = store(docs)
        hits = fresh("_hits", docs.columns)
        docs = with_hits(docs, items, hits, text).filter(F.size(hits) == 0).drop(hits)
    return docs


@query("op9_decontamination")
def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
