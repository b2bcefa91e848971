"""N-gram Jaccard join with prefix trees.

A document is the set of its word n-grams, kept as 64-bit hashes. Equal sets become one. The global order is by rising
frequency: a sketch of counters of fixed size, summed over all tasks, gives every hash a class that takes its top bits,
so numeric order is the order of prefixes, tries and bounds, and prefixes hold rare n-grams. (Any total order is exact;
the counters only decide how much is compared.) Sets that can reach the threshold share a hash in their prefixes.

Hashes in the prefixes of few sets give candidate pairs by a join, with exact bounds: sizes, places in the prefixes,
no common hash just before, and the parity bitmaps of both sets, whose distance never exceeds the symmetric difference.
For hashes of many sets, rounds in which each set meets one pivot tie most sets first; if several components are left,
their sketches are dealt to cells in blocks of bounded number and size, which apply the same bounds between components and
give pairs, or if these are many the sets that have any, as members of smaller cells.

A pair is verified in the cell of the smallest id around it, which near copies share, so a text is sent and hashed in few
cells; more sets than a cell holds are dealt by blocks.

In a cell, the sets form a trie over their ordered hashes, and the probing sets walk it together. A node's overlaps with
all probes are counted once for all sets below it, and a subtree is left by every probe that what remains of both
can no longer lift to the required overlap. A cell gives back a spanning forest of its links, not all pairs.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fingertrail.llm.catalog import query
from fingertrail.llm.common import fresh, per_text, release, small_batches, table, text_slices
from fingertrail.llm.components import components
from fingertrail.session import store

WORDS, PERCENT = 3, 90
#: Sets on either side of a cell, and the n-grams that they may have together; more of either make further cells.
BLOCK, BLOCK_GRAMS = 1_000, 500_000
#: Bits of the short bitmap; sets that need more than WIDE_FROM bits have a bitmap of that size or more instead.
BITS, WIDE_FROM = 256, 200
#: Hashes in more prefixes than this are worked on in cells of members, others by pairs, which are at most so many for each entry.
FREQUENT = 64
#: Rounds in which each set of frequent hashes meets one other; what they leave is found by candidates between components.
ROUNDS = 1
#: How many times BLOCK a side of a cell of sketches has, the pairs for each of its sets beyond which it gives members, and words of bitmaps compared at once.
WIDER, PAIRS_EACH, PAIR_WORDS = 4, 16, 1 << 19
#: Counters of the frequency sketch, and how many of them make a row.
COUNTERS, CHUNK = 1 << 21, 1 << 12
#: Characters of texts that are hashed together.
SLICE = 500_000
#: Bits of a hash below its frequency class.
LOW_BITS = 57
#: Ids of candidate documents that may be broadcast to fetch their texts; more are joined by a shuffle of the texts.
MOST_IDS = 1_000_000
#: Texts of members that a cell's task gets at once.
WALK_ROWS = 250

_ODD = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: Bytes of words hashed at once, and the longest word that the table of places covers; longer ones are hashed alone.
CHUNK_BYTES, LONGEST_WORD = 1 << 18, 1 << 10
_PLACES = np.random.default_rng(1).integers(0, 1 << 63, LONGEST_WORD, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_IS_WORD = np.ones(256, bool)
_IS_WORD[[9, 10, 11, 12, 13, 32]] = False


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all words of all texts, and where each text's words begin (and, last, where they end)."""
    parts = [t.encode("utf-8", "replace").lower() for t in texts]
    joined = b"\n".join(parts)
    letters = np.frombuffer(joined, np.uint8)
    inside = _IS_WORD[letters]
    edges = np.flatnonzero(np.diff(np.r_[False, inside, False]))
    starts, ends = edges[::2], edges[1::2]
    sizes = ends - starts
    out = np.zeros(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        last = max(at + 1, int(np.searchsorted(ends, starts[at] + CHUNK_BYTES)))
        size = np.minimum(sizes[at:last], LONGEST_WORD)
        begins = np.r_[0, np.cumsum(size)[:-1]]
        place = np.arange(size.sum()) - np.repeat(begins, size)
        values = letters[np.repeat(starts[at:last], size) + place].astype(np.uint64) + np.uint64(1)
        out[at:last] = np.add.reduceat(values * _PLACES[place], begins)
        at = last
    out = _mixed(out ^ sizes.astype(np.uint64) * _ODD)
    for k in np.flatnonzero(sizes > LONGEST_WORD).tolist():
        out[k] = xxhash.xxh3_64_intdigest(joined[starts[k]:ends[k]])
    offsets = np.cumsum([0, *(len(p) + 1 for p in parts)])
    return out, np.searchsorted(starts, offsets)


def shingle_sets(texts: list[str], words: int = WORDS) -> list[np.ndarray]:
    """The ordered distinct hashes of each text's word n-grams; a text of fewer words has one for all of them."""
    w, begins = word_hashes(texts)

    def grams(own: np.ndarray, size: int) -> np.ndarray:
        h = np.full(len(own) - size + 1, size, np.uint64)
        for k in range(size):
            h = _mixed(h + _ODD ^ own[k:len(own) - size + 1 + k])
        return h.view(np.int64)

    whole = grams(w, words) if len(w) >= words else np.zeros(0, np.int64)
    out = []
    for a, b in zip(begins[:-1].tolist(), begins[1:].tolist()):
        if b - a >= words:
            s = np.sort(whole[a:b - words + 1])
            out.append(s[np.r_[True, s[1:] != s[:-1]]])
        else:
            out.append(grams(w[a:b], b - a) if b > a else np.zeros(0, np.int64))
    return out


@dataclass
class Hashing:
    """What turns a text into its ordered hashes, and the threshold; classes is a broadcast variable."""
    words: int
    percent: int
    classes: object


def probe_prefix(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def digest(s: np.ndarray) -> tuple[int, int]:
    value = xxhash.xxh3_128_intdigest(s.astype("<i8").tobytes())
    return (value >> 64) - (1 << 63), (value & ((1 << 64) - 1)) - (1 << 63)


SKETCH = T.StructType([T.StructField("n", T.LongType()), T.StructField("k1", T.LongType()), T.StructField("k2", T.LongType()),
                       T.StructField("prefix", T.ArrayType(T.LongType())), T.StructField("bits", T.ArrayType(T.LongType())),
                       T.StructField("wide", T.ArrayType(T.LongType()))])


def counter_of(s: np.ndarray) -> np.ndarray:
    return (s >> np.int64(20)) & np.int64(COUNTERS - 1)


def by_frequency(s: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """The hashes with their frequency class as top bits."""
    return classes[counter_of(s)].astype(np.int64) << np.int64(LOW_BITS) | s & np.int64((1 << LOW_BITS) - 1)


def smallest(s: np.ndarray, k: int) -> np.ndarray:
    """The k smallest values in rising order."""
    return np.sort(np.partition(s, k - 1)[:k] if k < len(s) else s)


def parity_bitmap(s: np.ndarray, bits: int) -> np.ndarray:
    """Which of so many residues of the hashes occur an odd number of times; both halves together are that of half the bits."""
    odd = np.bincount((s >> np.int64(17)) & np.int64(bits - 1), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).view("<i8")


def sketches(texts: list[str], words: int, percent: int, classes: np.ndarray) -> list[dict]:
    """Of each set: size, 128-bit digest, the hashes of its prefix and its parity bitmap."""
    out = []
    for raw in shingle_sets(texts, words):
        if not len(raw):
            out.append({"n": 0, "k1": None, "k2": None, "prefix": None, "bits": None, "wide": None})
            continue
        s = by_frequency(raw, classes)
        # unrelated sets differ in half of the bits, which must be more than linked sets may differ in hashes
        need = max(64, 480 * len(s) * (100 - percent) // (100 + percent) // 100)
        wide = parity_bitmap(s, 1 << (need - 1).bit_length()) if need > WIDE_FROM else None
        k1, k2 = digest(raw)
        out.append({"n": len(s), "k1": k1, "k2": k2, "prefix": smallest(s, probe_prefix(len(s), percent)),
                    "bits": parity_bitmap(s, BITS) if wide is None else None, "wide": wide})
    return out


def count_into(counts: np.ndarray, sets: list[np.ndarray]) -> None:
    """Add the hashes of the sets to their counters, up to 65,535; only the counters that they have are touched."""
    at, times = np.unique(counter_of(np.concatenate(sets)), return_counts=True)
    counts[at] = np.minimum(counts[at] + times, 65535)


def count_sets(docs: DataFrame, words: int) -> tuple[DataFrame, np.ndarray]:
    """Per row of docs (id, value) the size and digest of its set, and the frequency class of every counter.

    Every task counts all n-grams of its texts in counters of fixed size; these are summed per row of counters.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(COUNTERS, "<u2")
        for batch in batches:
            facts = []
            for part in text_slices(batch.column(1), SLICE):
                sets = shingle_sets(part, words)
                facts += [(len(s), *digest(s)) if len(s) else (0, None, None) for s in sets]
                count_into(counts, sets)
                del sets
            release()
            yield filled(batch.num_rows, id=batch.column(0), n=[f[0] for f in facts], k1=[f[1] for f in facts], k2=[f[2] for f in facts])
        rows = counts.reshape(-1, CHUNK)
        used = np.flatnonzero(rows.any(1))
        yield filled(len(used), chunk=used, counts=[r.tobytes() for r in rows[used]])
        del counts, rows
        release()

    def filled(size: int, **columns) -> pa.RecordBatch:
        kinds = {"id": pa.int64(), "n": pa.int64(), "k1": pa.int64(), "k2": pa.int64(), "chunk": pa.int64(), "counts": pa.binary()}
        return pa.RecordBatch.from_arrays([pa.array(columns[k], t) if k in columns else pa.nulls(size, t) for k, t in kinds.items()], names=list(kinds))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for chunk, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                sums[chunk] = sums.get(chunk, 0) + np.frombuffer(counts, "<u2").astype(np.int64)
        classes = [np.log2(v + 1).astype(np.uint8).tobytes() for v in sums.values()]
        yield pa.RecordBatch.from_pydict({"chunk": pa.array(list(sums), pa.int64()), "classes": pa.array(classes, pa.binary())})

    with small_batches(docs.sparkSession):
        found = store(docs.mapInArrow(run, "id long, n long, k1 long, k2 long, chunk long, counts binary"))
    rows = found.filter("chunk is not null").select("chunk", "counts").repartition("chunk").mapInArrow(add, "chunk long, classes binary")
    classes = np.zeros((COUNTERS // CHUNK, CHUNK), np.uint8)
    for r in rows.collect():  # a byte per counter
        classes[r["chunk"]] = np.frombuffer(bytes(r["classes"]), np.uint8)
    return found.filter("chunk is null").select("id", "n", "k1", "k2"), classes.reshape(-1)


def live_entries(reps: DataFrame, percent: int) -> DataFrame:
    """Prefix entries (token, c, id, n, place, before) whose hash c sets have, at least one of them in its shorter prefix."""
    entries = reps.select("id", "n", F.posexplode("prefix").alias("place", "token"), "prefix")
    entries = entries.select("token", "id", "n", "place", F.when(F.col("place") > 0, F.get("prefix", F.col("place") - 1)).alias("before"))
    inside = F.when(F.col("place") < F.expr(_inner("n", percent)), (1 << 32) + 1).otherwise(1)
    shared = (entries.groupBy("token").agg(F.sum(inside).alias("c")).withColumn("inner", F.shiftright("c", 32))
              .withColumn("c", F.col("c") - F.shiftleft("inner", 32)).filter("c > 1 and inner > 0").drop("inner"))
    return entries.join(shared, "token")


def _inner(n: str, percent: int) -> str:
    """Length of the shorter prefix, which suffices for the smaller set of a pair."""
    return f"({n} - ({2 * percent} * {n} + {99 + percent}) div {100 + percent} + 1)"


def candidate_pairs(live: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """Pairs (token, x, y) that the bounds leave, y the smaller set or of equal size and smaller id; tokens are of few sets."""
    x, y = live.alias("x"), live.alias("y")
    need = f"(({percent} * (x.n + y.n) + {99 + percent}) div {100 + percent})"
    pairs = x.join(y, F.expr(f"""
        x.token = y.token and (y.n < x.n or y.n = x.n and y.id < x.id) and 100 * y.n >= {percent} * x.n
        and y.place < {_inner("y.n", percent)}
        and least(x.n - x.place, y.n - y.place) >= {need}
        and (x.before is null or y.before is null or x.before <> y.before)""")).select(
        F.col("x.token").alias("token"), F.col("x.id").alias("x"), F.col("y.id").alias("y"), F.expr(f"x.n + y.n - 2 * {need}").alias("apart"))
    return _by_bitmaps(pairs, reps).select("token", "x", "y")


def _by_bitmaps(pairs: DataFrame, reps: DataFrame) -> DataFrame:
    """Pairs (x, y, apart and other columns) whose bitmaps differ in at most `apart` bits."""
    maps = reps.select("id", F.col("bits"), F.col("wide"))
    both = (pairs.join(maps.select(F.col("id").alias("x"), F.col("bits").alias("xb"), F.col("wide").alias("xw")), "x")
            .join(maps.select(F.col("id").alias("y"), F.col("bits").alias("yb"), F.col("wide").alias("yw")), "y"))
    distance = F.coalesce(F.expr(_wide_distance("xb", "yb")), F.expr(_wide_distance("xw", "yw")), F.lit(0))
    return both.filter(distance <= F.col("apart")).drop("xb", "xw", "yb", "yw")


def _wide_distance(a: str, b: str) -> str:
    """Differing bits of two bitmaps, the longer one folded to the length of the other."""
    def folded(v: str) -> str:
        half = f"cast(size({v}) / 2 as int)"
        return (f"if(size({v}) > least(size({a}), size({b})), "
                f"zip_with(slice({v}, 1, {half}), slice({v}, {half} + 1, {half}), (p, q) -> p ^ q), {v})")
    return f"aggregate(zip_with({folded(a)}, {folded(b)}, (p, q) -> bit_count(p ^ q)), 0, (s, d) -> s + d)"


def trie_links(residents: list[np.ndarray], probes: list[np.ndarray], percent: int) -> Iterator[tuple[int, np.ndarray]]:
    """For each resident with any: its number and the numbers of the probes that reach the threshold with it.

    Residents sorted as sequences are a trie: neighbours share the path up to their first difference.
    """
    order = sorted(range(len(residents)), key=lambda r: (residents[r] ^ np.int64(-1 << 63)).astype(">u8").tobytes())
    sets = [residents[r] for r in order]
    common = [0] * (len(sets) + 1)  # length of the path shared with the set before
    for k in range(1, len(sets)):
        a, b = sets[k - 1], sets[k]
        m = min(len(a), len(b))
        different = np.flatnonzero(a[:m] != b[:m])
        common[k] = int(different[0]) if len(different) else m
    sizes = np.array([len(s) for s in sets])
    lengths = np.array([len(p) for p in probes])
    tokens = np.concatenate(probes)
    owner = np.repeat(np.arange(len(probes)), lengths)
    by_token = np.argsort(tokens, kind="stable")
    tokens, owner = tokens[by_token], owner[by_token]
    stack = [(0, len(sets), 0, np.zeros(len(probes), np.int64), np.ones(len(probes), bool))]
    while stack:
        low, high, depth, overlap, live = stack.pop()
        end = len(sets[low]) if high - low == 1 else min(common[low + 1:high])
        if end > depth:
            path = sets[low][depth:end]
            a, b = np.searchsorted(tokens, path, "left"), np.searchsorted(tokens, path, "right")
            many = b - a
            at = np.repeat(a - np.r_[0, np.cumsum(many)[:-1]], many) + np.arange(many.sum())
            overlap = overlap + np.bincount(owner[at], minlength=len(probes))
            past = np.bincount(owner[:b[-1]], minlength=len(probes))
        else:
            past = np.zeros(len(probes), np.int64)
        below = sizes[low:high]
        need = -(-percent * (lengths + below.min()) // (100 + percent))
        live = live & (overlap + np.minimum(lengths - past, below.max() - end) >= need)
        if not live.any():
            continue
        if high - low == 1:
            found = np.flatnonzero(live & (overlap >= need))
            if len(found):
                yield order[low], found
            continue
        cuts = [low, *(k for k in range(low + 1, high) if common[k] == end), high]
        stack += [(a, b, end, overlap, live) for a, b in zip(cuts, cuts[1:])]


def forest(ids: dict, residents: list, probes: list, percent: int) -> list[tuple]:
    """Links of a block, without those between sets that earlier links already tie."""
    root: dict = {}

    def top(v):
        while (up := root.get(v, v)) != v:
            root[v] = v = root.get(up, up)
        return v

    out = []
    for r, found in trie_links([ids[r] for r in residents], [ids[p] for p in probes], percent):
        for p in found.tolist():
            a, b = top(residents[r]), top(probes[p])
            if a != b:
                root[max(a, b)] = min(a, b)
                out.append((residents[r], probes[p]))
    return out


def _blocks(sets: Column, grams: Column, times: int = 1) -> Column:
    return F.greatest(F.ceil(sets / (times * BLOCK)), F.ceil(grams / (times * BLOCK_GRAMS)), F.lit(1))


def _part(blocks: str, doc: str = "id") -> Column:
    return F.pmod(F.xxhash64(doc), F.col(blocks))


def _band(percent: int) -> Column:
    """Bands are a little wider than the sizes of a pair may differ, so a pair lies in one band or two neighbours."""
    return F.floor(F.log(F.col("n").cast("double")) / (1.001 * math.log(100 / percent) or 1.0))


def star_links(heavy: DataFrame, reps: DataFrame, docs: DataFrame, hashing: Hashing) -> tuple[DataFrame | None, DataFrame | None]:
    """(links, components) found among the sets of frequent hashes when each set meets one other in each round.

    Every hash and band of sizes has a pivot: first the set with most frequent hashes, as edits take places of a prefix, then one
    by chance. Of the pivots that a set's bounds leave in other components it meets one, so a round sends no more than the sets
    there are. What rounds leave out is left to the candidates between components.
    """
    links, tied, percent = None, None, hashing.percent
    if heavy.isEmpty():
        return links, tied
    for salt in range(ROUNDS):
        named = _with_component(heavy.select("token", "id", "n", "k1"), tied).withColumn("band", _band(percent))
        named = named.withColumn("w", F.lit(0)) if salt else named.join(heavy.groupBy("id").agg((-F.count("*")).alias("w")), "id")
        first = F.min(F.struct("w", F.xxhash64("id", F.lit(salt)).alias("o"), F.col("id").alias("y"), F.col("n").alias("yn"),
                               F.col("k1").alias("yk"), F.col("component").alias("yc")))
        pivots = named.groupBy("token", "band").agg(first.alias("p")).select("token", "band", "p.*")
        need = f"(({percent} * (n + yn) + {99 + percent}) div {100 + percent})"
        met = (named.drop("w").join(pivots, ["token", "band"]).filter("component <> yc and least(n, yn) >= " + need)
               .select(F.col("id").alias("x"), "n", "k1", "w", "o", "y", "yk", F.expr(f"n + yn - 2 * {need}").alias("apart")).distinct())
        one = store(_by_bitmaps(met, reps).groupBy("x", "n", "k1").agg(F.min(F.struct("w", "o", "y", "yk")).alias("p")).select("x", "n", "k1", "p.y", "p.yk"))
        load = one.groupBy("y", "yk").agg(_blocks(F.count("*"), F.sum("n")).alias("parts"))
        zero = F.lit(0).cast("long")
        probing = one.join(load.select("y", "parts"), "y").select(F.col("y").alias("g1"), zero.alias("g2"), _part("parts", "x").alias("g3"),
                                                                 F.lit(1).alias("role"), F.col("x").alias("id"), "k1")
        living = load.select(F.col("y").alias("g1"), zero.alias("g2"), F.explode(F.sequence(zero, F.col("parts") - 1)).alias("g3"),
                             F.lit(0).alias("role"), F.col("y").alias("id"), F.col("yk").alias("k1"))
        new = walk(probing.unionByName(living), docs, hashing)
        if new.isEmpty():
            break
        links = new if links is None else links.unionByName(new)
        tied = store(components(links))
    return links, tied


def _with_component(entries: DataFrame, tied: DataFrame | None) -> DataFrame:
    if tied is None:
        return entries.withColumn("component", F.col("id"))
    return entries.join(tied, F.col("id") == F.col("node"), "left").withColumn("component", F.coalesce("component", "id")).drop("node")


def _untied(pairs: DataFrame, tied: DataFrame | None) -> DataFrame:
    """Pairs x, y without those of one component."""
    if tied is None:
        return pairs
    for side in ("x", "y"):
        pairs = pairs.join(tied.select(F.col("node").alias(side), F.col("component").alias(f"{side}c")), side, "left")
    return pairs.filter("coalesce(xc, x) <> coalesce(yc, y)").select("x", "y")


def cells(heavy: DataFrame, percent: int) -> DataFrame:
    """Rows of cells of frequent hashes that several components have; a set goes to the cells of its block's row and column.

    A set probes its own band and the one below. Columns g1, g2, g3, role (0 lives there, 1 probes) and those of heavy.
    """
    several = heavy.groupBy("token").agg(F.min("component").alias("a"), F.max("component").alias("b")).filter("a <> b").select("token")
    rows = heavy.join(several, "token", "left_semi").withColumn("own", _band(percent))
    rows = rows.withColumn("band", F.explode(F.array(F.col("own"), F.col("own") - 1)))
    lives = F.col("own") == F.col("band")
    load = rows.groupBy("token", "band").agg(
        _blocks(F.count_if(lives), F.sum(F.when(lives, F.col("n")).otherwise(0)), WIDER).alias("residents"),
        _blocks(F.count("*"), F.sum("n"), WIDER).alias("probes"), F.count_if(lives).alias("sets")).filter("sets > 0")
    rows = rows.join(load, ["token", "band"])
    home, own = F.struct("token", "band"), [c for c in heavy.columns if c != "token"]
    probing = rows.select(home.alias("h"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("residents") - 1)).alias("g2"), _part("probes").alias("g3"),
                          F.lit(1).alias("role"), *own)
    living = rows.filter(lives).select(home.alias("h"), _part("residents").alias("g2"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("probes") - 1)).alias("g3"),
                                       F.lit(0).alias("role"), *own)
    return probing.unionByName(living).select(F.xxhash64("h").alias("g1"), "g2", "g3", "role", *own)


@dataclass
class Sketches:
    """Sets of one side of a cell without their hashes: ids, sizes, places of the cell's hash, hashes just before, components, bitmaps."""
    id: np.ndarray
    n: np.ndarray
    place: np.ndarray
    before: np.ndarray
    first: np.ndarray
    component: np.ndarray
    maps: list[np.ndarray]

    @classmethod
    def of(cls, t: pa.Table) -> Sketches:
        plain = {c: t[c].to_numpy() for c in ("id", "n", "place", "component")}
        maps = [np.array(b if b is not None else w, np.int64).view(np.uint64) for b, w in zip(t["bits"].to_pylist(), t["wide"].to_pylist())]
        return cls(before=t["before"].fill_null(0).to_numpy(), first=t["before"].is_null().to_numpy(), maps=maps, **plain)


def folded(a: np.ndarray, words: int) -> np.ndarray:
    """Rows of bitmaps brought to so many words."""
    while a.shape[1] > words:
        a = a[:, :a.shape[1] // 2] ^ a[:, a.shape[1] // 2:]
    return a


def between(residents: Sketches, probes: Sketches, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places of probes, places of residents): pairs of different components that the bounds of `candidate_pairs` leave."""
    def by_length(s: Sketches) -> list[tuple[np.ndarray, np.ndarray]]:
        lengths = np.array([len(m) for m in s.maps], int)
        return [(at := np.flatnonzero(lengths == k), np.stack([s.maps[i] for i in at])) for k in np.unique(lengths)]

    inner = residents.n - (2 * percent * residents.n + 99 + percent) // (100 + percent) + 1
    left, living = residents.n - residents.place, by_length(residents)
    for at, maps in by_length(probes):
        for home, theirs in living:
            words = min(maps.shape[1], theirs.shape[1])
            mine, other = folded(maps, words), folded(theirs, words)
            home_n = residents.n[home]
            step = max(1, PAIR_WORDS // (words * len(home)))
            for k in range(0, len(at), step):
                x = at[k:k + step, None]
                n = probes.n[x]
                need = (percent * (n + home_n) + 99 + percent) // (100 + percent)
                near = ((probes.component[x] != residents.component[home]) & ((home_n < n) | (home_n == n) & (residents.id[home] < probes.id[x]))
                        & (residents.place[home] < inner[home]) & (np.minimum(n - probes.place[x], left[home]) >= need) & (100 * home_n >= percent * n)
                        & (probes.first[x] | residents.first[home] | (probes.before[x] != residents.before[home])))
                i, j = np.nonzero(near)
                if len(i):
                    distance = np.bitwise_count(mine[k + i] ^ other[j]).sum(1, dtype=np.int64)
                    close = distance <= (n + home_n - 2 * need)[i, j]
                    if close.any():
                        yield at[k + i[close]], home[j[close]]


def tiles(n: np.ndarray) -> np.ndarray:
    """The number of the block of each set, in order; blocks have at most BLOCK sets, and about BLOCK_GRAMS n-grams."""
    return np.maximum(np.arange(len(n)) // BLOCK, np.cumsum(n) // BLOCK_GRAMS)


def cell_candidates(key: tuple[int, int, int], residents: Sketches, probes: Sketches, percent: int) -> pa.RecordBatch:
    """Pairs x, y of a cell; if they are many, members (x, without y) of smaller cells, which are those sets that have a pair there."""
    home, away = tiles(residents.n), tiles(probes.n)
    lives, probing = np.zeros((away.max() + 1, len(home)), bool), np.zeros((home.max() + 1, len(away)), bool)
    found, count, most = [], 0, PAIRS_EACH * (len(home) + len(away))
    for p, r in between(residents, probes, percent):
        lives[away[p], r] = True
        probing[home[r], p] = True
        count += len(p)
        found = [*found, (p, r)] if count <= most else []
    if count <= most:
        x = np.concatenate([probes.id[p] for p, _ in found]) if found else np.zeros(0, np.int64)
        y = np.concatenate([residents.id[r] for _, r in found]) if found else np.zeros(0, np.int64)
        return _candidates(x=x, y=y)
    rows: list[tuple] = []
    for h, a in itertools.product(range(home.max() + 1), range(away.max() + 1)):
        for role, ids in ((0, residents.id[lives[a] & (home == h)]), (1, probes.id[probing[h] & (away == a)])):
            rows += [(int(x), key[0], key[1] << 20 | h, key[2] << 20 | a, role) for x in ids]
    x, g1, g2, g3, role = zip(*rows)
    return _candidates(x=x, g1=g1, g2=g2, g3=g3, role=role)


def _candidates(x, **columns) -> pa.RecordBatch:
    kinds = {"y": pa.int64(), "g1": pa.int64(), "g2": pa.int64(), "g3": pa.int64(), "role": pa.int32()}
    return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()), *(pa.array(columns[k], t) if k in columns else pa.nulls(len(x), t) for k, t in kinds.items())],
                                      names=["x", *kinds])


def heavy_candidates(heavy: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """What is left to compare between components that share frequent hashes: pairs x, y, or members (x; y is null) of cells g1, g2, g3.

    Cells hold sketches, not texts. A pair is found at its first common hash only, if that is frequent.
    """
    block = ["g1", "g2", "g3"]
    rows = cells(heavy.drop("k1").join(reps.select("id", "bits", "wide"), "id"), percent)
    rows = rows.repartition(*block).sortWithinPartitions(*block)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held = None, []

        def flush() -> Iterator[pa.RecordBatch]:
            if held:
                t = pa.Table.from_batches(held)
                role = t["role"].to_numpy()
                sides = [Sketches.of(t.take(np.flatnonzero(role == k))) for k in (0, 1)]
                if len(sides[0].id) and len(sides[1].id):
                    yield cell_candidates(current, *sides, percent)

        for batch in batches:
            keys = np.stack([batch.column(k).to_numpy() for k in range(3)])
            cuts = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(0)) + 1).tolist(), batch.num_rows]
            for a, b in zip(cuts, cuts[1:]):
                if b > a:
                    if (key := tuple(keys[:, a].tolist())) != current:
                        yield from flush()
                        current, held = key, []
                    held.append(batch.slice(a, b - a))
            del batch
            release()
        yield from flush()
        held.clear()
        release()

    with small_batches(heavy.sparkSession):
        return store(rows.mapInArrow(run, "x long, y long, g1 long, g2 long, g3 long, role int"))


def pair_cells(pairs: DataFrame, reps: DataFrame) -> DataFrame:
    """Members of cells for pairs x, y of candidates: the cell of the smallest id that y is paired with, or cells of blocks of it.

    Sets that are paired with each other share that id, so a text is sent to few cells, not once for each pair.
    """
    near = pairs.select("x", "y").unionByName(pairs.select(F.col("y").alias("x"), F.col("x").alias("y")))
    homes = near.groupBy("x").agg(F.min("y").alias("m")).select(F.col("x").alias("y"), F.least("x", "m").alias("g1"))
    placed = store(pairs.join(homes, "y").select("g1", "x", "y"))
    sets = placed.select("g1", F.explode(F.array("x", "y")).alias("id")).distinct().join(reps.select("id", "n"), "id")
    load = sets.groupBy("g1").agg(_blocks(F.count("*"), F.sum("n")).alias("parts"))
    role = lambda k: F.when(F.col("parts") == 1, 2).otherwise(k).alias("role")
    sides = F.array(F.struct(role(0), F.col("y").alias("id")), F.struct(role(1), F.col("x").alias("id")))
    rows = placed.join(load, "g1").select("g1", _part("parts", "y").alias("g2"), _part("parts", "x").alias("g3"), F.inline(sides))
    return rows.distinct()


def walk(members: DataFrame, docs: DataFrame, hashing: Hashing) -> DataFrame:
    """Links a, b of the forests of all cells (g1, g2, g3): members are sets in the trie (role 0), probes (1) or both (2).

    docs has columns id and value; a text is read only if its id is a member's.
    """
    block = ["g1", "g2", "g3"]
    members = store(members)
    ids = members.select("id").distinct()
    if members.count() <= MOST_IDS:
        docs = docs.join(F.broadcast(ids), "id", "left_semi")
    percent, words, classes = hashing.percent, hashing.words, hashing.classes
    texts = members.join(docs, "id").repartition(*block).sortWithinPartitions(*block, "id", "k1").select(*block, "role", "id", "k1", "value")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, sets, sides = None, {}, ([], [])

        def flush():
            found = forest(sets, *sides, percent) if sides[0] and sides[1] else []
            return pa.RecordBatch.from_pydict({"a": [a for (a, _), _ in found], "b": [b for _, (b, _) in found]},
                                              schema=pa.schema([("a", pa.int64()), ("b", pa.int64())]))

        for batch in batches:
            columns = [batch.column(k).to_pylist() for k in range(6)]
            hashed = (s for part in text_slices(batch.column(6), SLICE) for s in shingle_sets(part, words))
            for h, yb, xb, role, doc, k1, s in zip(*columns, hashed):
                if (h, yb, xb) != current:
                    yield flush()
                    current, sets, sides = (h, yb, xb), {}, ([], [])
                one = doc, k1  # there may be other texts under the same id
                if one not in sets:
                    if not len(s) or digest(s)[0] != k1:
                        continue
                    sets[one] = np.sort(by_frequency(s, classes.value))
                for side in (0, 1):
                    if role in (side, 2) and (not sides[side] or sides[side][-1] != one):
                        sides[side].append(one)
            del batch, columns, hashed
            release()
        yield flush()
        sets.clear()
        release()

    with small_batches(docs.sparkSession, WALK_ROWS):
        return store(texts.mapInArrow(run, "a long, b long"))


def join(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One row per row of docs: doc_id, n_shingles, and component_id, the smallest id that links lead to.

    Two documents link when 100 * intersection >= percent * union of their n-gram sets. Texts without words, null
    ones included, link with nothing. Rows of one id and text are one document. A row without an id takes the
    component of its copies that have one, else null.
    """
    value = F.col(text)
    texts = docs.select(F.col(doc_id).cast("long").alias("id"), value.alias("value"))
    sets, classes = count_sets(texts, words)
    hashing = Hashing(words, percent, docs.sparkSession.sparkContext.broadcast(classes))
    named = sets.filter("n > 0 and id is not null")
    first = store(named.groupBy("k1", "k2").agg(F.min("id").alias("id")))
    copies = named.select("id").distinct().join(first.select("id"), "id", "left_anti")
    texts = texts.filter("id is not null and value is not null")
    sketch = per_text(lambda part: sketches(part, words, percent, hashing.classes.value), SKETCH, SLICE)
    single = texts.join(_few(store(copies)), "id", "left_anti")
    with small_batches(docs.sparkSession):
        reps = store(single.select("id", sketch(F.col("value")).alias("s")).filter("s.n > 0").select("id", "s.*"))
    if reps.count() > first.count():  # repeated rows, or texts of which another id is the first
        reps = store(reps.dropDuplicates(["id", "k1", "k2"]).join(first, ["k1", "k2", "id"], "left_semi"))
    live = store(live_entries(reps, percent))
    key = reps.select("id", "k1")
    heavy = store(live.filter(F.col("c") > FREQUENT).drop("c").join(key, "id"))
    early, tied = star_links(heavy, reps, texts, hashing)
    pairs = candidate_pairs(live.filter(F.col("c") <= FREQUENT), reps, percent).select("x", "y")
    direct = None
    if not heavy.isEmpty():
        between_components = heavy_candidates(_with_component(heavy, tied), reps, percent)
        pairs = pairs.unionByName(between_components.filter("y is not null").select("x", "y"))
        direct = between_components.filter("y is null").select("g1", "g2", "g3", "role", F.col("x").alias("id")).distinct()
    members = pair_cells(store(_untied(pairs, tied).distinct()), reps)
    if direct is not None:
        members = members.unionByName(direct)
    late = walk(members.join(key, "id"), texts, hashing)
    found = components(late if early is None else early.unionByName(late))
    tops = first.join(found, F.col("id") == F.col("node"), "left").select("k1", "k2", F.coalesce("component", "id").alias("component"))
    out = sets.join(tops, ["k1", "k2"], "left")
    return out.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.coalesce("component", "id").alias("component_id"))


def keep_first(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", words: int = 5, percent: int = 80) -> DataFrame:
    """The documents that are the first (smallest id) of their component.

    Of rows with the same id and text one stays. Rows without an id link with nothing here: each text of theirs stays once.
    Texts are not shuffled for it while the ids that go, and those on several rows, are few enough to broadcast.
    """
    own, hashed = fresh("_own", docs.columns), fresh("_text", docs.columns)
    found = store(join(docs, text, doc_id, words, percent))
    gone = _few(found.filter("doc_id <> component_id").select(F.col("doc_id").alias(own)).distinct())
    again = store(found.groupBy(F.col("doc_id").alias(own)).agg(F.count("*").alias("n")).filter(f"n > 1 or {own} is null").select(own))
    kept = docs.join(gone, F.col(doc_id) == F.col(own), "left_anti")
    if again.isEmpty():
        return kept
    same = F.col(doc_id).eqNullSafe(F.col(own))
    single, several = kept.join(_few(again), same, "left_anti"), kept.join(_few(again), same, "left_semi")
    return single.unionByName(several.withColumn(hashed, F.xxhash64(text)).dropDuplicates([doc_id, hashed]).drop(hashed))


def _few(ids: DataFrame) -> DataFrame:
    """Ids with a broadcast hint if there are at most MOST_IDS."""
    return F.broadcast(ids) if ids.count() <= MOST_IDS else ids


@query("op1_ngram_join")
def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join(table(spark, sf_dir, "documents").select("doc_id", "text"))
