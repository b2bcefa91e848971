import os
import random
import re
import tracemalloc

import numpy as np
import pytest

from fingertrail.llm import common
from fingertrail.llm import components as cc
from fingertrail.llm import op1_ngram_join as op

SCHEMA = "doc_id long, text string"


def words_of(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", low)


def grams(text, k):
    w = words_of(text)
    return {tuple(w[i:i + k]) for i in range(max(len(w) - k + 1, min(len(w), 1)))}


def brute(rows, k, percent):
    sets = {}
    for i, text in rows:
        if i is not None:
            sets.setdefault((i, text), grams(text, k))
    up = {}

    def top(v):
        while up.get(v, v) != v:
            v = up[v]
        return v

    items = list(sets.items())
    for n, ((a, _), s) in enumerate(items):
        for (b, _), t in items[:n]:
            if s and t and 100 * len(s & t) >= percent * len(s | t):
                x, y = top(a), top(b)
                up[max(x, y)] = min(x, y)
    return {(i, len(s), top(i)) for (i, _), s in sets.items()}


def near_copies(seed, groups=6, copies=12, length=60):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(400)]
    rows, doc_id = [], 0
    for _ in range(groups):
        base = rng.choices(vocabulary, k=rng.randint(5, length))
        for _ in range(copies):
            w = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 4])):
                w[rng.randrange(len(w))] = rng.choice(vocabulary)
            rows.append((doc_id, rng.choice([" ", "\n", "\t"]).join(w)))
            doc_id += rng.randint(1, 3)
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("words, percent", [(3, 90), (5, 80), (1, 60)])
def test_components_equal_brute_force(spark, words, percent):
    rows = near_copies(words)
    got = op.join(spark.createDataFrame(rows, SCHEMA), words=words, percent=percent).collect()
    assert {tuple(r) for r in got} == brute(rows, words, percent)


def test_frequent_hashes_and_small_blocks_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(op, "FREQUENT", 1)
    monkeypatch.setattr(op, "BLOCK", 3)
    monkeypatch.setattr(op, "MOST_IDS", 0)
    monkeypatch.setattr(op, "WIDE_FROM", 20)
    rows = near_copies(9, groups=4, copies=14, length=90)
    got = op.join(spark.createDataFrame(rows, SCHEMA), words=2, percent=80).collect()
    assert {tuple(r) for r in got} == brute(rows, 2, 80)


def test_defined_cases(spark):
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "One"), (5, "one"), (6, "one two"), (7, "ONE  two"), (None, "one two"),
            (8, "Éa b c d"), (9, "éa b c d"), (9, "éa b c d"), (None, "alone here now"), (10, "x " * 30000)]
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], SCHEMA + ", component_id string, k1 int")
    got = sorted(map(tuple, op.join(docs).collect()), key=str)
    assert got == sorted([(1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 1, 4), (5, 1, 4), (6, 1, 6), (7, 1, 6), (None, 1, 6),
                          (8, 2, 8), (9, 2, 9), (9, 2, 9), (None, 1, None), (10, 1, 10)], key=str)


def test_empty_table(spark):
    assert op.join(spark.createDataFrame([], SCHEMA)).count() == 0


def test_keep_first(spark):
    base = " ".join(f"w{k}" for k in range(100))
    docs = spark.createDataFrame([(5, base, 1, "a"), (3, base + " end", 2, "b"), (7, "other text", 3, "c"), (7, "other text", 3, "c"),
                                  (None, "free", 4, "d"), (8, None, 5, "e")], SCHEMA + ", _first int, _text string")
    got = op.keep_first(docs)
    assert got.columns == docs.columns
    assert sorted(r["_first"] for r in got.collect()) == [2, 3, 4, 5]


@pytest.mark.parametrize("seed", range(5))
def test_trie_finds_all_links(seed):
    rng = np.random.default_rng(seed)
    base = rng.integers(-1 << 62, 1 << 62, 80)
    sets = [np.unique(np.r_[rng.choice(base, rng.integers(50, 80), replace=False), rng.integers(-1 << 62, 1 << 62, rng.integers(0, 6))])
            for _ in range(60)]
    residents, probes = sets[:30], sets[20:]
    got = {(r, int(p)) for r, found in op.trie_links(residents, probes, 70) for p in found}
    want = {(i, j) for i, a in enumerate(residents) for j, b in enumerate(probes)
            if 100 * len(np.intersect1d(a, b)) >= 70 * len(np.union1d(a, b))}
    assert got == want


def test_connected_components(spark):
    edges = [(k, k + 1) for k in range(100, 130)] + [(1, 50), (50, 7), (7, 9), (200, 201), (201, 200), (5, 5)]
    got = {r["node"]: r["component"] for r in cc.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{k: 100 for k in range(100, 131)}, 1: 1, 50: 1, 7: 1, 9: 1, 200: 200, 201: 200}


def test_rows_sent_to_cells_grow_with_a_group_not_with_its_square(spark, monkeypatch):
    """A group of different near copies, several cells wide: what is sent doubles with it, and pairs are bounded."""
    monkeypatch.setattr(op, "BLOCK", 60)
    sent, walk = [], op.walk
    monkeypatch.setattr(op, "walk", lambda members, *a: sent.append(members.count()) or walk(members, *a))
    totals = []
    for n in (300, 600):
        base = [f"w{k}" for k in range(120)]
        rows = [(k, " ".join([*base[:40 + k % 60], f"own{k}", *base[40 + k % 60:]])) for k in range(n)]
        sent.clear()
        got = op.join(spark.createDataFrame(rows, SCHEMA)).collect()
        assert {r["component_id"] for r in got} == {0}
        totals.append(sum(sent))
    assert totals[1] < 2.6 * totals[0] and totals[1] < 20 * 600


def family(n, seed, own=6, length=120):
    """n different near copies, some of them too far from others to link, and texts that share a line with them only."""
    rng = random.Random(seed)
    base = [f"w{k}" for k in range(length)]
    rows = []
    for k in range(n):
        w = list(base)
        for _ in range(rng.randint(1, own)):
            w[rng.randrange(length)] = f"own{k}"
        rows.append((k, " ".join(w)))
    return rows + [(n + k, " ".join([*base[:30], *(f"other{k}n{j}" for j in range(90))])) for k in range(40)]


def test_texts_sent_do_not_grow_with_the_frequent_hashes_that_sets_share(spark, monkeypatch):
    """Near copies share many frequent hashes; each text goes to few cells all the same."""
    monkeypatch.setattr(op, "FREQUENT", 8)
    sent, walk = [], op.walk
    monkeypatch.setattr(op, "walk", lambda members, *a: sent.append(members.count()) or walk(members, *a))
    rows = family(200, 1)
    got = op.join(spark.createDataFrame(rows, SCHEMA), words=2, percent=80).collect()
    assert {tuple(r) for r in got} == brute(rows, 2, 80)
    assert sum(sent) < 6 * len(rows)


def test_cells_of_blocks_find_the_same_components(spark, monkeypatch):
    """Groups of candidates and cells wider than a block, without rounds that tie sets before."""
    monkeypatch.setattr(op, "BLOCK", 20)
    monkeypatch.setattr(op, "WIDER", 2)
    rows = family(150, 2)
    want = brute(rows, 2, 80)
    for frequent, rounds in ((4, 0), (4, 1), (1000, 3)):
        monkeypatch.setattr(op, "FREQUENT", frequent)
        monkeypatch.setattr(op, "ROUNDS", rounds)
        got = op.join(spark.createDataFrame(rows, SCHEMA), words=2, percent=80).collect()
        assert {tuple(r) for r in got} == want


def sketch_side(sets, ids, components, place, before):
    sketched = [op.parity_bitmap(s, 256 if len(s) < 30 else 512 if len(s) < 60 else 1024).view(np.uint64) for s in sets]
    return op.Sketches(np.array(ids), np.array([len(s) for s in sets]), np.array(place), np.array(before), np.array(before) == 0,
                       np.array(components), sketched)


@pytest.mark.parametrize("seed", range(4))
def test_cells_of_sketches_keep_all_links_between_components(seed, monkeypatch):
    """As pairs or as members of smaller cells; pairs of one component, and of one hash just before, are left out."""
    rng = np.random.default_rng(seed)
    base = rng.integers(1, 1 << 62, 70)
    sets = [np.unique(np.r_[rng.choice(base, rng.integers(20, 70), replace=False), rng.integers(1, 1 << 62, 2)]) for _ in range(80)]
    components, before = rng.integers(0, 6, 80), rng.integers(0, 4, 80)
    at = range(80)
    residents = sketch_side(sets[:50], at[:50], components[:50], [0] * 50, before[:50])
    probes = sketch_side(sets[30:], at[30:], components[30:], [0] * 50, before[30:])
    want = {(x, y) for x in at[30:] for y in at[:50] if components[x] != components[y] and (before[x] != before[y] or not before[x])
            and (len(sets[y]), y) < (len(sets[x]), x) and 100 * len(np.intersect1d(sets[x], sets[y])) >= 60 * len(np.union1d(sets[x], sets[y]))}
    assert want
    pairs = {(r["x"], r["y"]) for r in op.cell_candidates((1, 2, 3), residents, probes, 60).to_pylist()}
    assert want <= pairs and not any(components[x] == components[y] for x, y in pairs)
    monkeypatch.setattr(op, "PAIRS_EACH", 0)
    monkeypatch.setattr(op, "BLOCK", 16)
    monkeypatch.setattr(op, "PAIR_WORDS", 64)
    rows = op.cell_candidates((1, 2, 3), residents, probes, 60).to_pylist()
    cells = {}
    for r in rows:
        cells.setdefault((r["g1"], r["g2"], r["g3"]), (set(), set()))[r["role"]].add(r["x"])
    assert all(r["y"] is None for r in rows) and all(0 < len(side) <= 16 for sides in cells.values() for side in sides)
    assert {(x, y) for ys, xs in cells.values() for x in xs for y in ys} >= pairs


def test_texts_of_one_id_all_link(spark):
    base = [f"w{k}" for k in range(80)]
    rows = [(5, " ".join(base)), (9, " ".join([*base, "end"])), (9, " ".join(f"v{k}" for k in range(80))), (7, " ".join([*(f"v{k}" for k in range(80)), "end"]))]
    got = op.join(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {tuple(r) for r in got} == brute(rows, 3, 90)


def test_words_are_hashed_alike_in_any_chunk(monkeypatch):
    rng = random.Random(3)
    texts = ["", " \n", "a", "A b", "x" * 3000 + " y " + "x" * 3000 + " y z", "é É ß"] + [
        "".join(rng.choice("ab \n\té") for _ in range(rng.randint(0, 60))) for _ in range(200)]
    for k in (1, 3, 5):
        found = op.shingle_sets(texts, k)
        assert [len(s) for s in found] == [len(grams(t, k)) for t in texts]
        alike = {}
        for t, s in zip(texts, found):
            alike.setdefault(frozenset(grams(t, k)), set()).add(s.tobytes())
        assert all(len(v) == 1 for v in alike.values()) and len({x for v in alike.values() for x in v}) == len(alike)
    whole = [s.tobytes() for s in op.shingle_sets(texts, 3)]
    monkeypatch.setattr(op, "CHUNK_BYTES", 7)
    assert [op.shingle_sets([t], 3)[0].tobytes() for t in texts] == whole


def test_counting_touches_only_the_counters_of_its_sets():
    rng = np.random.default_rng(3)
    sets = [rng.integers(-1 << 62, 1 << 62, size, dtype=np.int64) for size in (0, 1, 500, 4000)]
    counts, expected = np.zeros(op.COUNTERS, "<u2"), np.zeros(op.COUNTERS, np.int64)
    counts[op.counter_of(sets[1])] = 65535
    expected[op.counter_of(sets[1])] = 65535
    tracemalloc.start()
    op.count_into(counts, sets)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    expected += np.bincount(op.counter_of(np.concatenate(sets)), minlength=op.COUNTERS)
    assert (counts == np.minimum(expected, 65535)).all()
    assert peak < 2_000_000  # a full table of counters takes 16 MB


@pytest.mark.skipif(not os.path.exists("/proc/self/smaps_rollup"), reason="needs Linux")
def test_release_gives_back_memory_between_what_stays():
    def held():
        return int(re.search(r"\nAnonymous: +(\d+)", open("/proc/self/smaps_rollup").read())[1])

    parts = [bytes(4000) for _ in range(25_000)]
    full = held()
    kept = parts[::100]
    del parts
    common.release()
    assert len(kept) == 250 and held() < full - 50_000


def test_members_reach_python_in_small_batches(spark, monkeypatch):
    seen = []
    small = op.small_batches
    monkeypatch.setattr(op, "small_batches", lambda session, rows=1_000: seen.append(rows) or small(session, rows))
    docs = spark.createDataFrame([(1, "a b c d"), (2, "a b c d e")], SCHEMA)
    op.join(docs, words=1, percent=50).collect()
    assert min(seen) <= 250
