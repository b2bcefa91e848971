import hashlib
import math
import random
import zlib

import numpy as np
import pytest

from fingertrail.llm import op11_merkle_manifest as merkle
from fingertrail.llm import op12_vector_codes as codes
from fingertrail.llm import op13_embedding_dedup as near
from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf_of(doc_id, text, lang, source, n_chars):
    return sha(*map(field, (doc_id, source, lang, n_chars, text)))


def up(level):
    return [sha(*level[i:i + 2]) for i in range(0, len(level), 2)]


def brute_manifest(rows):
    """{(doc_id, leaf): (subroot, root, proof, folded, verified)} by plain lists of levels."""
    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append(row)
    trees = {}
    for lang, members in groups.items():
        members.sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(*r)))
        levels = [[leaf_of(*r) for r in members]]
        while len(levels[-1]) > 1:
            levels.append(up(levels[-1]))
        trees[lang] = levels
    order = sorted(trees, key=lambda lang: (lang is not None, (lang or "").encode()))
    top = [[trees[lang][-1][0] for lang in order]]
    while len(top[-1]) > 1:
        top.append(up(top[-1]))
    out = []
    for place, lang in enumerate(order):
        for rank, row in enumerate(groups[lang]):
            leaf, proof = leaf_of(*row), []
            picked = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0
            own = leaf_of(*row[:4], row[4] + 1 if row[4] is not None else None) if picked else leaf
            for levels, at in ((trees[lang], rank), (top, place)):
                for level in levels[:-1]:
                    beside = level[at ^ 1] if at ^ 1 < len(level) else ""
                    proof.append(beside)
                    own = sha(beside, own) if at % 2 else sha(own, beside)
                    at //= 2
            out.append((row[0], leaf, trees[lang][-1][0], top[-1][0], sha(*proof), own, own == top[-1][0]))
    return sorted(out, key=str)


def proofs(spark, docs):
    manifest = merkle.build(merkle.document_leaves(docs))
    heads = manifest.groups.select(F.col("group").alias("g"), F.col("digest").alias("subroot"))
    got = merkle.prove(manifest, manifest.leaves).join(heads, F.col("group").eqNullSafe(F.col("g")))
    own = merkle.folded(F.coalesce("tampered", "digest"), F.col("path"))
    return sorted((tuple(r) for r in got.select(
        "key", "digest", "subroot", F.lit(manifest.root), merkle.siblings_digest(F.col("path")), own, own == F.lit(manifest.root)).collect()), key=str)


@pytest.mark.parametrize("sizes", [[1], [2], [3], [33], [1, 1, 1], [1, 32, 70], [5, 1100]])
def test_manifest_equals_plain_levels(spark, sizes):
    rng = random.Random(sum(sizes))
    rows = []
    for lang, n in enumerate(sizes):
        for _ in range(n):
            rows.append((rng.randrange(10**6), rng.choice(["", "a b", "Ünï ☃", "x" * 3000]), [None, "de", "en"][lang], rng.choice([None, "s"]), rng.choice([None, 7])))
    assert proofs(spark, spark.createDataFrame(rows, DOCS)) == brute_manifest(rows)


def test_manifest_of_odd_rows(spark):
    row = (14, "same", "en", "s", 4)
    rows = [row] * 70 + [(None, None, None, None, None), (None, "t", "en", None, 1), (2**63 - 1, "t", "zz", "", 2**40)]
    got = proofs(spark, spark.createDataFrame(rows, DOCS).withColumns({"digest": F.lit("own"), "rank": F.lit(1), "group": F.lit("x")}))
    assert got == brute_manifest(rows)


def test_manifest_of_no_rows_and_requests_for_some(spark, tmp_path):
    empty = merkle.build(merkle.document_leaves(spark.createDataFrame([], DOCS)))
    assert empty.root is None and merkle.prove(empty, empty.leaves).count() == 0
    rows = [(i, str(i), "en" if i % 3 else "de", "s", i) for i in range(500)]
    manifest = merkle.build(merkle.document_leaves(spark.createDataFrame(rows, DOCS)))
    asked = spark.createDataFrame([("en", 0, "a"), ("en", 0, "b"), ("de", 166, "c"), ("de", 167, "d"), ("en", 332, "e"), ("fr", 0, "f")],
                                  "group string, rank long, way string")
    got = merkle.prove(manifest, asked.withColumnRenamed("way", "who"))
    assert sorted(r["who"] for r in got.collect()) == ["a", "b", "c", "e"]
    digests = manifest.leaves.select("group", "rank", "digest")
    folded = got.join(digests, ["group", "rank"]).select(merkle.folded(F.col("digest"), F.col("path"))).distinct().collect()
    assert [r[0] for r in folded] == [manifest.root]
    manifest.write(str(tmp_path / "manifest"))
    assert spark.read.parquet(str(tmp_path / "manifest/leaves")).count() == 500
    stored = spark.read.parquet(str(tmp_path / "manifest/records"))
    assert stored.filter("tree = 'group' and tier = 0").agg(F.sum(F.size(F.element_at("levels", -1)))).first()[0] == 500


def brute_codes(rows, parts=4, entries=256, rounds=4):
    kept = sorted((i, [math.floor(1024 * x) for x in v]) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v))
    width = len(kept[0][1]) // parts
    cut = [[v[p * width:(p + 1) * width] for p in range(parts)] for _, v in kept]
    books = [[list(c[p]) for c in cut[:entries]] for p in range(parts)]

    def nearest(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), e) for e, c in enumerate(books[p]))

    for _ in range(rounds):
        for p in range(parts):
            members = {}
            for c in cut:
                members.setdefault(nearest(p, c[p])[1], []).append(c[p])
            for e, own in members.items():
                books[p][e] = [sum(column) // len(own) for column in zip(*own)]
    out = []
    for (i, _), c in zip(kept, cut):
        found = [nearest(p, c[p]) for p in range(parts)]
        out.append((i, "".join(f"{e:02x}" for _, e in found), sum(d for d, _ in found)))
    text = ",".join(str(x) for book in books for c in book for x in c)
    return sorted(out), hashlib.sha256(text.encode()).hexdigest()


def compressed(spark, rows, **more):
    df = spark.createDataFrame([(i, v, 1, "c", 0.5) for i, v in rows], "vec_id long, embedding array<double>, label int, code string, low double")
    got = codes.compress(df, keep=("vec_id", "label", "code"), **more)
    assert got.rows.columns == ["vec_id", "label", "code", "code_", "error"]
    return sorted(tuple(r) for r in got.rows.select("vec_id", got.hex(), "error").collect()), got.sha256()


@pytest.mark.parametrize("seed, spread, entries", [(1, 0.3, 256), (2, 0.004, 40), (3, 40.0, 70), (4, 2.0**20, 40)])
def test_codes_equal_plain_rounds(spark, seed, spread, entries):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(30, 8)) * spread
    rows = [(int(i), (centres[rng.integers(30)] + rng.normal(size=8) * spread / 20).tolist()) for i in rng.permutation(600)]
    rows += [(700 + k, rows[0][1]) for k in range(40)] + [(800, None), (801, [None] * 8), (802, [math.nan] * 8), (803, [math.inf] * 8)]
    assert compressed(spark, rows, entries=entries) == brute_codes(rows, entries=entries)


def test_codes_of_few_or_no_vectors(spark):
    rows = [(5, [0.1, -0.2, 0.3, 0.4]), (2, [0.1, -0.2, 0.3, 0.4]), (9, [-1.0, 1.0, 0.0, 0.5])]
    assert compressed(spark, rows) == brute_codes(rows)
    assert compressed(spark, [(1, None), (2, [])]) == ([], hashlib.sha256(b"").hexdigest())
    assert [r[0] for r in compressed(spark, [*rows, (11, [1.0, 2.0])])[0]] == [2, 5, 9]


def test_label_errors_join_nulls(spark):
    df = spark.createDataFrame([(1, None, 4), (2, None, 5), (3, 7, 1)], "vec_id long, label int, error long")
    got = codes.with_label_error(df, "label", "error", "label_error")
    assert sorted((r["vec_id"], r["label_error"]) for r in got.collect()) == [(1, 9), (2, 9), (3, 1)]


def test_bounds_spare_scans_and_use_the_true_displacement():
    rng = np.random.default_rng(5)
    x = np.floor(1024 * (rng.normal(size=(20, 16))[rng.integers(20, size=4000)] + rng.normal(size=(4000, 16)) * 0.05)).astype(np.int64)
    history, code = [[x[:128].copy()]], None
    low, stamp = np.zeros((4000, 4), np.float32), np.zeros((4000, 4), np.int8)
    for _ in range(5):
        assigner = codes.Assigner(history)
        code, distance = assigner.part(0, x, code, low, stamp)
        exact = codes.squared(x, history[-1][0])
        assert (code == exact.argmin(1)).all() and (distance == exact.min(1)).all()
        history.append([np.array([x[code == e].sum(0) // max(1, (code == e).sum()) if (code == e).any() else history[-1][0][e] for e in range(128)])])
    assert assigner.scans < 0.8 * assigner.possible
    drift = sum(np.sqrt(((b[0] - a[0]) ** 2).sum(1)) for a, b in zip(history[:-2], history[1:-1]))
    net = np.sqrt(((history[-2][0] - history[0][0]) ** 2).sum(1))
    assert (net <= drift + 1e-6).all() and net.sum() < 0.95 * drift.sum()


def brute_near(rows, cosine=0.98):
    """(vec_id, links, component, kept) of each row, rows told apart by place."""
    def good(v, label):
        return label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)

    units = [np.array(v) / np.linalg.norm(v) if good(v, label) else None for _, v, label in rows]
    n = len(rows)
    links, root = [0] * n, list(range(n))

    def top(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in range(n):
        for b in range(a):
            u, v = units[a], units[b]
            if u is not None and v is not None and rows[a][2] == rows[b][2] and len(u) == len(v) and u @ v >= cosine:
                links[a] += 1
                links[b] += 1
                root[top(a)] = top(b)
    least = {}
    for k in range(n):
        if rows[k][0] is not None:
            least[top(k)] = min(least.get(top(k), rows[k][0]), rows[k][0])
    return sorted(((i, links[k], least.get(top(k)), i is not None and i == least.get(top(k))) for k, (i, _, _) in enumerate(rows)), key=str)


def found(spark, rows, **more):
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<double>, label int, cls int, component string")
    return sorted(map(tuple, near.near_duplicates(df, **more).collect()), key=str)


def groups_of(seed, noise=0.012):
    rng = np.random.default_rng(seed)
    rows = []
    for label in (1, 2):
        for size in (90, 7, 2, 1, 1, 1, 1):
            centre = rng.normal(size=24)
            for _ in range(size):
                rows.append((len(rows), (centre + noise * np.linalg.norm(centre) / 5 * rng.normal(size=24)).tolist(), label))
    order = rng.permutation(len(rows))
    return [rows[k] for k in order]


@pytest.mark.parametrize("window, block, parts", [(32, 512, 50_000), (4, 16, 9), (3, 40, 2)])
def test_links_equal_brute_force_over_borders_and_blocks(spark, monkeypatch, window, block, parts):
    rows = groups_of(window)
    monkeypatch.setattr(near, "BLOCK", block)
    monkeypatch.setattr(near, "PART_ROWS", parts)
    assert found(spark, rows, window=window) == brute_near(rows)


def test_defined_vectors(spark):
    v = [1.0, 2.0, -0.5]
    rows = [(1, v, 1), (2, [2.0, 4.0, -1.0], 1), (3, v, 2), (4, v, None), (5, None, 1), (6, [], 1), (7, [0.0, 0.0, 0.0], 1), (8, [1.0, None, 2.0], 1),
            (9, [math.nan, 1.0, 1.0], 1), (10, [math.inf, 1.0, 1.0], 1), (11, [1.0, 2.0, -0.5, 0.0], 1), (1, v, 1), (None, v, 1), (None, [9.0, 0.0, 0.0], 1),
            (20, [1e-200, 2e-200, -5e-201], 1), (21, [0.0, 1.0, 0.0], 3), (22, [-0.0, 1.0, -0.0], 3)]
    unit = [(i, None if w is None or not any(x for x in w if x) else [x * 1e200 if abs(x or 0) < 1e-100 else x for x in w] if all(x is not None for x in w) else w, label)
            for i, w, label in rows]
    assert found(spark, rows) == brute_near(unit)
    assert found(spark, []) == []


def test_passes_follow_the_number_of_classes():
    assert near.passes_for(10) == near.FEWEST
    counts = [near.passes_for(n) for n in (10**3, 10**5, 10**7)]
    assert counts == sorted(counts) and counts[0] < counts[-1] <= near.MOST
