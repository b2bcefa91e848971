"""Merkle manifest of a dataset as a content-addressed graph, and proofs by descent from its root.

Every row is a leaf digest. Leaves of one group, ordered, form a binary tree; the groups' roots, ordered by group,
form one more above them. The manifest stores digest-to-children records: a record's digest names a node, and the
record lists that node's descendants level by level for DIGIT_BITS levels, so that a tree over 10^11 leaves is eight
records deep. A request names a leaf by group and rank. It descends from the root: at every record the next digit of
the rank (DIGIT_BITS binary digits) selects a descendant, the unselected children beside the way are collected, and
the selected digest names the next record. Requests that share a way share its rows until they part. The path was
collected from the root down, so its segments are reversed at last, to run from the leaf to the root.

Everything is a DataFrame function: leaves are digested beside the text, and only digests are sorted and shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fingertrail.llm.catalog import query
from fingertrail.llm.common import table
from fingertrail.session import store

#: Binary levels in one record: a record has at most 2^DIGIT_BITS descendants in its lowest level.
DIGIT_BITS = 5
#: Groups whose facts may be broadcast; more are joined by a shuffle.
MOST_GROUPS = 100_000

#: Type of a path: the siblings of each level, none where a node is alone in its run.
WAY = "array<struct<left:string,right:string>>"

LEAF_COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def encoded(value: Column) -> Column:
    """A value as its UTF-8 byte count, a colon and itself; null as a hyphen."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(values: Sequence[Column]) -> Column:
    """SHA-256 in lowercase hex over the encoded values."""
    return F.sha2(F.concat(*[encoded(v) for v in values]), 256)


def node_digest(children: Column) -> Column:
    """Digest of an array of child digests, as text one after the other; nulls are no children."""
    return F.sha2(F.concat_ws("", children), 256)


@dataclass
class Manifest:
    """`leaves`: group, rank, digest and the payload; `groups`: group, place among the groups, size, digest.

    `records[tree, tier]`: digest and levels (the digest's descendants, highest level first) of the trees of groups
    ("group") and of the tree above them ("top"); tier 0 is the lowest.
    """
    root: str | None
    leaves: DataFrame
    groups: DataFrame
    records: dict[tuple[str, int], DataFrame] = field(default_factory=dict)

    def write(self, path: str) -> None:
        """Store the manifest as tables: records by tree and tier, leaves, groups."""
        for (tree, tier), records in self.records.items():
            records.write.parquet(f"{path}/records/tree={tree}/tier={tier}")
        self.leaves.write.parquet(f"{path}/leaves")
        self.groups.write.parquet(f"{path}/groups")


def ranked(nodes: DataFrame, order: Sequence[str]) -> DataFrame:
    """Adds rank (from 0) and size of the group; nodes have a column group and are ordered by the order columns.

    Rows are dealt by ranges of all sort columns and a number that tells equal rows apart, so that no group, id or
    repeated row fills a task; a row's place in its part is known from the sort, and the parts' counts give the rest.
    """
    numbered = store(nodes.withColumn("_tie", F.monotonically_increasing_id()))
    sort = [F.col("group").asc_nulls_first(), *[F.col(c).asc_nulls_first() for c in order], F.col("_tie")]
    parts = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = store(numbered.repartitionByRange(parts, *sort).sortWithinPartitions(*sort)
                   .withColumn("_at", F.monotonically_increasing_id()).drop("_tie"))
    placed = placed.withColumn("_part", F.shiftright("_at", 33))
    counts = placed.groupBy("group", "_part").agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    group = Window.partitionBy("group").orderBy("_part")  # a row per part at most, not per leaf
    starts = store(counts.select(
        F.col("group").alias("_group"), F.col("_part").alias("_own"), F.col("_first"),
        (F.sum("_n").over(group.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_n")).alias("_before"),
        F.sum("_n").over(Window.partitionBy("group")).alias("size")))
    small = F.broadcast(starts) if starts.count() <= MOST_GROUPS else starts
    same = F.col("group").eqNullSafe(F.col("_group")) & (F.col("_part") == F.col("_own"))
    return (placed.join(small, same).withColumn("rank", F.col("_before") + F.col("_at") - F.col("_first"))
            .drop("_at", "_part", "_group", "_own", "_first", "_before"))


def levels_of(size: Column) -> Column:
    """Binary levels above so many leaves: the bits of the highest rank."""
    return F.when(size <= 1, F.lit(0)).otherwise(F.length(F.bin(size - 1)))


def tiers_of(size: int) -> int:
    """Records on the way from a root down to a leaf."""
    return max(1, -(-max(size - 1, 0).bit_length() // DIGIT_BITS))


def trees(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Records of each tier over the nodes (group, rank, size, digest), and each group's root (group, size, digest).

    A tier groups 2^DIGIT_BITS neighbouring ranks at a time, so rows fall by that factor from tier to tier.
    """
    largest = nodes.agg(F.max("size")).first()[0] or 0
    tiers, roots = [], []
    current = nodes.select("group", "rank", "size", "digest")
    for tier in range(tiers_of(largest)):
        low = tier * DIGIT_BITS
        block = F.shiftright("rank", DIGIT_BITS)
        grouped = current.groupBy("group", "size", block.alias("block")).agg(
            F.array_sort(F.collect_list(F.struct("rank", "digest"))).alias("own"))  # at most 2^DIGIT_BITS
        rows = grouped.select("group", "size", "block", F.col("own.digest").alias("l0"))
        for k in range(1, DIGIT_BITS + 1):
            below = F.col(f"l{k - 1}")
            above = F.transform(F.sequence(F.lit(0), F.floor((F.size(below) - 1) / 2).cast("int")),
                                lambda i: node_digest(F.array(F.get(below, 2 * i), F.get(below, 2 * i + 1))))  # noqa: B023
            rows = rows.withColumn(f"l{k}", F.when(levels_of(F.col("size")) >= low + k, above))
        levels = F.filter(F.array(*[F.col(f"l{k}") for k in range(DIGIT_BITS, -1, -1)]), lambda x: x.isNotNull())
        rows = store(rows.select("group", "size", "block", levels.alias("levels"))
                     .withColumn("digest", F.get(F.get("levels", 0), 0)))
        tiers.append(rows.select("digest", "levels"))
        done = levels_of(F.col("size")) <= low + DIGIT_BITS
        roots.append(rows.filter(done).select("group", "size", "digest"))
        current = rows.filter(~done).select("group", F.col("block").alias("rank"), "size", "digest")
    return tiers, reduce(DataFrame.unionByName, roots)


def build(leaves: DataFrame, order: Sequence[str] = ("key", "digest")) -> Manifest:
    """The manifest of a table of leaves: group, key, digest, and any payload columns.

    Leaves of a group ascend by the order columns, nulls first; leaves equal in all of them have equal digests, so
    their order decides nothing. An empty table has no root.
    """
    placed = store(ranked(leaves, order))
    own, roots = trees(placed)
    groups = store(ranked(roots.select(F.lit(0).alias("group"), F.col("group").alias("name"), F.col("size").alias("leaves"), "digest"), ["name"]))
    above, root = trees(groups)
    top = root.first()
    records = {("group", t): r for t, r in enumerate(own)} | {("top", t): r for t, r in enumerate(above)}
    named = groups.select(F.col("name").alias("group"), F.col("rank").alias("place"), F.col("leaves").alias("size"), "digest")
    return Manifest(top["digest"] if top else None, placed, store(named), records)


def _siblings(at: Column, levels: Column) -> Column:
    """The unselected children beside the way to place `at` of the lowest level, highest level first.

    One struct(left, right) per level; a node alone in its run has neither.
    """
    def beside(k: Column) -> Column:
        own, level = F.expr("1").cast("int"), F.get(levels, k)
        place = F.call_function("shiftright", at, F.size(levels) - 1 - k)
        odd = place.bitwiseAND(own) == 1
        return F.struct(F.when(odd, F.get(level, place - 1)).alias("left"),
                        F.when(~odd, F.get(level, place + 1)).alias("right"))
    return F.when(F.size(levels) > 1, F.transform(F.sequence(F.lit(1), F.size(levels) - 1), beside)).otherwise(
        F.array().cast(WAY))


def _step(frontier: DataFrame, records: DataFrame) -> DataFrame:
    """The frontier (digest, way, ...) with the levels that its digests name; equal digests name one record."""
    return frontier.join(records.dropDuplicates(["digest"]), "digest")


def _descend(frontier: DataFrame, records: DataFrame, wanted: DataFrame | None) -> DataFrame:
    """One record further for each (group, prefix, digest, way), to the prefixes that are wanted (all, without any)."""
    low = F.get("levels", F.size("levels") - 1)
    rows = _step(frontier, records).select("group", "prefix", "way", "levels", F.posexplode(low).alias("at", "next"))
    rows = rows.select("group", F.shiftleft("prefix", DIGIT_BITS).bitwiseOR(F.col("at").cast("long")).alias("prefix"),
                       F.col("next").alias("digest"), F.concat("way", _siblings(F.col("at"), F.col("levels"))).alias("way"))
    if wanted is None:
        return rows
    want = wanted.select(F.col("group").alias("_group"), F.col("prefix").alias("_prefix"))
    return rows.join(want, rows["group"].eqNullSafe(want["_group"]) & (rows["prefix"] == want["_prefix"]), "left_semi")


def prove(manifest: Manifest, requests: DataFrame) -> DataFrame:
    """Requests (group, rank, any other columns) with `path`: struct(left, right) of each level from leaf to root.

    A request for a group or rank that the manifest has not returns no row. Only requests and digests are shuffled;
    paths are put together where the last record meets the requests.
    """
    if manifest.root is None:
        return requests.withColumn("path", F.array().cast(WAY)).limit(0)
    frontier = requests.sparkSession.createDataFrame([(0, 0, manifest.root, [])], f"group int, prefix long, digest string, way {WAY}")
    top = sorted((t for tree, t in manifest.records if tree == "top"), reverse=True)
    for tier in top:
        frontier = _descend(frontier, manifest.records["top", tier], None)
    way = frontier.select(F.col("prefix").alias("place"), "way")
    facts = manifest.groups.join(way, "place")  # a row per group
    entry = F.greatest(F.lit(0), F.ceil(levels_of(F.col("size")) / DIGIT_BITS).cast("int") - 1)
    facts = store(facts.select("group", F.lit(0).cast("long").alias("prefix"), "digest", "way", entry.alias("entry")))
    tiers = max(t for tree, t in manifest.records if tree == "group")
    wanted = [requests.select("group", F.shiftright("rank", DIGIT_BITS).alias("prefix")).distinct()]
    for _ in range(1, tiers):
        wanted[0] = store(wanted[0]) if len(wanted) == 1 else wanted[0]
        wanted.append(wanted[-1].select("group", F.shiftright("prefix", DIGIT_BITS).alias("prefix")).distinct())
    enter = lambda t: facts.filter(F.col("entry") == t).drop("entry")
    frontier = enter(tiers)
    for tier in range(tiers, 0, -1):
        frontier = enter(tier - 1).unionByName(_descend(frontier, manifest.records["group", tier], wanted[tier - 1]))
    last = _step(frontier, manifest.records["group", 0]).select(
        F.col("group").alias("_group"), F.col("prefix").alias("_prefix"), "way", "levels")
    at = F.col("rank").bitwiseAND(F.lit((1 << DIGIT_BITS) - 1)).cast("int")
    met = requests.join(last, F.col("group").eqNullSafe(F.col("_group")) & (F.shiftright("rank", DIGIT_BITS) == F.col("_prefix")))
    met = met.filter(at < F.size(F.get("levels", F.size("levels") - 1)))
    path = F.reverse(F.concat("way", _siblings(at, F.col("levels"))))
    return met.withColumn("path", path).drop("_group", "_prefix", "way", "levels")


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path lead to."""
    return F.aggregate(path, leaf, lambda own, step: node_digest(F.array(step["left"], own, step["right"])))


def siblings_digest(path: Column) -> Column:
    """Digest of all siblings of a path, from leaf to root."""
    return node_digest(F.transform(path, lambda step: F.coalesce(step["left"], step["right"])))


def document_leaves(docs: DataFrame) -> DataFrame:
    """Leaves of a documents table, grouped by lang and keyed by doc_id, with the leaf of a tampered copy.

    Where 7 divides the CRC-32 of the id, the copy has one character more in n_chars; nulls stay. Rows without an id
    come first in their group and are not tampered with. Other columns of the table take no part.
    """
    own = [F.col(c) for c in LEAF_COLUMNS]
    picked = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    other = [F.try_add(F.col("n_chars"), F.lit(1)) if c == "n_chars" else F.col(c) for c in LEAF_COLUMNS]
    return docs.select(F.col("lang").alias("group"), F.col("doc_id").cast("long").alias("key"), leaf_digest(own).alias("digest"),
                       F.when(picked, leaf_digest(other)).alias("tampered"))


#: CRC-32 of the id's decimal digits, bit by bit from the lowest; the polynomial is that of the usual checksum.
_BITS = """list_transform(range(8 * length(doc_id::VARCHAR)),
    lambda i: ((ascii(substr(doc_id::VARCHAR, (i // 8 + 1)::INT, 1)) >> (i % 8)::INT) & 1)::UBIGINT)"""
_CRC = f"""xor(4294967295::UBIGINT, list_reduce(list_prepend(4294967295::UBIGINT, {_BITS}),
    lambda c, b: CASE WHEN xor(c & 1, b) = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END))"""


def _sql() -> str:
    def leaf(n_chars: str) -> str:
        parts = [f"coalesce(strlen({c}::VARCHAR)::VARCHAR || ':' || {c}::VARCHAR, '-')" for c in ("doc_id", "source", "lang", n_chars, "text")]
        return f"sha256({' || '.join(parts)})"

    return f"""
WITH RECURSIVE own AS (
  SELECT doc_id, lang, {leaf('n_chars')} AS leaf, CASE WHEN {_CRC} % 7 = 0 THEN {leaf('(n_chars + 1)')} END AS tampered,
    row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST) - 1 AS rank
  FROM documents),
tree(lang, level, place, digest) AS (
  SELECT lang, 0, rank, leaf FROM own
  UNION ALL
  SELECT t.lang, t.level + 1, t.place // 2, sha256(t.digest || coalesce(r.digest, ''))
  FROM tree t LEFT JOIN tree r ON t.lang IS NOT DISTINCT FROM r.lang AND r.place = t.place + 1
  WHERE t.place % 2 = 0 AND (t.place > 0 OR r.digest IS NOT NULL)),
heads AS (SELECT lang, max_by(digest, level) AS subroot, max(level) AS height FROM tree GROUP BY lang),
placed AS (SELECT *, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS rank FROM heads),
top(level, place, digest) AS (
  SELECT 0, rank, subroot FROM placed
  UNION ALL
  SELECT t.level + 1, t.place // 2, sha256(t.digest || coalesce(r.digest, ''))
  FROM top t LEFT JOIN top r ON r.place = t.place + 1
  WHERE t.place % 2 = 0 AND (t.place > 0 OR r.digest IS NOT NULL)),
root AS (SELECT max_by(digest, level) AS root, max(level) AS height FROM top),
walk(doc_id, lang, leaf, rank, level, place, above, folded, proof) AS (
  SELECT o.doc_id, o.lang, leaf, o.rank, 0, o.rank, FALSE, coalesce(tampered, leaf), '' FROM own o
  UNION ALL
  SELECT w.doc_id, w.lang, w.leaf, w.rank,
    CASE WHEN NOT w.above AND w.level = h.height THEN 0 ELSE w.level + 1 END,
    CASE WHEN NOT w.above AND w.level = h.height THEN h.rank ELSE w.place // 2 END,
    w.above OR w.level = h.height,
    CASE WHEN NOT w.above AND w.level = h.height THEN w.folded
         WHEN w.place % 2 = 1 THEN sha256(coalesce(s.digest, p.digest, '') || w.folded)
         ELSE sha256(w.folded || coalesce(s.digest, p.digest, '')) END,
    CASE WHEN NOT w.above AND w.level = h.height THEN w.proof ELSE w.proof || coalesce(s.digest, p.digest, '') END
  FROM walk w JOIN placed h ON w.lang IS NOT DISTINCT FROM h.lang
  CROSS JOIN root
  LEFT JOIN tree s ON NOT w.above AND w.level < h.height AND s.lang IS NOT DISTINCT FROM w.lang AND s.level = w.level
    AND s.place = xor(w.place, 1)
  LEFT JOIN top p ON w.above AND p.level = w.level AND p.place = xor(w.place, 1)
  WHERE NOT (w.above AND w.level = root.height))
SELECT w.doc_id, w.leaf, h.subroot, root.root, sha256(w.proof) AS proof_sha256, w.folded AS folded_root, w.folded = root.root AS verified
FROM walk w JOIN placed h ON w.lang IS NOT DISTINCT FROM h.lang CROSS JOIN root
WHERE w.above AND w.level = root.height"""


@query("op11_merkle_manifest", _sql())
def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = build(document_leaves(table(spark, sf_dir, "documents")))
    requests = manifest.leaves.select("group", "rank", F.col("key").alias("doc_id"), F.col("digest").alias("leaf"), "tampered")
    heads = manifest.groups.select(F.col("group").alias("_lang"), F.col("digest").alias("subroot"))
    heads = F.broadcast(heads) if heads.count() <= MOST_GROUPS else heads
    proved = prove(manifest, requests).join(heads, F.col("group").eqNullSafe(F.col("_lang")))
    root = F.lit(manifest.root)
    return proved.select(
        "doc_id", "leaf", "subroot", root.alias("root"), siblings_digest(F.col("path")).alias("proof_sha256"),
        folded(F.coalesce("tampered", "leaf"), F.col("path")).alias("folded_root")).withColumn(
        "verified", F.col("folded_root") == F.col("root"))
