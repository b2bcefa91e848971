"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics of whole texts are computed in Arrow batches; trees are grown on a bounded sample of labelled
rows, stored as complete binary trees in flat arrays and walked level by level for all rows of a batch.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fingertrail.llm.catalog import query
from fingertrail.llm.common import fresh, id_remainder, per_text, table

#: At most so many labelled rows are learned from, those with the smallest hash of their id.
SAMPLE_ROWS = 20_000
TREES, DEPTH, BINS, RATE, RIDGE = 60, 4, 64, 0.2, 1.0
THRESHOLD = 0.3

# Byte classes for character statistics.
CLASSES = {"upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "digit": b"0123456789", "space": b" \t\n\v\f\r", "stop": b".",
           "comma": b",;:", "shout": b"!?", "symbol": b"#*$%&<>", "pipe": b"|", "mark": b"@{}[]()=/\\_~^+`\"'-"}
_TABLE = np.zeros((256, len(CLASSES)))
for _k, _members in enumerate(CLASSES.values()):
    _TABLE[list(_members), _k] = 1
FEATURES = [*CLASSES, "non_ascii", "control", "log_bytes", "log_words", "word_bytes", "distinct_words", "top_word",
            "repeats", "distinct_pairs", "lines", "distinct_lines", "line_words", "entropy"]


def statistics(texts: list[str]) -> np.ndarray:
    """One row of statistics per text; an empty text has zeros."""
    out = np.zeros((len(texts), len(FEATURES)))
    for row, text in zip(out, texts):
        raw = text.encode("utf-8", "replace")
        if not raw:
            continue
        counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
        n, words = len(raw), raw.split()
        k = len(CLASSES)
        row[:k] = counts @ _TABLE / n
        row[k:k + 2] = counts[128:].sum() / n, (counts[:9].sum() + counts[14:32].sum()) / n
        share = counts[counts > 0] / n
        lines = [x for x in raw.split(b"\n") if x]
        w = max(len(words), 1)
        seen = Counter(words)
        row[k + 2:] = (np.log1p(n), np.log1p(len(words)), n / w, len(seen) / w,
                       max(seen.values(), default=0) / w, sum(map(bytes.__eq__, words, words[1:])) / w,
                       len(set(zip(words, words[1:]))) / w, len(lines) / w, len(set(lines)) / max(len(lines), 1),
                       np.log1p(w / max(len(lines), 1)), -(share * np.log2(share)).sum())
    return out


@dataclass
class Trees:
    """Complete trees of one depth: inner nodes in breadth-first order, then the values of the leaves."""
    feature: np.ndarray
    cut: np.ndarray
    leaf: np.ndarray
    start: float

    def score(self, x: np.ndarray) -> np.ndarray:
        total, rows = np.full(len(x), self.start), np.arange(len(x))
        depth = int(np.log2(self.leaf.shape[1]))
        for feature, cut, leaf in zip(self.feature, self.cut, self.leaf):
            node = np.zeros(len(x), dtype=np.int64)
            for _ in range(depth):
                node = 2 * node + 1 + (x[rows, feature[node]] > cut[node])
            total += leaf[node - len(feature)]
        return 1 / (1 + np.exp(-total))


def grow(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, bins: int = BINS,
         rate: float = RATE, ridge: float = RIDGE) -> Trees:
    """Boost trees on the logistic loss, each split chosen from gradient histograms over quantile bins.

    Without rows, or with one label only, the score is constant.
    """
    inner = 2 ** depth - 1
    model = Trees(np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf), np.zeros((trees, inner + 1)), 0.0)
    if not len(y):
        return model
    mean = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    model.start = float(np.log(mean / (1 - mean)))
    if y.min() == y.max():
        return model
    n, m = x.shape
    edges = np.quantile(x, np.linspace(0, 1, bins + 1)[1:-1], axis=0)
    binned = np.stack([np.searchsorted(edges[:, f], x[:, f], side="left") for f in range(m)], axis=1)
    flat = binned + np.arange(m) * bins
    total = np.full(n, model.start)
    for t in range(trees):
        p = 1 / (1 + np.exp(-total))
        gradient, weight = y - p, p * (1 - p)
        node = np.zeros(n, np.int64)
        for level in range(depth):
            first, width = 2 ** level - 1, 2 ** level
            at = ((node - first)[:, None] * (m * bins) + flat).ravel()
            g, h = (np.bincount(at, np.repeat(v, m), width * m * bins).reshape(width, m, bins).cumsum(2)
                    for v in (gradient, weight))
            gt, ht = g[:, :, -1:], h[:, :, -1:]
            gain = g * g / (h + ridge) + (gt - g) ** 2 / (ht - h + ridge) - gt * gt / (ht + ridge)
            gain[(h < 1) | (ht - h < 1)] = 0
            best = gain[:, :, :-1].reshape(width, -1)
            choice = best.argmax(1)
            f, b = choice // (bins - 1), choice % (bins - 1)
            split = best[np.arange(width), choice] > 1e-9
            model.feature[t, first:first + width] = f
            model.cut[t, first:first + width] = np.where(split, edges[b, f], np.inf)
            node = 2 * node + 1 + (x[np.arange(n), model.feature[t, node]] > model.cut[t, node])
        leaf = node - inner
        value = rate * np.bincount(leaf, gradient, inner + 1) / (np.bincount(leaf, weight, inner + 1) + ridge)
        model.leaf[t] = value
        total += value[leaf]
    return model


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", label: str = "quality",
        rows: int = SAMPLE_ROWS) -> Trees:
    """Trees from at most `rows` labelled rows whose crc32(doc_id as text) mod 5 is not 0.

    Rows without an id or a label, and repeated ones, are left out. The sample's ids and labels, bounded by `rows`, are
    broadcast to the texts.
    """
    key = F.col(doc_id)
    chosen = (labels.select(key.alias("_id"), F.col(label).cast("double").alias("_label"))
              .filter(F.col("_label").isNotNull() & (id_remainder(F.col("_id"), 5) != 0))
              .dropDuplicates().orderBy(F.xxhash64("_id"), "_id", "_label").limit(rows))
    stats = per_text(lambda texts: list(statistics(texts)), T.ArrayType(T.DoubleType()))
    sample = (docs.select(key.alias("_id"), F.col(text).alias("_text")).join(F.broadcast(chosen), "_id")
              .select("_id", "_label", stats(F.col("_text")).alias("_x")))
    # an id may stand on any number of rows, so the bound is kept before anything reaches the driver
    sample = sample.orderBy(F.xxhash64("_id"), "_id", "_label", "_x").limit(rows)
    found = sorted((r["_id"], r["_label"], r["_x"]) for r in sample.collect())
    x = np.array([r[2] for r in found]).reshape(-1, len(FEATURES))
    return grow(x, np.array([r[1] for r in found]))


def classify(docs: DataFrame, model: Trees, text: str = "text") -> DataFrame:
    """docs with one more column at the end, `_score` (underscores follow if docs has it), 0 to 1; null and empty texts
    are scored by their zero statistics."""
    score = per_text(lambda texts: list(model.score(statistics(texts))), T.DoubleType())
    return docs.withColumn(fresh("_score", docs.columns), score(F.col(text)))


@query("op4_quality_classifier")
def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, table(spark, sf_dir, "labels"))
    return classify(docs, model).select(
        "doc_id", (id_remainder(F.col("doc_id"), 5) == 0).alias("held_out"), F.col("_score").alias("score"),
        F.when(F.col("_score") >= THRESHOLD, 1).otherwise(0).cast("int").alias("predicted"))
