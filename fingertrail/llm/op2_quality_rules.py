"""Quality rules: a linear-chain conditional random field labels lines as content or boilerplate.

Every line with a word gets features of its characters, words and repetition; Viterbi decoding marks each
line, and the share of characters in content lines decides whether the document stays. The field is trained on a
bounded sample of documents whose label says good or bad: lines of good documents are content, lines of bad
ones start as boilerplate and are relabelled by the field itself over a few rounds.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fingertrail.llm.catalog import query
from fingertrail.llm.common import fresh, per_text, table

#: At most so many labelled documents are learned from, those with the smallest hash of their id.
SAMPLE_ROWS = 3_000
#: Lines of one document that the field is learned from, at most.
SAMPLE_LINES = 500
#: A document stays if at least this share of its characters lies in content lines.
MIN_CONTENT = 0.5
WINDOW = 5

SPACES, SYMBOLS = b" \t\n\v\f\r", b"#*$%&|<>"
# Byte classes for line features.
CLASSES = (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b"#*$%&<>", b"|", b"!?", b"@{}[]()=/\\_~^+")
_CLASS = np.full(256, len(CLASSES), np.uint8)
for _k, _members in enumerate(CLASSES):
    _CLASS[list(_members)] = _k
#: Shares of the byte classes, logarithm of words, bytes a word, seen in an earlier line, share of repeated words, ends as
#: a sentence, words equal to the one before, one.
N_FEATURES = len(CLASSES) + 7


def ranks(*columns: np.ndarray) -> np.ndarray:
    """Dense numbers of the distinct rows made of columns of non-negative numbers."""
    out = columns[0]
    for column in columns[1:]:
        wide = out.astype(np.int64) * (int(column.max(initial=0)) + 1) + column
        out = np.unique(wide, return_inverse=True)[1]
    return out


def repeated_words(words: list[bytes], owner: np.ndarray) -> np.ndarray:
    """Which words lie in a window of five words found twice or more in the same text."""
    covered = np.zeros(len(words), bool)
    n = len(words) - WINDOW + 1
    if n < 1:
        return covered
    ids = pd.factorize(np.array(words, dtype=object))[0].astype(np.int64)
    pairs = ranks(ids[:-1], ids[1:])
    fours = ranks(pairs[:-2], pairs[2:])
    inside = np.flatnonzero(owner[:n] == owner[WINDOW - 1:])
    window = ranks(owner[inside], ranks(fours[inside], ids[inside + WINDOW - 1]))
    start = inside[np.bincount(window)[window] > 1]
    for k in range(WINDOW):
        covered[start + k] = True
    return covered


def analyse(texts: list[str]) -> tuple[pd.DataFrame, np.ndarray, np.ndarray, np.ndarray]:
    """Base figures of each text, features of each line with a word, that line's text number and its size."""
    raws = [t.encode("utf-8", "replace") for t in texts]
    words, per_line, owner_of_line, lines, seen_before, n_dup = [], [], [], [], [], []
    for i, raw in enumerate(raws):
        seen, dup = set(), 0
        for line in raw.split(b"\n"):
            own = line.split()
            if own:
                words += own
                per_line.append(len(own))
                owner_of_line.append(i)
                lines.append(line)
                again = line in seen
                seen_before.append(again)
                dup += again
                seen.add(line)
        n_dup.append(dup)
    per_line, owner_of_line = np.array(per_line, np.int64), np.array(owner_of_line, np.int64)
    owner = np.repeat(owner_of_line, per_line)
    line_of_word = np.repeat(np.arange(len(lines)), per_line)
    repeated = repeated_words(words, owner)
    spaces = [len(raw) - len(raw.translate(None, SPACES)) for raw in raws]
    n = len(texts)
    base = pd.DataFrame({
        "n_words": np.bincount(owner, minlength=n),
        "word_chars": [len(t) - s for t, s in zip(texts, spaces)],
        "n_symbols": [len(raw) - len(raw.translate(None, SYMBOLS)) for raw in raws],
        "n_dup_lines": n_dup,
        "n_repeat_words": np.bincount(owner, repeated, minlength=n).astype(np.int64)})
    if not lines:
        return base, np.zeros((0, N_FEATURES)), owner_of_line, np.zeros(0)
    size = np.array([len(x) for x in lines])
    kinds = _CLASS[np.frombuffer(b"".join(lines), np.uint8)]
    at = np.repeat(np.arange(len(lines)), size)
    k = len(CLASSES)
    shares = np.bincount(at * (k + 1) + kinds, minlength=len(lines) * (k + 1)).reshape(-1, k + 1)[:, :k] / size[:, None]
    same = np.r_[False, [a == b for a, b in zip(words, words[1:])]] & np.r_[False, line_of_word[1:] == line_of_word[:-1]]
    x = np.column_stack([
        shares * 5, np.log1p(per_line) / 3, size / per_line / 8, np.array(seen_before, float),
        np.bincount(line_of_word, repeated, len(lines)) / per_line,
        [line.rstrip()[-1:] in (b".", b"!", b"?", b":") for line in lines],
        np.bincount(line_of_word, same, len(lines)) / per_line, np.ones(len(lines))])
    return base, x, owner_of_line, size


@dataclass
class Field:
    """Weights of features and transitions for the states content (0) and boilerplate (1)."""
    unary: np.ndarray = field(default_factory=lambda: np.zeros((N_FEATURES, 2)))
    step: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))

    def decode(self, x: np.ndarray) -> np.ndarray:
        """The most probable states of one sequence; equal scores go to content."""
        (aa, ab), (ba, bb) = self.step.tolist()
        back, u = [], (x @ self.unary).tolist()
        if not u:
            return np.zeros(0, np.int64)
        a, b = u[0]
        for ua, ub in u[1:]:
            to_a, to_b = a + aa < b + ba, a + ab < b + bb
            back.append((to_a, to_b))
            a, b = (b + ba if to_a else a + aa) + ua, (b + bb if to_b else a + ab) + ub
        state = int(b > a)
        out = [state]
        for choice in reversed(back):
            state = int(choice[state])
            out.append(state)
        return np.array(out[::-1])


def train_field(sequences: list[np.ndarray], states: list[np.ndarray], start: Field | None = None, steps: int = 120,
                rate: float = 0.1, ridge: float = 1e-3, longest: int = 64) -> Field:
    """Maximise the conditional likelihood by forward-backward and Adam; long sequences are cut for training."""
    parts = [(x[i:i + longest], y[i:i + longest]) for x, y in zip(sequences, states) for i in range(0, len(x), longest)]
    model = start or Field()
    if not parts:
        return model
    parts.sort(key=lambda p: -len(p[0]))
    size = np.array([len(x) for x, _ in parts])
    count, most = len(parts), size[0]
    x, y = np.zeros((most, count, N_FEATURES)), np.zeros((most, count), np.int64)
    for i, (a, b) in enumerate(parts):
        x[:len(a), i], y[:len(b), i] = a, b
    live = np.arange(most)[:, None] < size
    observed_x = np.einsum("tnf,tns->fs", x, np.eye(2)[y] * live[:, :, None])
    pairs = (y[:-1] * 2 + y[1:])[live[1:]]
    observed_t = np.bincount(pairs, minlength=4).reshape(2, 2)
    moment = [[np.zeros((N_FEATURES, 2)), np.zeros((N_FEATURES, 2))], [np.zeros((2, 2)), np.zeros((2, 2))]]
    for it in range(1, steps + 1):
        u = x @ model.unary
        forward, backward = np.zeros((most, count, 2)), np.zeros((most, count, 2))
        forward[0] = u[0]
        alive = live.sum(1)
        for t in range(1, most):
            n = alive[t]
            forward[t, :n] = u[t, :n] + np.logaddexp.reduce(forward[t - 1, :n, :, None] + model.step, axis=1)
        for t in range(most - 2, -1, -1):
            n = alive[t + 1]
            backward[t, :n] = np.logaddexp.reduce(model.step + (u[t + 1, :n] + backward[t + 1, :n])[:, None, :], axis=2)
        total = np.logaddexp.reduce(forward[0] + backward[0], axis=1)
        state = np.exp(forward + backward - total[:, None]) * live[:, :, None]
        edge = np.exp(forward[:-1, :, :, None] + model.step + (u[1:] + backward[1:])[:, :, None, :]
                      - total[:, None, None]) * live[1:, :, None, None]
        lines = live.sum()
        gradients = ((observed_x - np.einsum("tnf,tns->fs", x, state)) / lines - ridge * model.unary,
                     (observed_t - edge.sum((0, 1))) / lines - ridge * model.step)
        for k, (weight, g) in enumerate(zip((model.unary, model.step), gradients)):
            m, v = moment[k]
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            weight += rate * (m / (1 - 0.9 ** it)) / (np.sqrt(v / (1 - 0.99 ** it)) + 1e-8)
    return model


def learn(sequences: list[np.ndarray], good: list[bool], rounds: int = 3) -> Field:
    """Train from labels of whole sequences. Without bad ones all lines are content."""
    if all(good):
        return Field()
    states = [np.full(len(x), 0 if g else 1) for x, g in zip(sequences, good)]
    model = train_field(sequences, states)
    for _ in range(rounds - 1):
        for i, g in enumerate(good):
            if not g:
                found = model.decode(sequences[i])
                states[i] = found if found.any() else np.ones(len(found), np.int64)
        model = train_field(sequences, states, model, steps=60)
    return model


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", label: str = "quality",
        rows: int = SAMPLE_ROWS) -> Field:
    """A field learned from at most `rows` labelled documents; rows without id or label are left out.

    Of a document of more than SAMPLE_LINES lines, so many consecutive ones are learned from, at a place that its text's hash
    says; all are labelled later.
    """
    chosen = (labels.select(F.col(doc_id).alias("_id"), F.col(label).cast("int").alias("_label"))
              .filter(F.col("_id").isNotNull() & F.col("_label").isNotNull()).dropDuplicates()
              .orderBy(F.xxhash64("_id"), "_id", "_label").limit(rows))

    def features(texts: list[str]) -> list:
        _, x, owner, _ = analyse(texts)
        ends = np.searchsorted(owner, np.arange(len(texts) + 1))
        out = []
        for text, a, b in zip(texts, ends, ends[1:]):
            start = a + xxhash.xxh3_64_intdigest(text) % int(b - a - SAMPLE_LINES + 1) if b - a > SAMPLE_LINES else a
            out.append(x[start:min(b, start + SAMPLE_LINES)].ravel())
        return out

    sample = (docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text")).join(F.broadcast(chosen), "_id")
              .select("_id", "_label", per_text(features, T.ArrayType(T.FloatType()))(F.col("_text")).alias("_x")))
    # an id may stand on any number of rows, so the bound is kept before anything reaches the driver
    sample = sample.orderBy(F.xxhash64("_id"), "_id", "_label", "_x").limit(rows).orderBy("_id", "_label", "_x").toArrow()
    numbers, sizes = sample["_x"].combine_chunks(), sample["_label"].to_pylist()
    found = [(x.values.to_numpy(zero_copy_only=False).astype(float).reshape(-1, N_FEATURES), label > 0) for x, label in zip(numbers, sizes)]
    found = [(x, good) for x, good in found if len(x)]
    return learn([x for x, _ in found], [g for _, g in found])


BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
RESULT = T.StructType([T.StructField(c, T.LongType()) for c in BASE]
                      + [T.StructField("content_share", T.DoubleType()), T.StructField("boilerplate_lines", T.ArrayType(T.IntegerType()))])


def label_lines(docs: DataFrame, model: Field, text: str = "text") -> DataFrame:
    """docs with one more column at the end, `_rules` (underscores follow if docs has it): the base figures, the share of characters in content lines, and the
    numbers (from 0, among lines with a word) of the boilerplate lines.

    A null text counts as empty; without any word the share is 0.
    """
    def run(texts: list[str]) -> list[dict]:
        base, x, owner, size = analyse(texts)
        ends = np.searchsorted(owner, np.arange(len(texts) + 1))
        out = base.to_dict("records")
        for row, a, b in zip(out, ends, ends[1:]):
            states = model.decode(x[a:b])
            row["content_share"] = float(size[a:b][states == 0].sum() / size[a:b].sum()) if b > a else 0.0
            row["boilerplate_lines"] = np.flatnonzero(states).tolist()
        return out

    return docs.withColumn(fresh("_rules", docs.columns), per_text(run, RESULT)(F.col(text)))


@query("op2_quality_rules")
def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, table(spark, sf_dir, "labels"))
    ruled = label_lines(docs, model).select("doc_id", *[f"_rules.{c}" for c in BASE], "_rules.content_share")
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return (ruled.withColumn("base_failed", failed)
            .withColumn("kept", ~F.col("base_failed") & (F.col("content_share") >= MIN_CONTENT)))
