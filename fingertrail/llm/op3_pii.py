"""Personal data: a semi-Markov conditional random field over candidate segments.

Words with a digit or an at sign, and up to five words on both sides, form clusters, over white space of at most four
characters; outside them no segment can score. In a cluster every run of at most six words with such a word, stripped of outer punctuation, is a candidate for each kind. Features
describe the whole span, and dynamic programming with bounded segments picks boundaries and kinds together.
The field is trained on a bounded sample of documents: spans found by the plain patterns are its truth, also in
rewritten forms that the patterns do not reach (spelled-out at signs, other number groupings). Plain spans
always stay; the field adds spans that overlap none of them.
"""

from __future__ import annotations

import hashlib
import math
import random
import re
from bisect import bisect_left
from collections import Counter
from dataclasses import dataclass, field
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fingertrail.llm.catalog import query
from fingertrail.llm.common import fresh, per_text, release, small_batches, table, text_slices
from fingertrail.session import store

#: At most so many different pieces of clusters are learned from: of each kind of plain match, and of those without any,
#: an equal share with the smallest hashes. A piece is at most PIECE_WORDS words of a cluster; all pieces take part.
SAMPLE_ROWS, PIECE_WORDS = 3_000, 48
#: Characters of white space over which a cluster goes on.
SHORT_SPACE = 4
#: Words in a segment, and by how much the chosen reading must beat leaving the segment out.
LONGEST, MARGIN = 6, 2.0
#: Fewest and most code points of a segment; a field's `chars` may say otherwise.
SPAN_CHARS = (5, 120)

# The base patterns, kinds in their order of output.
KINDS = ["email", "ip", "card", "phone"]
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_RE = {kind: re.compile(pattern) for kind, pattern in PATTERNS.items()}
_MAIL_HEAD = re.compile(r"[A-Za-z0-9._%+-]+\Z")
_MAIL_TAIL = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DIGIT = re.compile(r"[0-9]")
_SPACES = " \t\n\v\f\r"
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_TRIGGER = re.compile(r"[0-9@]|[(\[]at[)\]]")
_MAIL_CHARS = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        v = int(d) * (1 + k % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def passes(kind: str, found: str) -> bool:
    if kind == "ip":
        return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in found.split("."))
    if kind in ("card", "phone"):
        digits = "".join(_DIGIT.findall(found))
        return 14 <= len(digits) <= 19 and luhn(digits) if kind == "card" else 10 <= len(digits) <= 15
    return True


def _mails(text: str):
    """Matches of the email pattern, found from each at sign: the same spans without trying every word."""
    last, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _MAIL_CHARS:
            start -= 1
        tail = _MAIL_TAIL.match(text, at) if start < at else None
        if tail:
            yield start, tail.end()
            last = tail.end()
        at = text.find("@", tail.end() if tail else at + 1)


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """Start, end and kind of the plain matches that pass their check, by start, then kind."""
    spans = [(a, b, "email") for a, b in _mails(text)]
    if _DIGIT.search(text):
        for kind in KINDS[1:]:
            if kind != "phone" or "+" in text:
                spans += [(m.start(), m.end(), kind) for m in _RE[kind].finditer(text) if passes(kind, m.group())]
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def clusters(text: str) -> list[list[tuple[int, int]]]:
    """Words that have a trigger with up to LONGEST - 1 words on both sides, as (start, end) of the words; runs
    that meet are one, and longer white space ends a run."""
    out, ahead, done = [], 0, 0  # words still to take after a trigger; where the words looked at end
    run: list[tuple[int, int]] = []

    def forward() -> bool:
        """Take the next word after the run, if it stands near enough."""
        word = _WORD.search(text, run[-1][1], run[-1][1] + SHORT_SPACE + 1)
        if not word:
            return False
        run.append(_WORD.match(text, word.start()).span())
        return True

    for hit in _TRIGGER.finditer(text):
        if hit.start() < done:
            continue
        while run and ahead and run[-1][1] <= hit.start():
            ahead = ahead - 1 if forward() else 0
        if not run or run[-1][1] <= hit.start():
            start = hit.start()
            while start > 0 and text[start - 1] not in _SPACES:
                start -= 1
            own = [(start, _WORD.match(text, start).end())]
            low = run[-1][1] if run else 0
            joined = False
            while len(own) < LONGEST:
                end = own[-1][0]
                at = end
                while at > low and end - at <= SHORT_SPACE and text[at - 1] in _SPACES:
                    at -= 1
                if end - at > SHORT_SPACE or at == 0:
                    break
                if at == low:
                    joined = bool(run)
                    break
                start = at
                while start > low and text[start - 1] not in _SPACES:
                    start -= 1
                own.append((start, at))
            if not joined and run and own[-1][0] > low:
                gap = text[low:own[-1][0]]
                joined = len(gap) <= SHORT_SPACE and not gap.strip(_SPACES)
            if joined:
                run += own[::-1]
            else:
                run = own[::-1]
                out.append(run)
        ahead, done = LONGEST - 1, run[-1][1]
    while run and ahead:
        ahead = ahead - 1 if forward() else 0
    return out


_OUTER = ".,;:!?\"'<>{}#$%&*|"


def trimmed(text: str, start: int, end: int) -> tuple[int, int]:
    """Without outer punctuation; a bracket stays only if its partner is inside."""
    while start < end and (text[start] in _OUTER or text[start] in "([" and not {")", "]"} & set(text[start:end])):
        start += 1
    while end > start and (text[end - 1] in _OUTER or text[end - 1] in ")]" and not {"(", "["} & set(text[start:end])):
        end -= 1
    return start, end


_AT = re.compile(r" ?[(\[]at[)\]] ?|@")
_DOT = re.compile(r" ?[(\[]dot[)\]] ?")
_SPACE = re.compile(r"[\x20\x09-\x0D]+")
_SHAPE = [(re.compile(r"[A-Za-zÀ-ɏ]+"), "a"), (re.compile(r"[0-9]"), "9")]


def features(text: str, start: int, end: int) -> list[str]:
    """Names of the features of a whole span."""
    span = _SPACE.sub(" ", text[start:end])
    digits = "".join(_DIGIT.findall(span))
    n, letters = len(digits), sum(c.isalpha() for c in span)
    groups = [len(g) for g in re.findall(r"[0-9]+", span)]
    marks = "".join(sorted(set(span) - set(digits) - {c for c in span if c.isalpha()}))
    f = ["one", f"digits={min(n, 20)}", f"marks={marks}", f"letters={min(letters, 3)}",
         f"groups={'-'.join(map(str, groups[:6]))}" if letters == 0 else "groups=letters", f"words={span.count(' ')}"]
    if span[:1] == "+":
        f += ["plus", f"plus={10 <= n <= 15}"]
    if _AT.search(span) and letters:
        local, _, host = _DOT.sub(".", _AT.sub("@", span)).partition("@")
        good = bool(_MAIL_HEAD.match(local)) and bool(re.fullmatch(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", host))
        f.append(f"mail={good}")
    if letters == 0 and len(groups) == 4 and span.count(".") == 3 and len(marks) == 1:
        f.append(f"quad={passes('ip', span)}")
    if letters == 0 and 14 <= n <= 19:
        f.append(f"luhn={luhn(digits)}&{'one' if len(marks) <= 1 else 'many'}")
    if letters == 0 and 10 <= n <= 15 and ("(" in span or "-" in span or span[:2] == "00"):
        f.append(f"dial={'3-3-4' if groups[-3:] == [3, 3, 4] else 'other'}")
    return f


def candidates(text: str, words: list[tuple[int, int]], chars: tuple[int, int] = SPAN_CHARS):
    """(first word, word after, start, end) of each run of a cluster's words that could be a span: it has a trigger,
    without outer punctuation it still reaches into its first and last word, and its length is within `chars`."""
    near, nearest = [0] * len(words), len(words) + LONGEST
    for k in range(len(words) - 1, -1, -1):
        nearest = k if _TRIGGER.search(text, *words[k]) else nearest
        near[k] = nearest
    for i in range(len(words)):
        for j in range(max(i, near[i]) + 1, min(i + LONGEST, len(words)) + 1):
            a, b = trimmed(text, words[i][0], words[j - 1][1])
            if chars[0] <= b - a <= chars[1] and (j == i + 1 or a < words[i][1] and b > words[j - 1][0]):
                yield i, j, a, b


@dataclass
class SpanField:
    """Weights by kind and feature; a feature that training never saw in a span of any kind speaks against it."""
    weights: dict[str, dict[str, float]] = field(default_factory=dict)
    unseen: float = -4.0
    chars: tuple[int, int] = SPAN_CHARS

    def score(self, kind: str, names: list[str]) -> float:
        own = self.weights[kind]
        return sum(own.get(f, self.unseen) for f in names)

    def spans(self, text: str) -> list[tuple[int, int, str]]:
        """The best reading: segments that together score most, leaving a word out counts 0.

        A cluster is read once from its first word; only the last LONGEST places are open at a time, so a cluster
        of any length needs a number and a way back per word.
        """
        found = []
        if not self.weights:
            return found
        for words in clusters(text):
            best, back, settled = [0.0] * (len(words) + 1), {}, 0

            def settle(upto: int, best: list[float], back: dict, settled: int) -> None:
                for k in range(settled + 1, upto + 1):
                    if best[k - 1] >= best[k]:  # leaving the word out is as good
                        best[k] = best[k - 1]
                        back.pop(k, None)

            for i, j, a, b in candidates(text, words, self.chars):
                settle(i, best, back, settled)
                settled = max(settled, i)
                names = features(text, a, b)
                for kind in self.weights:
                    score = self.score(kind, names)
                    if score > MARGIN and best[i] + score > best[j]:
                        best[j], back[j] = best[i] + score, (i, a, b, kind)
            settle(len(words), best, back, settled)
            j = len(words)
            while j > 0:
                if j in back:
                    j, a, b, kind = back[j]
                    found.append((a, b, kind))
                else:
                    j -= 1
        return sorted(found)


def varied(text: str, rng: random.Random) -> tuple[str, list[tuple[int, int, str]]]:
    """The text with half of its plain spans rewritten in a form that the patterns do not reach, and the truth."""
    out, at, truth, size = [], 0, [], 0
    for a, b, kind in base_spans(text):
        if a < at:
            continue
        span = text[a:b]
        if rng.random() < 0.5:
            digits = "".join(_DIGIT.findall(span))
            if kind == "email":
                sign, dot = rng.choice([("(at)", "."), ("[at]", "."), (" (at) ", "."), (" [at] ", "."), (" (at) ", " (dot) "), (" [at] ", " [dot] ")])
                local, _, host = span.partition("@")
                span = local + sign + host.replace(".", dot if host.count(".") == 1 else ".")
            elif kind == "phone" and len(digits) >= 10:
                d = digits[-10:]
                span = rng.choice([f"({d[:3]}) {d[3:6]}-{d[6:]}", f"{d[:3]}-{d[3:6]}-{d[6:]}",
                                   f"{digits[:-10] or 1} ({d[:3]}) {d[3:6]}-{d[6:]}"])
                span = span.replace(" ", rng.choice([" ", "  ", "\t", "\n"]))
            elif kind == "card":
                span = rng.choice(["/", "."]).join(digits[k:k + 4] for k in range(0, len(digits), 4))
        out += [text[at:a], span]
        size += a - at
        truth.append((size, size + len(span), kind))
        size += len(span)
        at = b
    return "".join([*out, text[at:]]), truth


def _log_sum(values: list[float]) -> float:
    most = max(values)
    return most + math.log(sum(math.exp(v - most) for v in values)) if len(values) > 1 else most


def train(texts: list[str], passes_over: int = 12, rate: float = 0.3, seed: int = 5) -> SpanField:
    """Stochastic ascent on the conditional likelihood, with forward-backward sums over all segmentations of a cluster."""
    rng = random.Random(seed)
    model = SpanField()
    examples = []
    kinds = Counter()
    for text in texts:
        for value, truth in ((text, base_spans(text)), varied(text, rng)):
            for words in clusters(value):
                inside = [t for t in truth if words[0][0] <= t[0] and t[1] <= words[-1][1]]
                kinds.update(k for _, _, k in inside)
                examples.append((value, words, {(a, b, k) for a, b, k in inside}))
    if not kinds:
        return model
    model.weights = {k: {} for k in KINDS if kinds[k]}
    prepared, place = [], {}
    for value, words, truth in examples:
        cuts = {}
        for i, j, a, b in candidates(value, words):
            cuts[i, j] = (features(value, a, b), {k for k in model.weights if (a, b, k) in truth})
        names = [[place.setdefault(f, len(place)) for f in fs] for fs, _ in cuts.values()]
        if names:
            prepared.append((len(words), list(cuts), np.array([f for fs in names for f in fs]), np.cumsum([0, *map(len, names)])[:-1],
                             np.array([[k in true for _, true in cuts.values()] for k in model.weights], float), [len(fs) for fs in names]))
    weights = np.zeros((len(model.weights), len(place)))
    touched = np.zeros(weights.shape, bool)
    for _ in range(passes_over):
        rng.shuffle(prepared)
        for n, cuts, names, starts, true, sizes in prepared:
            scores = np.add.reduceat(weights[:, names], starts, axis=1)
            most = scores.max(0)
            total = (most + np.log(np.exp(scores - most).sum(0))).tolist()  # of all kinds
            ahead, behind = [0.0] * (n + 1), [0.0] * (n + 1)
            into, out = [[] for _ in range(n + 1)], [[] for _ in range(n + 1)]
            for (i, j), s in zip(cuts, total):
                into[j].append((i, s))
                out[i].append((j, s))
            for j in range(1, n + 1):
                ahead[j] = _log_sum([ahead[j - 1], *(ahead[i] + s for i, s in into[j])])
            for i in range(n - 1, -1, -1):
                behind[i] = _log_sum([behind[i + 1], *(behind[j] + s for j, s in out[i])])
            around = np.array([ahead[i] + behind[j] for i, j in cuts]) - ahead[n]
            step = rate * (true - np.exp(scores + around))
            step[np.abs(step) <= 1e-4] = 0
            moved = np.repeat(step, sizes, axis=1)
            for k in np.flatnonzero(step.any(1)):
                np.add.at(weights[k], names, moved[k])
                touched[k, names[moved[k] != 0]] = True
    for k, kind in enumerate(model.weights):
        model.weights[kind] = {f: float(weights[k, p]) for f, p in place.items() if touched[k, p]}
    return model


def pieces(text: str) -> set[str]:
    """All clusters of the text, long ones in pieces."""
    return {text[part[0][0]:part[-1][1]] for words in clusters(text)
            for part in (words[k:k + PIECE_WORDS] for k in range(0, len(words), PIECE_WORDS))}


def fit(docs: DataFrame, text: str = "text", rows: int = SAMPLE_ROWS) -> SpanField:
    """A field learned from at most `rows` different pieces of clusters, the smallest hashes of each kind. A task gives
    no more than that share of each kind, and the driver gets no more than `rows`."""
    share = max(1, rows // (len(KINDS) + 1))

    def smallest(batches):
        best: dict[str, dict[int, str]] = {}
        for batch in batches:
            for value in (text for part in text_slices(batch.column(0)) for text in part):
                for piece in pieces(value):
                    h = xxhash.xxh3_64_intdigest(piece) - (1 << 63)
                    for kind in {k for _, _, k in base_spans(piece)} or {""}:
                        own = best.setdefault(kind, {})
                        own[h] = piece
                        if len(own) > 4 * share:
                            best[kind] = {x: own[x] for x in sorted(own)[:share]}
            release()
        for kind, own in best.items():
            kept = sorted(own)[:share]
            yield pa.RecordBatch.from_pydict({"kind": [kind] * len(kept), "h": pa.array(kept, pa.int64()), "piece": [own[x] for x in kept]})

    with small_batches(docs.sparkSession):
        found = store(docs.filter(F.col(text).rlike("[0-9@]|[(\\[]at[)\\]]")).select(F.col(text).cast("string")).mapInArrow(smallest, "kind string, h long, piece string"))
    chosen = [r["piece"] for kind in ["", *KINDS]
              for r in found.filter(F.col("kind") == kind).select("h", "piece").distinct().orderBy("h", "piece").limit(share).collect()]
    return train(sorted(set(chosen)))


SPANS = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()),
                                  T.StructField("end", T.IntegerType()), T.StructField("base", T.BooleanType())]))


def all_spans(text: str, model: SpanField) -> list[tuple[int, int, str, bool]]:
    base = base_spans(text)
    found = [(a, b, k, True) for a, b, k in base]
    if _TRIGGER.search(text):
        starts, reach = [a for a, _, _ in base], list(accumulate((b for _, b, _ in base), max))
        for a, b, k in model.spans(text):
            before = bisect_left(starts, b)  # base spans that begin before this one ends
            if not before or reach[before - 1] <= a:
                found.append((a, b, k, False))
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def find(docs: DataFrame, model: SpanField, text: str = "text") -> DataFrame:
    """docs with one more column `_spans` (underscores follow if docs has it): kind, start and end (code points, end
    exclusive) and whether a plain pattern found it, by start, then kind. A null or empty text has none. Spans of the
    field are of `model.chars` code points; plain ones of any length."""
    def run(texts: list[str]) -> list:
        return [[{"kind": k, "start": a, "end": b, "base": base} for a, b, k, base in all_spans(t, model)] for t in texts]

    return docs.withColumn(fresh("_spans", docs.columns), per_text(run, SPANS)(F.col(text)))


def mask(docs: DataFrame, model: SpanField, text: str = "text") -> DataFrame:
    """docs with every span of its text replaced by its kind in angle brackets; overlapping spans become one, of
    the kind that starts first. A null text stays null."""
    def run(texts: list[str]) -> list[str]:
        out = []
        for value in texts:
            parts, at = [], 0
            for a, b, kind, _ in all_spans(value, model):
                if a >= at:
                    parts += [value[at:a], f"<{kind.upper()}>"]
                at = max(at, b)
            out.append("".join([*parts, value[at:]]))
        return out

    masked = per_text(run, T.StringType())(F.col(text))
    return docs.withColumn(text, F.when(F.col(text).isNotNull(), masked))


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


@query("op3_pii")
def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find(docs, fit(docs)).select("doc_id", "_spans")
    base = F.filter("_spans", lambda s: s["base"])
    kinds = F.transform(base, lambda s: s["kind"])
    counts = [F.size(F.array_remove(kinds, F.lit(k))) for k in KINDS]
    counts = [(F.size(kinds) - n).cast("long").alias(f"n_{k}") for k, n in zip(KINDS, counts)]
    return found.select("doc_id", *counts, F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"),
                        joined(F.col("_spans")).alias("spans"))


def digest(spans: list[tuple[int, int, str]]) -> str:
    return hashlib.sha256(",".join(f"{k}:{a}:{b}" for a, b, k in spans).encode()).hexdigest()
