"""Quality rules, personal data, classifier, language and packing against brute force and their defined cases."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from fingertrail.llm import op2_quality_rules as rules
from fingertrail.llm import op3_pii as pii
from fingertrail.llm import op4_quality_classifier as quality
from fingertrail.llm import op7_language_id as language
from fingertrail.llm import op10_packing as packing

SCHEMA = "doc_id long, text string"
ODD = [None, "", " \n\t ", "a", "é" * 50, "word " * 5000, "a b\x1cc \x85d", "!" * 3000, "\n" * 500, "日本語 текст 🙂 𝔘𝔫𝔦"]


def odd_rows(spark, extra="lang string, _score int, `a.b` string"):
    rows = [(k, t, None, 1, "x") for k, t in enumerate(ODD)] + [(None, "no id", "en", 2, "y"), (3, "a", "en", 3, None), (3, "a", "en", 3, None)]
    return spark.createDataFrame(rows, f"{SCHEMA}, {extra}")


# quality rules

def brute_rules(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    covered = {k for i in range(len(w) - 4) if windows[tuple(w[i:i + 5])] > 1 for k in range(i, i + 5)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        dup += bool(re.search(r"[^\x20\x09-\x0D]", line)) and line in seen
        seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


def test_rules_base_figures():
    rng = random.Random(4)
    texts = ["".join(rng.choice(["a", "b ", "ab", "\n", " ", "é", "#", "b b a a b\n", "\x0b", " "]) for _ in range(rng.randint(0, 150)))
             for _ in range(300)] + [t or "" for t in ODD]
    base = rules.analyse(texts)[0]
    assert [tuple(r) for r in base[rules.BASE].itertuples(index=False)] == [brute_rules(t) for t in texts]


@pytest.mark.parametrize("seed", range(4))
def test_viterbi_is_the_best_path(seed):
    rng = np.random.default_rng(seed)
    model = rules.Field(rng.normal(size=(rules.N_FEATURES, 2)), rng.normal(size=(2, 2)))
    x = rng.normal(size=(9, rules.N_FEATURES))
    u = x @ model.unary
    score = lambda y: sum(u[t, s] for t, s in enumerate(y)) + sum(model.step[a, b] for a, b in zip(y, y[1:]))
    best = max((tuple(map(int, f"{k:09b}")) for k in range(512)), key=score)
    assert tuple(model.decode(x)) == best


def test_rules_learn_and_defined_cases(spark):
    clean = "The river runs past the old mill and turns.\nPeople walk there in the morning, slowly."
    junk = "buy ### now *** $$$ cheap %%% deal\n### click *** here $$$ %%%"
    rows = [(k, clean + f" Day {k}." if k % 2 else junk + f" {k}") for k in range(60)]
    docs = spark.createDataFrame(rows, SCHEMA)
    labels = spark.createDataFrame([(k, k % 2) for k in range(60)] + [(None, 1), (3, None)], "doc_id long, quality int")
    model = rules.fit(docs, labels)
    mixed = [(100, clean), (101, junk), (102, "\n".join([clean, junk.split("\n")[0]])), (103, None), (None, clean)]
    got = rules.label_lines(spark.createDataFrame(mixed, SCHEMA), model).collect()
    assert [r["_rules"]["boilerplate_lines"] for r in got] == [[], [0, 1], [2], [], []]
    assert got[3]["_rules"]["content_share"] == 0 and got[3]["_rules"]["n_words"] == 0
    assert rules.label_lines(odd_rows(spark), model).count() == 13
    nothing = rules.fit(docs.limit(0), labels.limit(0))
    assert rules.label_lines(docs.limit(0), nothing).count() == 0
    assert rules.label_lines(spark.createDataFrame(mixed, SCHEMA), nothing).first()["_rules"]["content_share"] == 1


# personal data

def brute_pii(text):
    spans = []
    for order, kind in enumerate(pii.KINDS):
        for m in re.finditer(pii.PATTERNS[kind], text):
            digits = re.sub("[^0-9]", "", m.group())
            ok = {"email": True, "ip": kind != "ip" or all(int(p) <= 255 for p in m.group().split(".")),
                  "card": 14 <= len(digits) <= 19 and pii.luhn(digits), "phone": 10 <= len(digits) <= 15}[kind]
            if ok:
                spans.append((m.start(), order, m.end(), kind))
    return [(a, b, k) for a, _, b, k in sorted(spans)]


def test_base_spans_equal_the_patterns():
    rng = random.Random(8)
    parts = ["a.b@c.de", "x@y", "@", "a@b@c.d", "1.2.3.4", "256.1.1.1", "1.2.3.4.5.6.7.8", "4111 1111 1111 1111", "4111-1111-1111-1112",
             "+1 (555) 123-4567", "+49 30 1234567", "+12", "é", " ", ".", "-", "..", "a@b..c", "00000000000000", "%_+@-.a", "\n", "12", "٣"]
    for _ in range(3000):
        text = "".join(rng.choice(parts) + rng.choice(["", " "]) for _ in range(rng.randint(1, 8)))
        assert pii.base_spans(text) == brute_pii(text), text


def test_luhn():
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")


def test_field_learns_rewritten_forms_and_keeps_base_spans(spark):
    rng = random.Random(2)

    def card():
        d = "4" + "".join(rng.choice("0123456789") for _ in range(14))
        return next(d + c for c in "0123456789" if pii.luhn(d + c))

    def phone():
        return f"+1 ({rng.randint(200, 999)}) 555-{rng.randint(1000, 9999)}"

    rows = [(k, f"some words {rng.choice(['', '12', '2021 3.5'])} here {card()} and {phone()} or m{k}.x@site{k % 7}.example.com from "
                f"{rng.randint(1, 250)}.{rng.randint(1, 250)}.3.4 end {rng.randint(1, 99999)}") for k in range(150)]
    docs = spark.createDataFrame(rows, SCHEMA)
    model = pii.fit(docs)
    text = "call (696) 555-2293 or write joe.d[at]mail3.example.com now, see 12 pages of 2021"
    kinds = [(text[a:b], k) for a, b, k, base in pii.all_spans(text, model) if not base]
    assert ("joe.d[at]mail3.example.com", "email") in kinds and ("(696) 555-2293", "phone") in kinds and len(kinds) == 2
    for _, value in rows:
        spans = pii.all_spans(value, model)
        assert [s[:3] for s in spans if s[3]] == brute_pii(value)
        assert all(not (s[0] < t[1] and t[0] < s[1]) for s in spans if not s[3] for t in spans if t is not s)
    masked = {r["doc_id"]: r["text"] for r in pii.mask(docs.limit(5).unionByName(spark.createDataFrame([(900, None), (901, "")], SCHEMA)), model).collect()}
    assert masked[900] is None and masked[901] == "" and "@" not in masked[0] and "<CARD>" in masked[0] and "<IP>" in masked[0]
    assert pii.find(odd_rows(spark), model).count() == 13
    empty = pii.fit(docs.limit(0))
    assert pii.find(docs.limit(0), empty).count() == 0 and pii.all_spans("1.2.3.4", empty) == [(0, 7, "ip", True)]


def test_field_learns_kinds_behind_copies_and_late_in_long_texts(spark):
    numbers = " and ".join(f"{k} apples" for k in range(80))
    rows = [(k, "the same 12 words again") for k in range(400)]
    rows += [(1000 + k, f"{numbers} {k} then m{k}.x@site{k % 7}.example.com here") for k in range(40)]
    model = pii.fit(spark.createDataFrame(rows, SCHEMA), rows=300)
    assert "email" in model.weights
    text = "now write joe.d[at]mail3.example.com today"
    assert [(text[a:b], k) for a, b, k, _ in pii.all_spans(text, model)] == [("joe.d[at]mail3.example.com", "email")]


def test_clusters_hold_near_words():
    text = "a b c d e f g jane (at) example (dot) com h i      j k 5\tl\n m"
    assert [[text[a:b] for a, b in words] for words in pii.clusters(text)] == [
        "d e f g jane (at) example (dot) com h i".split(), "j k 5 l m".split()]
    text = "1 a b c d e f g h i 2 a b c d e f g h i j k 3"
    assert [[text[a:b] for a, b in words] for words in pii.clusters(text)] == [
        "1 a b c d e f g h i 2 a b c d e".split(), "g h i j k 3".split()]


def test_spaced_forms_are_found(spark):
    rng = random.Random(4)
    rows = [(k, f"please write to {rng.choice(['m', 'jo', 'ann'])}{rng.choice(['x', 'e', 'y'])}@site{k % 7}.com today or call "
                f"+1 ({rng.randint(200, 999)}) 555-{rng.randint(1000, 9999)} about the {rng.randint(1, 99)} old houses") for k in range(300)]
    model = pii.fit(spark.createDataFrame(rows, SCHEMA))
    for form, kind in [("jane (at) example (dot) com", "email"), ("jane [at] example.com", "email"), ("(696)  555-2293", "phone"),
                       ("(696)\t555-2293", "phone"), ("(696)\n555-2293", "phone")]:
        text = f"please send word to {form} about the old houses"
        assert [(text[a:b], k) for a, b, k, _ in pii.all_spans(text, model)] == [(form, kind)], form


def test_pii_digest(spark):
    assert pii.digest([(1, 3, "ip"), (4, 9, "card")]) == hashlib.sha256(b"ip:1:3,card:4:9").hexdigest()


def readings(options, n, at=0):
    """All ways to read words at.. as segments and words left out: (score, segments)."""
    if at >= n:
        yield 0.0, ()
        return
    for score, rest in readings(options, n, at + 1):
        yield score, rest
    for (i, j), scored in options.items():
        if i == at:
            for own, kind, a, b in scored:
                if own > pii.MARGIN:
                    for score, rest in readings(options, n, j):
                        yield own + score, ((a, b, kind), *rest)


@pytest.mark.parametrize("seed", range(6))
def test_best_reading_equals_all_readings(seed):
    rng = random.Random(seed)
    names = set()
    texts = [" ".join(rng.choice(["12-34", "555", "a@b.com", "(at)", "x", "0044", "(212)", "7.7.7.7", "call", "4111"]) for _ in range(rng.randint(1, 8))) for _ in range(25)]
    for text in texts:
        for words in pii.clusters(text):
            for _, _, a, b in pii.candidates(text, words):
                names |= set(pii.features(text, a, b))
    model = pii.SpanField({k: {f: rng.uniform(-1.5, 2.5) for f in sorted(names)} for k in ("email", "phone")})
    for text in texts:
        got = model.spans(text)
        best = 0.0
        for words in pii.clusters(text):
            options = {}
            for i, j, a, b in pii.candidates(text, words):
                options[i, j] = [(model.score(k, pii.features(text, a, b)), k, a, b) for k in model.weights]
            best += max(score for score, _ in readings(options, len(words)))
        assert sum(model.score(k, pii.features(text, a, b)) for a, b, k in got) == pytest.approx(best)
        assert all(x[1] <= y[0] for x, y in zip(got, got[1:]))


def test_long_runs_of_numbers_take_bounded_memory():
    import tracemalloc
    model = pii.SpanField({"phone": {"one": 1.0}}, unseen=-1.0)
    text = " ".join(str(k % 977) for k in range(60_000))
    tracemalloc.start()
    model.spans(text)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 60 * len(text)


def test_span_lengths_are_an_argument():
    model = pii.SpanField({"phone": {"one": 9.0}}, unseen=0.0)
    assert model.spans("123") == []
    assert pii.SpanField(model.weights, 0.0, (3, 200)).spans("123") == [(0, 3, "phone")]
    long = "1" * 150
    assert model.spans(long) == [] and pii.SpanField(model.weights, 0.0, (3, 200)).spans(long) == [(0, 150, "phone")]


# quality classifier

def test_trees_equal_a_walk_and_learn():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(600, len(quality.FEATURES)))
    y = ((x[:, 2] > 0.3) ^ (x[:, 5] > 0)).astype(float)
    model = quality.grow(x, y)
    score = model.score(x)
    assert ((score >= 0.5) == (y > 0)).mean() > 0.97

    def walk(row):
        total = model.start
        for f, c, leaf in zip(model.feature, model.cut, model.leaf):
            node = 0
            while node < len(f):
                node = 2 * node + (2 if row[f[node]] > c[node] else 1)
            total += leaf[node - len(f)]
        return 1 / (1 + np.exp(-total))

    assert np.allclose(score[:50], [walk(r) for r in x[:50]])


def test_classifier_defined_cases(spark):
    labels = spark.createDataFrame([(1, 1), (None, 0), (2, None), (1, 1)], "doc_id long, quality int")
    docs = odd_rows(spark)
    model = quality.fit(docs, labels)
    for m in (model, quality.fit(docs.limit(0), labels.limit(0))):
        scored = quality.classify(docs, m)
        assert scored.columns == [*docs.columns, "_score_"]
        scores = [r["_score_"] for r in scored.collect()]
        assert len(scores) == 13 and all(0 <= s <= 1 for s in scores) and {r["_score"] for r in scored.collect()} == {1, 2, 3}
    assert quality.classify(docs.limit(0), model).count() == 0


def test_samples_are_bounded_before_they_reach_the_driver(spark, monkeypatch):
    rows = [(k % 3, "\n".join(f"line {j} of text {k}" for j in range(30))) for k in range(300)]
    docs, labels = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame([(k, k % 2) for k in range(3)], "doc_id long, quality int")
    seen = []
    monkeypatch.setattr(quality, "grow", lambda x, y: seen.append(len(x)))
    quality.fit(docs, labels, rows=20)
    assert 0 < seen[0] <= 20
    monkeypatch.setattr(rules, "learn", lambda sequences, good: seen.append([len(x) for x in sequences]))
    monkeypatch.setattr(rules, "SAMPLE_LINES", 7)
    rules.fit(docs, labels, rows=20)
    assert seen[1] == [7] * 20


def test_held_out_rows_are_not_learned_from(spark):
    docs = spark.createDataFrame([(k, "good text" if k % 2 else "### bad") for k in range(200)], SCHEMA)
    held = [k for k in range(200) if zlib.crc32(str(k).encode()) % 5 == 0]
    model = quality.fit(docs, spark.createDataFrame([(k, k % 2) for k in held], "doc_id long, quality int"))
    assert model.start == 0 and not model.leaf.any()


# language

def test_trigram_counts_equal_brute_force():
    texts = ["Ab, cd! é", "", "123", "a", "Straße 𝔘x", "one two  one"]
    found, counts = language.trigrams(texts)
    for text, row in zip(texts, counts):
        low = "".join(c.lower() if c.isalpha() else " " for c in text)
        padded = " " + " ".join(low.split()) + " "
        want = Counter(padded[i:i + 3] for i in range(len(padded) - 2) if padded[i + 1] != " ")
        got = {"".join(chr(c) if c else " " for c in g): int(n) for g, n in zip(found.tolist(), row) if n}
        assert got == dict(want), text


def test_thousands_of_letters_equal_brute_force(monkeypatch):
    rng = np.random.default_rng(5)
    texts = ["".join(map(chr, 0x4E00 + rng.integers(0, 6000, 9000))) + " and more" for _ in range(3)] + ["", "plain text"]
    grams, own, place, counts = language.tallies(texts)  # a cube of 6,000 letters has 2.16e11 cells
    want = Counter((k, (" " + t + " ")[i:i + 3]) for k, t in enumerate(texts) if t for i in range(len(t)) if t[i] != " ")
    names = ["".join(chr(c) if c else " " for c in g) for g in grams.tolist()]
    assert {(int(k), names[p]): int(n) for k, p, n in zip(own, place, counts)} == dict(want)
    whole = language.bundles(texts, 64)
    monkeypatch.setattr(language, "CUBE", 0)
    monkeypatch.setattr(language, "BLOCK", 100)
    assert (language.bundles(texts, 64) == whole).all() and not whole[3].any()


def test_binding_is_a_product_of_rotated_letters():
    v = {c: language.letter_vectors(np.array([ord(c)]), 64)[0] for c in "abc"}
    got = language.gram_vectors(np.array([[97, 98, 99]], np.uint32), 64)[0]
    assert (got == np.roll(v["a"], 2) * np.roll(v["b"], 1) * v["c"]).all()


def test_language_defined_cases(spark, monkeypatch):
    rows = [(k, "the cat and the dog with them " * 3, "en") for k in range(5)] + [(k + 9, "le chat et le chien avec eux " * 3, "fr") for k in range(5)]
    docs = spark.createDataFrame(rows + [(50, "unlabelled", None), (51, None, "fr")], SCHEMA + ", lang string")
    profiles = language.fit(docs)
    assert profiles.languages == ["en", "fr"]
    got = language.identify(spark.createDataFrame([(1, "the dog and them"), (2, "et le chien"), (3, None), (4, "12 !"), (5, "")], SCHEMA), profiles)
    assert [r["_lang"]["lang_pred"] for r in got.orderBy("doc_id").collect()] == ["en", "fr", "und", "und", "und"]
    found = language.identify(odd_rows(spark), profiles).collect()
    assert len(found) == 13 and all(0 <= r["_lang"]["score"] <= 1 for r in found)
    own = language.identify(odd_rows(spark).withColumnRenamed("_score", "_lang"), profiles)
    assert own.columns[-2:] == ["a.b", "_lang_"] and {r["_lang"] for r in own.collect()} == {1, 2, 3}
    monkeypatch.setattr(language, "MOST_LANGUAGES", 1)
    with pytest.raises(ValueError, match="more than 1 values"):
        language.fit(docs)
    nothing = language.fit(docs.limit(0))
    assert language.identify(docs, nothing).first()["_lang"]["lang_pred"] == "und"


# packing

def test_pieces_are_powers_of_two():
    for n in [1, 2, 3, 2047, 2048, 2049, 9999]:
        lengths = packing.piece_lengths(n)
        assert sum(lengths) == n and all(x & (x - 1) == 0 and x <= 2048 for x in lengths) and lengths == sorted(lengths, reverse=True)


def test_packing_round_trip(spark, tmp_path):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = ODD + ["hello <|endoftext|> x", "<|endoftext|><|endoftext|> a<|endoftext|>b <|endoftext| >", "it's 12's  \n\n x" * 700]
    given = spark.createDataFrame([(k, t, k * 10, "own") for k, t in enumerate(texts)], SCHEMA + ", length int, _piece string")
    both = packing.pack(given)
    assert both.columns[:3] == ["doc_id", "length", "_piece"] and both.filter("length <> doc_id * 10 or _piece <> 'own'").count() == 0
    docs = given.select("doc_id", "text")
    pieces = packing.pack(docs).collect()
    assert [r["length_"] for r in both.orderBy("doc_id", "start").collect()] == [p["length"] for p in sorted(pieces, key=lambda p: (p["doc_id"], p["start"]))]
    for k, text in enumerate(texts):
        own = sorted((p for p in pieces if p["doc_id"] == k), key=lambda p: p["start"])
        ids = [i for p in own for i in p["ids"]]
        assert ids == [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        assert [p["start"] for p in own] == list(np.cumsum([0, *(p["length"] for p in own)])[:-1])
        assert all(p["doc_tokens"] == len(ids) and p["ids_crc32"] == zlib.crc32(np.array(p["ids"], "<u4").tobytes()) for p in own)
    assert len({p["sequence_id"] for p in pieces}) == len(pieces) and {p["offset"] for p in pieces} == {0}
    assert packing.pack(odd_rows(spark)).filter("doc_id = 3").count() == 3  # "a" and the end id are one piece of two, in each of three rows
    assert packing.pack(docs.limit(0)).count() == 0
    packing.write_buckets(packing.pack(docs), str(tmp_path / "buckets"))
    buckets = spark.read.parquet(str(tmp_path / "buckets"))
    assert buckets.count() == len(pieces) and buckets.filter("bucket <> length").count() == 0
    assert buckets.select("bucket").distinct().count() == len({p["length"] for p in pieces})
