"""Secret scan: plain patterns, and a battery of randomness tests over other long tokens.

Tokens of 20 or more characters with a digit, '=' only as their closing padding, are tested for what a random key of their inferred encoding shows: a
chi-squared test of a uniform alphabet, a runs test above and below the alphabet's middle, and a serial
correlation of neighbouring characters, joined into one probability by Fisher's method. Within each class of encoding and length the
step-up procedure of Benjamini and Hochberg picks the tokens that are structured rather than random, with a
bounded share of false picks; the others are secrets. Probabilities are rounded up to a grid, so the procedure
needs one count per class and grid step instead of a global ranking. A token that mixes + or / with - or _ fits no
encoding; its parts without the one pair, without the other, and without both are tested instead, and a random part
inside another one is left out. All of it is DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

from fingertrail.llm.catalog import query
from fingertrail.llm.common import table
from fingertrail.session import store

#: Largest expected share of random tokens among those set aside as structured.
FALSE_SHARE = 0.05
#: Steps of the grid for each factor e of probability, and its last step.
GRID, LAST = 20, 1500
#: A secret has at least so many different characters.
DISTINCT = 8

# The base patterns, kinds in their order of output.
KINDS = ["assign", "access", "hex"]
PATTERNS = {
    "assign": r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": r"AKIA[A-Z0-9]+",
    "hex": r"[0-9a-f]{24,}",
    "random": r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*+[0-9])(?:[A-Za-z0-9+/_-]{20,}+(?:=++(?![A-Za-z0-9+/_-]))?|"
              + "|".join(rf"[A-Za-z0-9+/_-]{{{n}}}={{{20 - n},}}+(?![A-Za-z0-9+/_-])" for n in range(19, 13, -1)) + ")",
}
#: Parts of a token that mixes the last characters of two alphabets.
PARTS = ["[A-Za-z0-9+/]{14,}+=*", "[A-Za-z0-9_-]{14,}+=*", "[A-Za-z0-9]{14,}+=*"]
# Alphabets of encodings, from the narrowest.
ALPHABETS = {
    "hex": "0123456789abcdef",
    "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
    "base64url": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_",
}


def matches(text: Column, number: int, pattern: str) -> Column:
    """Structs of the kind's number, the match's place, the characters between it and the one before, and its text."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.transform(F.split(text, pattern, -1), F.length)
    rows = F.transform(found, lambda m, i: F.struct(F.lit(number).alias("kind"), i.alias("place"),
                                                    F.get(gaps, i).alias("gap"), m.alias("found")))
    return F.when(text.rlike(pattern), rows)


def normal_tail(z: Column) -> Column:
    """Probability above z, by the logistic approximation (error below 0.0002)."""
    return 1 / (1 + F.exp(1.5976 * z + 0.070565 * z * z * z))


def two_sided(z: Column) -> Column:
    return 2 * normal_tail(F.least(F.abs(z), F.lit(30.0)))


def parts(tokens: DataFrame) -> DataFrame:
    """row, start, end and found of the parts of 20 or more characters with a digit of all mixed tokens, and whole, the token's start."""
    mixed = tokens.filter(F.col("found").rlike("[+/]") & F.col("found").rlike("[_-]"))
    cut = F.flatten(F.array_compact(F.array(*[matches(F.col("found"), k, pattern) for k, pattern in enumerate(PARTS)])))
    cut = mixed.select("row", "doc_id", F.col("start").alias("whole"), F.explode(cut).alias("m")).select("row", "doc_id", "whole", "m.*")
    size = F.length("found")
    ended = F.col("whole") + F.sum(F.col("gap") + size).over(Window.partitionBy("row", "whole", "kind").orderBy("place"))
    cut = cut.select("row", "doc_id", (ended - size).cast("int").alias("start"), ended.cast("int").alias("end"), "found", "whole")
    return cut.filter((F.length("found") >= 20) & F.col("found").rlike("[0-9]")).dropDuplicates(["row", "start", "end"])


def with_battery(tokens: DataFrame, token: str = "found") -> DataFrame:
    """tokens with encoding, length class and the joint probability `p` of the three tests if it were random."""
    raw = F.col(token)
    bare = F.regexp_replace(raw, "=+$", "")
    encoding = (F.when(raw.rlike("^[0-9]+$"), F.lit(None)).when(raw.rlike("^([0-9a-f]+|[0-9A-F]+)$"), "hex")
                .when(raw.rlike("^[A-Z2-7]+=*$"), "base32").when(raw.rlike("^[A-Za-z0-9+/]+=*$"), "base64")
                .when(raw.rlike("^[A-Za-z0-9_-]+=*$"), "base64url"))
    alphabet = F.coalesce(*[F.when(F.col("encoding") == k, F.lit(v)) for k, v in ALPHABETS.items()])
    rows = tokens.withColumn("encoding", encoding).filter(F.col("encoding").isNotNull())
    rows = rows.withColumn("alphabet", alphabet).withColumn("bare", F.when(F.col("encoding") == "hex", F.lower(bare)).otherwise(bare))
    codes = F.transform(F.split("bare", ""), lambda c: (F.instr(F.col("alphabet"), c) - 1).cast("double"))
    rows = rows.withColumn("codes", codes).withColumn("n", F.size("codes").cast("double")).withColumn(
        "size", F.length("alphabet").cast("double"))
    # uniform alphabet: squared counts summed over characters, then the cube-root transform to a normal score
    squares = F.aggregate(F.array_distinct("codes"), F.lit(0.0),
                          lambda s, c: s + F.pow(F.size(F.filter("codes", lambda x: x == c)).cast("double"), F.lit(2.0)))
    chi, free = F.col("size") / F.col("n") * squares - F.col("n"), F.col("size") - 1
    p_chi = normal_tail((F.cbrt(chi / free) - (1 - 2 / (9 * free))) / F.sqrt(2 / (9 * free)))
    # runs above and below the middle of the alphabet
    middle = F.col("size") / 2
    high = F.aggregate("codes", F.lit(0.0), lambda s, c: s + F.when(c >= middle, 1.0).otherwise(0.0))
    ahead, behind = F.slice("codes", F.lit(2), F.size("codes") - 1), F.slice("codes", F.lit(1), F.size("codes") - 1)
    turns = F.aggregate(F.zip_with(ahead, behind, lambda a, b: F.when((a >= middle) != (b >= middle), 1.0).otherwise(0.0)),
                        F.lit(1.0), lambda s, t: s + t)
    rows = rows.withColumns({"chi": p_chi, "high": high, "turns": turns})
    both = 2 * F.col("high") * (F.col("n") - F.col("high"))
    spread = F.sqrt(both * (both - F.col("n")) / (F.pow("n", F.lit(2.0)) * (F.col("n") - 1)))
    p_runs = F.when(both > F.col("n"), two_sided((F.col("turns") - both / F.col("n") - 1) / spread)).otherwise(1e-6)
    # serial correlation
    mean = F.aggregate("codes", F.lit(0.0), lambda s, c: s + c) / F.col("n")
    rows = rows.withColumns({"runs": p_runs, "mean": mean})
    spread = F.aggregate("codes", F.lit(0.0), lambda s, c: s + F.pow(c - F.col("mean"), F.lit(2.0)))
    product = F.aggregate(F.zip_with(ahead, behind, lambda a, b: (a - F.col("mean")) * (b - F.col("mean"))), F.lit(0.0), lambda s, x: s + x)
    serial = F.when(spread > 0, two_sided(product / spread * F.sqrt("n"))).otherwise(1e-6)
    half = -sum((F.log(F.greatest(p, F.lit(1e-12))) for p in (F.col("chi"), F.col("runs"), serial)), F.lit(0.0))
    return rows.withColumns({
        "length_class": F.floor(F.log2("n") * 2).cast("int"), "distinct": F.size(F.array_distinct("codes")),
        "p": F.exp(-half) * (1 + half + half * half / 2)}).drop("codes", "alphabet", "bare", "chi", "high", "turns", "runs", "mean", "size")


def structured(tested: DataFrame, share: float = FALSE_SHARE) -> DataFrame:
    """Per encoding and length class the first grid step whose tokens are structured; at most one row per class."""
    steps = tested.groupBy("encoding", "length_class", "step").agg(F.count("*").alias("count"))
    own = Window.partitionBy("encoding", "length_class")
    ranked = steps.withColumns({"rank": F.sum("count").over(own.orderBy(F.col("step").desc())), "all": F.sum("count").over(own)})
    picked = ranked.filter(F.exp(-F.col("step") / F.lit(float(GRID))) <= share * F.col("rank") / F.col("all"))
    return picked.groupBy("encoding", "length_class").agg(F.min("step").alias("first_step"))


def find(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", share: float = FALSE_SHARE) -> DataFrame:
    """One row per document: doc_id and `spans`, structs of start, kind number, kind, end and base, in this order.

    Code points, end exclusive. Random spans that overlap a plain one are left out. A null or empty text has
    no spans; repeated rows, and rows without an id, give a row each. Random parts of one token may overlap each other.
    """
    value = F.col(text)
    kinds = [*KINDS, "random"]
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(doc_id).alias("doc_id"), F.flatten(F.array_compact(
        F.array(*[matches(value, k, PATTERNS[kind]) for k, kind in enumerate(kinds)]))).alias("all"))
    rows = rows.select("row", "doc_id", F.explode_outer("all").alias("m")).select("row", "doc_id", "m.*").repartition("row")
    size = F.length("found")
    ended = F.sum(F.col("gap") + size).over(Window.partitionBy("row", "kind").orderBy("place"))
    secret = F.regexp_extract("found", PATTERNS["assign"], 2)
    holds = F.when(F.col("kind") == 0, F.length(secret) >= 6).when(F.col("kind") == 1, size >= 20).otherwise(F.col("kind") == 2)
    rows = store(rows.select("row", "doc_id", "kind", (ended - size).cast("int").alias("start"), ended.cast("int").alias("end"),
                             "found").withColumn("holds", holds))
    tokens = rows.filter("kind = 3")
    split = parts(tokens)
    tested = with_battery(tokens.select("row", "start", "end", "found", F.col("start").alias("whole")).unionByName(split.drop("doc_id")))
    tested = tested.withColumn("step", F.least(F.floor(-F.log("p") * GRID), F.lit(LAST)).cast("int"))
    limits = structured(tested, share)  # at most one row per encoding and length class
    random = (tested.join(F.broadcast(limits), ["encoding", "length_class"], "left")
              .filter((F.col("distinct") >= DISTINCT) & (F.col("first_step").isNull() | (F.col("step") < F.col("first_step"))))
              .select("row", "start", "end", "whole", F.lit(3).alias("kind"), F.lit(True).alias("random")))
    outer = Window.partitionBy("row", "whole").orderBy("start", F.col("end").desc()).rowsBetween(Window.unboundedPreceding, -1)
    random = random.withColumn("reach", F.max("end").over(outer)).filter(F.col("reach").isNull() | (F.col("reach") < F.col("end")))
    every = rows.unionByName(split.drop("whole").withColumns({"kind": F.lit(3), "holds": F.lit(False)}))
    marked = every.join(random.drop("whole", "reach"), ["row", "start", "end", "kind"], "left")
    # a random span meets a plain one if one that begins no later reaches into it, or the next one begins before its end
    plain, along = (F.col("kind") < 3) & F.col("holds"), Window.partitionBy("row").orderBy("start")
    reach = F.max(F.when(plain, F.col("end"))).over(along.rangeBetween(Window.unboundedPreceding, 0))
    ahead = F.min(F.when(plain, F.col("start"))).over(along.rangeBetween(1, Window.unboundedFollowing))
    free = ~(F.coalesce(F.col("reach") > F.col("start"), F.lit(False)) | F.coalesce(F.col("ahead") < F.col("end"), F.lit(False)))
    marked = marked.withColumns({"reach": reach, "ahead": ahead})
    names = F.array(*map(F.lit, kinds))
    span = F.when(F.when(F.col("kind") == 3, F.col("random") & free).otherwise(F.col("holds")), F.struct(
        "start", "kind", F.get(names, F.col("kind")).alias("name"), "end", (F.col("kind") < 3).alias("base")))
    return marked.groupBy("row", "doc_id").agg(F.sort_array(F.collect_list(span)).alias("spans")).select("doc_id", "spans")


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["name"], s["start"], s["end"])), ",")


@query("op5_secret_scan")
def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["base"])
    counts = [F.size(F.filter(base, (lambda k: lambda s: s["kind"] == k)(k))).cast("long").alias(f"n_{kind}") for k, kind in enumerate(KINDS)]
    return found.select("doc_id", *counts, F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"),
                        joined(F.col("spans")).alias("spans"))
