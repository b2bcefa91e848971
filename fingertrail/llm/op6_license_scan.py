"""Licence scan: MinHash bands over overlapping windows of words retrieve notices, exact containment verifies them.

Texts and notices are cut into words, neighbouring words are hashed to shingles. Notices are covered by windows at every
word, texts by windows at every fourth. Two windows share a band if the same shingle has the smallest value
under the band's permutation, which happens with a probability of their similarity s; with 16 bands of one row
a window is found with 1 - (1 - s)^16: 0.9992 at s = 4/11, where a notice of five words stands whole in a window.
Each candidate is then compared with the notice's exact shingles in its surroundings. All of it is
DataFrame functions; windows with fewer notice shingles than
any notice's containment asks for are left out at once.
"""

from __future__ import annotations

import math
import random

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fingertrail.llm.catalog import query
from fingertrail.llm.common import table

WINDOW, STRIDE, BANDS = 12, 4, 16
#: Share of a notice's shingles that must stand in the text.
CONTAINMENT = 0.8
WORD = r"[a-z0-9]+(?:[.-][a-z0-9]+)*"

# Short public notices by which texts state their licence.
NOTICES = {
    "MIT": ["Released under the MIT License.", "Licensed under the MIT License.",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
            "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
            "copies of the Software"],
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0.",
                   "you may not use this file except in compliance with the License. You may obtain a copy of the "
                   "License at http://www.apache.org/licenses/LICENSE-2.0"],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3.",
                "it under the terms of the GNU General Public License as published by the Free Software Foundation, "
                "either version 3 of the License, or (at your option) any later version."],
    "GPL-2.0": ["it under the terms of the GNU General Public License as published by the Free Software Foundation; "
                "either version 2 of the License, or (at your option) any later version.",
                "This work is licensed under the GNU General Public License, version 2."],
    "LGPL-3.0": ["it under the terms of the GNU Lesser General Public License as published by the Free Software "
                 "Foundation, either version 3 of the License, or (at your option) any later version."],
    "AGPL-3.0": ["it under the terms of the GNU Affero General Public License as published by the Free Software "
                 "Foundation, either version 3 of the License, or (at your option) any later version."],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
    "BSD": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided "
            "that the following conditions are met"],
    "ISC": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
            "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."],
    "Unlicense": ["This is free and unencumbered software released into the public domain."],
    "CC0-1.0": ["To the extent possible under law, the author has waived all copyright and related or neighboring "
                "rights to this work.", "Licensed under CC0 1.0 Universal."],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.",
                  "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0.",
                     "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.",
                     "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
}


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(f"({WORD})"), F.lit(1))


def pairs(words: Column, join) -> Column:
    """`join` of each two neighbouring words."""
    n = F.greatest(F.size(words) - 1, F.lit(0))
    return F.zip_with(F.slice(words, F.lit(1), n), F.slice(words, F.lit(2), n), join)


def hashed(a: Column, b: Column) -> Column:
    return F.xxhash64(a, b)


def seeds(bands: int = BANDS) -> list[int]:
    draw = random.Random(11)
    return [draw.getrandbits(64) - (1 << 63) for _ in range(bands)]


def band_keys(hashes: Column) -> Column:
    """One key per band: its number with the smallest shingle hash after the band's exclusive or."""
    return F.transform(F.array(*map(F.lit, seeds())), lambda c, j: F.xxhash64(
        j, F.array_min(F.transform(hashes, lambda h: h.bitwiseXOR(c)))))


def notice_windows(spark: SparkSession, notices: dict[str, list[str]]) -> DataFrame:
    """Rows of notice windows: license_id, the notice's words and exact shingles, the window's offset and its hashes."""
    rows = [F.struct(F.lit(name).alias("license_id"), F.lit(text).alias("notice")) for name, texts in notices.items() for text in texts]
    frame = spark.range(1).select(F.inline(F.array(*rows))).withColumn("own", words_of(F.col("notice")))
    offsets = F.sequence(F.lit(0), F.greatest(F.size("own") - WINDOW, F.lit(0)))
    frame = frame.withColumn("exact", F.array_distinct(pairs(F.col("own"), lambda a, b: F.concat_ws(" ", a, b))))
    return frame.select("license_id", "own", "exact", F.explode(offsets).alias("offset")).withColumn(
        "hashes", pairs(F.slice("own", F.col("offset") + 1, F.lit(WINDOW)), hashed))


def scan(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", notices: dict[str, list[str]] | None = None,
         containment: float = CONTAINMENT) -> DataFrame:
    """One row per document and licence found: doc_id, license_id, containment (of the best notice), first_word (of
    the earliest region that reaches it, from 0).

    Null, empty and one-word texts hold nothing. Repeated rows give repeated results. The notices are a fixed
    list whose windows, a few thousand keys, are literals and a broadcast table.
    """
    spark = docs.sparkSession
    known = notice_windows(spark, NOTICES if notices is None else notices)
    keyed = known.select("license_id", "own", "exact", "offset", F.explode(F.array_distinct(band_keys(F.col("hashes")))).alias("key"))
    keys = [r["key"] for r in keyed.select("key").distinct().orderBy("key").collect()]
    shingles = [r["h"] for r in known.select(F.explode("hashes").alias("h")).distinct().orderBy("h").collect()]
    longest = max((r["n"] for r in known.select(F.max(F.size("own")).alias("n")).collect()), default=0) or 0
    pad = WINDOW + longest // 8
    reach = longest + pad
    # in the window that a notice fills best stand so many of its shingles, or of a full window's
    counts = [min(r["n"], WINDOW - 1) for r in known.select(F.size("exact").alias("n")).distinct().collect()]
    fewest = min((math.ceil(containment * n) for n in counts), default=1)

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(doc_id).alias("doc_id"), words_of(F.col(text)).alias("words"))
    rows = rows.withColumn("hashes", pairs(F.col("words"), hashed))
    rows = rows.withColumn("known", F.transform("hashes", lambda h: h.isin(shingles)))
    hits = F.filter(F.transform("known", lambda k, i: F.when(k, i)), lambda i: i.isNotNull())
    starts = F.array_distinct(F.flatten(F.transform(hits, lambda i: F.transform(
        F.sequence(F.ceil(F.greatest(i - (WINDOW - 2), F.lit(0)) / STRIDE), F.floor(i / STRIDE)),
        lambda k: (k * STRIDE).cast("int")))))
    dense = F.filter(starts, lambda s: F.size(F.filter(F.slice("known", s + 1, F.lit(WINDOW - 1)), lambda k: k)) >= fewest)
    found = F.filter(
        F.transform(dense, lambda s: F.struct(s.alias("start"), F.filter(
            band_keys(F.slice("hashes", s + 1, F.lit(WINDOW - 1))), lambda k: k.isin(keys)).alias("keys"))),
        lambda w: F.size(w["keys"]) > 0)
    windows = rows.select("row", "doc_id", F.explode(F.transform(found, lambda w: F.struct(
        w["start"].alias("start"), w["keys"].alias("keys"), F.greatest(w["start"] - reach, F.lit(0)).alias("from"),
        F.slice("words", F.greatest(w["start"] - reach, F.lit(0)) + 1, F.lit(2 * reach + WINDOW)).alias("around")))).alias("w"))
    candidates = (windows.select("row", "doc_id", "w.start", "w.from", "w.around", F.explode("w.keys").alias("key"))
                  .join(F.broadcast(keyed), "key"))
    begin = F.greatest(F.col("start") - F.col("offset") - pad, F.lit(0))
    region = F.slice("around", F.greatest(begin - F.col("from"), F.lit(0)) + 1, F.size("own") + 2 * pad)
    seen = pairs(region, lambda a, b: F.concat_ws(" ", a, b))
    shared = F.size(F.array_intersect("exact", seen)) / F.size("exact")
    places = F.array_compact(F.transform(seen, lambda s, i: F.when(F.array_contains("exact", s), begin + i)))
    checked = candidates.select("row", "doc_id", "license_id", begin.cast("long").alias("first_word"), shared.alias("containment"),
                                F.when(shared >= containment, places).alias("places"))
    found = checked.filter(F.col("containment") >= containment).groupBy("row", "doc_id").agg(
        F.collect_set(F.struct("containment", (-F.col("first_word")).alias("before"), "license_id", "places")).alias("all"))
    # versions of one notice differ in few shingles: of notices with most shingles at the same places only the closest stays
    kept = F.filter("all", lambda c: ~F.exists("all", lambda d: (d["containment"] > c["containment"])
                                               & (F.abs(d["before"] - c["before"]) <= longest + 2 * pad)
                                               & (2 * F.size(F.array_intersect(c["places"], d["places"])) > F.size(c["places"]))))
    best = F.transform(F.array_distinct(F.transform(kept, lambda c: c["license_id"])), lambda name: F.array_max(
        F.filter(kept, lambda c: c["license_id"] == name)))
    return found.select("doc_id", F.explode(best).alias("b")).select(
        "doc_id", "b.license_id", "b.containment", (-F.col("b.before")).alias("first_word"))


@query("op6_license_scan")
def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))
