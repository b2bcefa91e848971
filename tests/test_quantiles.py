"""Exact quantiles of groups of any size beside Spark's own percentile."""

import pytest
from pyspark.sql import functions as F

from fingertrail.operators import groups
from fingertrail.operators.groups import Quantile, hot_quantiles, table_quantiles


def frame(spark, rows):
    noise = F.xxhash64("id") / F.lit(2.0**63)
    return spark.range(rows).select(
        F.when(F.col("id") % 7 < 4, "a").when(F.col("id") % 7 < 6, "b").alias("g"), (F.col("id") % 3).cast("int").alias("h"),
        F.when(F.col("id") % 5 > 0, noise).alias("u"), F.round(noise, 1).alias("w"), (noise * noise * 1e6).alias("z"),
        F.lit(None).cast("double").alias("none"), F.when(F.col("id") % 50 == 0, float("nan")).otherwise(noise).alias("odd"))


SPECS = {"u25": ("u", 0.25), "u75": ("u", 0.75), "u999": ("u", 0.999), "w50": ("w", 0.5), "z95": ("z", 0.95), "z0": ("z", 0.0), "z1": ("z", 1.0), "n": ("none", 0.5)}


@pytest.mark.parametrize("rows", [50, 3000, 40_000])
def test_quantiles_equal_percentile(spark, rows, monkeypatch):
    df, stored = frame(spark, rows), []
    monkeypatch.setattr(groups, "store", lambda t: stored.append(t.columns) or groups_store(t))
    wanted = {name: Quantile(F.col(c), q) for name, (c, q) in SPECS.items()}
    got = {(r["g"], r["h"]): r for r in hot_quantiles(df, ["g", "h"], wanted, 500).collect()}
    assert len(stored) == 3  # brackets, the ranked values, the result, for any number of quantiles
    for r in df.groupBy("g", "h").agg(*[F.percentile(c, F.lit(q)).alias(name) for name, (c, q) in SPECS.items()]).collect():
        for name in SPECS:
            a, b = got[r["g"], r["h"]][name], r[name]
            assert a == b or abs(a - b) <= 1e-12 * max(1.0, abs(b)), (name, a, b)


groups_store = groups.store


def test_only_bracketed_values_are_ranked(spark, monkeypatch):
    kept = []
    monkeypatch.setattr(groups, "_range_chunks", lambda df, *a, f=groups._range_chunks, **k: kept.append(df.count()) or f(df, *a, **k))
    one = table_quantiles(frame(spark, 60_000), {"m": Quantile(F.col("z"), 0.5)}, hot_rows=100).first()
    assert kept and kept[0] < 0.04 * 60_000
    assert one["m"] == frame(spark, 60_000).agg(F.percentile("z", F.lit(0.5))).first()[0]


def test_a_missed_bracket_is_found_out(spark, monkeypatch):
    monkeypatch.setattr(groups, "MARGIN", -0.2)  # brackets that hold nothing
    got = hot_quantiles(frame(spark, 9000), ["g"], {"m": Quantile(F.col("z"), 0.5)}, 500).collect()
    want = {r["g"]: r["m"] for r in frame(spark, 9000).groupBy("g").agg(F.percentile("z", F.lit(0.5)).alias("m")).collect()}
    assert {r["g"]: r["m"] for r in got} == want


def test_not_a_number_counts_as_the_largest(spark):
    got = hot_quantiles(frame(spark, 9000), ["g"], {"m": Quantile(F.col("odd"), 0.6)}, 500).collect()
    want = {r["g"]: r["m"] for r in frame(spark, 9000).groupBy("g").agg(F.percentile("odd", F.lit(0.6)).alias("m")).collect()}
    assert {r["g"]: r["m"] for r in got} == pytest.approx(want, nan_ok=True)
