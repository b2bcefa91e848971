"""Robust covariance: the minimum-determinant estimate by concentration steps, as combinable aggregates and quantile cuts.

From several hashed halves of a session's rows, each step takes the mean and covariance of the rows in the half, measures all
rows by them, and keeps the half that lies nearest. The start whose covariance ends with the smallest determinant wins;
its estimate is scaled by the median distance and taken anew from all rows that are not far by it. Every step is one
aggregate and one exact quantile per session, for all starts together, so a session of any size is never in one place.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from fingertrail.functions.numeric import finite_or_zero
from fingertrail.operators.anomaly import _inverse
from fingertrail.operators.groups import Quantile, Touches

SESSION = ["session_id"]
#: Share of rows in a half, rows that count for the final estimate (by the distance's distribution), starts and steps.
SUPPORT, NEAR, STARTS, STEPS = 0.5, 0.975, 2, 3
#: Places of the hashed start.
PLACES = 1_000_003


def chi_squared(q: float, degrees: int) -> float:
    """The value below which a chi-squared variable lies with probability q."""
    def below(x: float) -> float:
        a, term = degrees / 2, 1.0
        total, k = 1.0, a
        while term > 1e-17 * total:
            k += 1
            term *= x / 2 / k
            total += term
        return total * math.exp(-x / 2 + a * math.log(x / 2) - math.lgamma(a + 1))

    low, high = 1e-12, 10.0 * degrees + 100
    while high - low > 1e-13 * high:
        middle = (low + high) / 2
        low, high = (middle, high) if below(middle) < q else (low, middle)
    return (low + high) / 2


@F.pandas_udf(DoubleType())
def _determinant(flat: pd.Series) -> pd.Series:
    """Determinants of square matrices given row by row; one small matrix per session."""
    def of(values):
        size = int(round(len(values) ** 0.5))
        return float(np.linalg.det(np.asarray(values, dtype=float).reshape(size, size)))
    return flat.map(of)


def _moments(rows: Touches, n: int, subsets: dict[str, Column]) -> DataFrame:
    """Per session and subset the means (_m), covariances (_c, row by row) and their inverse (_i)."""
    def values(kept: Column, k: int) -> Column:
        return F.when(kept, F.col(f"_f{k}"))

    columns = {f"m{s}_{a}": F.avg(values(kept, a)) for s, kept in subsets.items() for a in range(n)}
    columns |= {f"c{s}_{a}_{b}": F.covar_samp(values(kept, a), values(kept, b)) for s, kept in subsets.items() for a in range(n) for b in range(a, n)}
    table = rows.aggregate(SESSION, **columns)
    cell = lambda s, a, b: F.coalesce(F.col(f"c{s}_{min(a, b)}_{max(a, b)}"), F.lit(0.0))
    table = table.select(*SESSION, *[c for s in subsets for c in (
        F.array(*[F.coalesce(F.col(f"m{s}_{a}"), F.lit(0.0)) for a in range(n)]).alias(f"_m{s}"),
        F.array(*[cell(s, a, b) for a in range(n) for b in range(n)]).alias(f"_c{s}"))])
    return table.select("*", *[_inverse(F.col(f"_c{s}")).alias(f"_i{s}") for s in subsets])


def _squared(n: int, mean: Column, inverse: Column, scale: Column | None = None) -> Column:
    off = [F.col(f"_f{k}") - F.get(mean, k) for k in range(n)]
    total = F.lit(0.0)
    for a in range(n):
        for b in range(n):
            total = total + off[a] * F.get(inverse, a * n + b) * off[b]
    total = F.greatest(total, F.lit(0.0))
    return total if scale is None else total / scale


def robust_estimate(touches: Touches, features: list[str], key: str, starts: int = STARTS, steps: int = STEPS, support: float = SUPPORT) -> DataFrame:
    """Per session the mean (_m) and the inverse (_i) of the robust covariance; missing and infinite values count as 0.

    `key` is an integer that tells rows apart; it alone decides the starts. A session whose halves have no spread has an
    inverse in the sense of least squares.
    """
    n, names = len(features), [str(s) for s in range(starts)]
    rows = touches.select("session_id", F.col(key).cast("long").alias("_key"), *[finite_or_zero(F.col(f)).alias(f"_f{k}") for k, f in enumerate(features)])
    place = lambda s: F.pmod(F.col("_key") * 7919 + int(s) * 104729, F.lit(PLACES))
    rows = rows.with_columns(**{f"_in{s}": F.coalesce(place(s) < int(PLACES * support), F.lit(False)) for s in names}).materialise()
    for _ in range(steps):
        table = _moments(rows, n, {s: F.col(f"_in{s}") for s in names})
        measured = rows.attach(table, SESSION).with_columns(**{f"_d{s}": _squared(n, F.col(f"_m{s}"), F.col(f"_i{s}")) for s in names})
        measured = measured.totals(SESSION, **{f"_l{s}": Quantile(F.col(f"_d{s}"), support) for s in names})
        rows = measured.with_columns(**{f"_in{s}": F.coalesce(F.col(f"_d{s}") <= F.col(f"_l{s}"), F.lit(False)) for s in names}).drop(
            *[f"_{c}{s}" for s in names for c in "mcidl"]).materialise()
    table = _moments(rows, n, {s: F.col(f"_in{s}") for s in names})
    sized = table.select("*", *[_determinant(F.col(f"_c{s}")).alias(f"_v{s}") for s in names])
    least = F.least(*[F.col(f"_v{s}") for s in names])
    chosen = [F.coalesce(*[F.when(F.col(f"_v{s}") == least, F.col(f"_{c}{s}")) for s in names]).alias(f"_{c}") for c in "mi"]
    raw = rows.attach(sized.select(*SESSION, *chosen), SESSION).with_columns(_d=_squared(n, F.col("_m"), F.col("_i"))).totals(
        SESSION, _half=Quantile(F.col("_d"), 0.5))
    scale = F.when(F.col("_half") > 0, F.col("_half") / chi_squared(0.5, n)).otherwise(1.0)
    near = raw.with_columns(_in=F.coalesce(F.col("_d") / scale < chi_squared(NEAR, n), F.lit(False)))
    return _moments(near, n, {"": F.col("_in")}).select(*SESSION, "_m", "_i")


def robust_distance(touches: Touches, features: list[str], key: str, share: float = 0.1, starts: int = STARTS, steps: int = STEPS) -> Touches:
    """Distance of each event from its session's robust centre (anomaly_score), and the farthest `share` as outliers."""
    n = len(features)
    table = robust_estimate(touches, features, key, starts, steps)
    rows = touches.with_columns(**{f"_f{k}": finite_or_zero(F.col(f)) for k, f in enumerate(features)}).attach(table, SESSION)
    rows = rows.with_columns(anomaly_score=F.sqrt(_squared(n, F.col("_m"), F.col("_i"))))
    rows = rows.totals(SESSION, _limit=Quantile(F.col("anomaly_score"), 1 - share))
    return rows.with_columns(anomaly_type=F.when(F.col("anomaly_score") > F.col("_limit"), "outlier").otherwise("normal")).drop(
        "_m", "_i", "_limit", *[f"_f{k}" for k in range(n)])
