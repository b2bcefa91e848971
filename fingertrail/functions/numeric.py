"""Guarded arithmetic: divisions that cannot fail, and cleaning of non-finite numbers."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from fingertrail.schema import EPS


def over_eps(part: Column, whole: Column) -> Column:
    """part / (whole + eps); null where that denominator is zero."""
    return F.try_divide(part, whole + F.lit(EPS))


def inverse(value: Column) -> Column:
    """1 / (1 + value)"""
    return F.try_divide(F.lit(1.0), F.lit(1.0) + value)


def step(column: str, previous: str) -> Column:
    """Difference to the previous row, 0 where there is none."""
    return F.coalesce(F.col(column) - F.col(previous), F.lit(0.0))


def clip(value: Column, low: float, high: float) -> Column:
    return F.least(F.greatest(value, F.lit(low)), F.lit(high))


def finite_or_zero(value: Column) -> Column:
    value = value.cast("double")
    bad = value.isNull() | F.isnan(value) | (F.abs(value) == F.lit(math.inf))
    return F.when(bad, F.lit(0.0)).otherwise(value)


def wrap_angle(value: Column) -> Column:
    """Angle difference brought back to [-pi, pi] by one turn."""
    return (F.when(value > math.pi, value - 2 * math.pi)
            .when(value < -math.pi, value + 2 * math.pi).otherwise(value))


def tidy(value: Column, digits: int = 6) -> Column:
    """Rounding that never yields a negative zero."""
    return F.when(F.abs(value) < 0.5 * 10 ** -digits, F.lit(0.0)).otherwise(F.round(value, digits))
