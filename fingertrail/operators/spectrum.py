"""Spectrum peak of series too long for one row.

A transform of length n is written as a convolution of length m = rows x columns >= 2n - 1, a power of
two (Bluestein's form), and each transform of length m as two rounds of short transforms: along the
columns of an index grid, a twiddle factor, then along its rows. Every short transform is one group of
about sqrt(m) values, so a series of 10^10 events needs groups of some 10^5 values; Spark shuffles the
grid between the rounds.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fingertrail.session import store


def _grid_transform(df: DataFrame, keys: list[str], sign: int) -> DataFrame:
    """Transform (keys, m, i, re, im) over i; ``m`` is a power of two. ``sign`` -1 is forward."""
    half = (F.log2("m") / 2).cast("int")
    grid = (df.withColumn("_c", F.pow(F.lit(2), half).cast("long"))
            .withColumn("_r", (F.col("m") / F.col("_c")).cast("long"))
            .withColumn("_i1", F.floor(F.col("i") / F.col("_c")).cast("long"))
            .withColumn("_i2", (F.col("i") % F.col("_c")).cast("long")))
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema.fields if f.name in keys)

    def columns(pdf: pd.DataFrame) -> pd.DataFrame:
        rows, cols, m = int(pdf["_r"].iloc[0]), int(pdf["_c"].iloc[0]), int(pdf["m"].iloc[0])
        i2 = int(pdf["_i2"].iloc[0])
        line = np.zeros(rows, dtype=complex)
        line[pdf["_i1"].to_numpy()] = pdf["re"].to_numpy() + 1j * pdf["im"].to_numpy()
        line = np.fft.fft(line) if sign < 0 else np.fft.ifft(line) * rows
        k1 = np.arange(rows)
        # the angle is reduced exactly in integers before it becomes a float
        line = line * np.exp(sign * 2j * np.pi * ((i2 * k1) % m) / m)
        return pd.DataFrame({**{k: pdf[k].iloc[0] for k in keys}, "m": m, "_r": rows, "_c": cols,
                             "_k1": k1, "_i2": i2, "re": line.real, "im": line.imag})

    def rows_of(pdf: pd.DataFrame) -> pd.DataFrame:
        rows, cols, m = int(pdf["_r"].iloc[0]), int(pdf["_c"].iloc[0]), int(pdf["m"].iloc[0])
        k1 = int(pdf["_k1"].iloc[0])
        line = np.zeros(cols, dtype=complex)
        line[pdf["_i2"].to_numpy()] = pdf["re"].to_numpy() + 1j * pdf["im"].to_numpy()
        line = np.fft.fft(line) if sign < 0 else np.fft.ifft(line) * cols
        return pd.DataFrame({**{k: pdf[k].iloc[0] for k in keys}, "m": m,
                             "i": k1 + rows * np.arange(cols), "re": line.real, "im": line.imag})

    shape = "m long, _r long, _c long, _k1 long, _i2 long, re double, im double"
    first = grid.groupBy(*keys, "_i2").applyInPandas(columns, f"{fields}, {shape}")
    return first.groupBy(*keys, "_k1").applyInPandas(rows_of, f"{fields}, m long, i long, re double, im double")


def long_spectrum_peaks(rows: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, _peak) of series given as rows (keys, _pos, _n, _w)."""
    series = rows.select(*keys, F.col("_pos").alias("i"), F.col("_n").alias("n"), F.col("_w").alias("w"))
    size = F.pow(F.lit(2.0), F.ceil(F.log2(F.col("n") * 2 - 1))).cast("long")
    series = series.withColumn("m", size)

    def chirp(index, n):
        # exp(i pi k^2 / n): k^2 taken modulo 2n in integers
        turn = F.pmod(index * index, n * 2).cast("double") * np.pi / n
        return F.cos(turn), F.sin(turn)

    cos, sin = chirp(F.col("i"), F.col("n"))
    signal = series.select(*keys, "m", "i", (F.col("w") * cos).alias("re"), (-F.col("w") * sin).alias("im"))
    # the kernel exp(i pi k^2 / n) stands at k and, mirrored, at m - k
    both = F.explode(F.when(F.col("i") == 0, F.array(F.col("i"))).otherwise(F.array("i", F.col("m") - F.col("i"))))
    kernel = (series.select(*keys, "m", "n", "i", both.alias("_at"))
              .select(*keys, "m", F.col("_at").alias("i"), cos.alias("re"), sin.alias("im")))
    left = _grid_transform(signal, keys, -1)
    right = _grid_transform(kernel, keys, -1).select(
        *keys, "i", F.col("re").alias("kre"), F.col("im").alias("kim"))
    product = store(left.join(right, [*keys, "i"]).select(
        *keys, "m", "i", (F.col("re") * F.col("kre") - F.col("im") * F.col("kim")).alias("re"),
        (F.col("re") * F.col("kim") + F.col("im") * F.col("kre")).alias("im")))
    lengths = series.groupBy(*keys).agg(F.max("n").alias("_len"))
    power = store(_grid_transform(product, keys, 1).join(lengths, keys)
             .filter(F.col("i") <= F.col("_len") / 2)
             .select(*keys, "i", (F.col("re") * F.col("re") + F.col("im") * F.col("im")).alias("_p")))
    best = power.groupBy(*keys).agg(F.max("_p").alias("_best"))
    return (power.join(best, keys).filter(F.col("_p") >= F.col("_best") * (1 - 1e-9))
            .groupBy(*keys).agg(F.min("i").alias("_peak")))
