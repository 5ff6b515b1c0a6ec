"""Dominant cycle of a series by discrete Fourier transform.

A short series is transformed in one task. A series too long for that goes through a chirp
transform: its length-n transform becomes a convolution of a power-of-two length M, and each
length-M transform is done as sqrt(M) short ones twice, with a shuffle between.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seriesloom import session
from seriesloom.operators.features import attach, detrended
from seriesloom.operators.panel import Panel, matched

# --- fixed values: sample spacing per frequency label ---
SPACING = {"H": 1 / 24, "D": 1.0, "W": 1.0, "M": 1 / 4.33, "Q": 1 / 13, "A": 1 / 52}
# --------------------------------------------------------


def amplitudes(panel: Panel, c: str) -> DataFrame:
    """Amplitude 2/n |Y_k| for 0 <= k < n/2 of the detrended series: columns k, n, amplitude."""
    p = detrended(panel, c, "__y").positions("__i")
    rows = p.df.select(*p.series, (F.col("__i") - 1).alias("__j"), F.col("__y"))
    if p.is_split:
        return _long_amplitudes(rows, p.series)
    schema = T.StructType(
        [*[f for f in rows.schema.fields if f.name in p.series], T.StructField("k", T.LongType()), T.StructField("n", T.LongType()), T.StructField("amplitude", T.DoubleType())]
    )
    keys = p.series

    def transform(pdf: pd.DataFrame) -> pd.DataFrame:
        y = pdf.sort_values("__j")["__y"].to_numpy()
        n = len(y)
        a = 2.0 / n * np.abs(np.fft.fft(y)[: n // 2])
        out = pd.DataFrame({"k": np.arange(len(a)), "n": n, "amplitude": a})
        for key in keys:
            out[key] = pdf[key].iloc[0]
        return out[[*keys, "k", "n", "amplitude"]]

    return session.spread(rows, keys).groupBy(*keys).applyInPandas(transform, schema)


def dominant_cycle(panel: Panel, c: str, spacing: float | str = 1.0) -> DataFrame:
    """Strongest non-constant frequency and its cycle length; ``spacing`` may be a frequency label."""
    spacing = SPACING[spacing] if isinstance(spacing, str) else spacing
    a = amplitudes(panel, c).filter("k >= 1")
    peak = a.groupBy(*panel.series).agg(
        F.max_by("k", F.struct("amplitude", -F.col("k"))).alias("k"), F.max("amplitude").alias("amplitude"), F.max("n").alias("n")
    )
    return peak.withColumn("cycle", F.col("n") * spacing / F.col("k"))


def _pass(df: DataFrame, series: Sequence[str], group: str, within: str, inverse: bool) -> DataFrame:
    """One short transform per (series, group) over ``within``; absent places are zero."""
    fields = {f.name: f for f in df.schema.fields}
    fields["re"], fields["im"] = (T.StructField(x, T.DoubleType()) for x in ("re", "im"))
    names = [*series, group, within, "re", "im", "__m1", "__m2", "__n"]
    schema = T.StructType([fields[n] for n in names])
    length = "__m2" if within == "__q" else "__m1"
    sign = 1 if inverse else -1
    twist = within == "__q"

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        size = int(pdf[length].iloc[0])
        x = np.zeros(size, dtype=complex)
        np.add.at(x, pdf[within].to_numpy(), pdf["re"].to_numpy() + 1j * pdf["im"].to_numpy())
        y = np.fft.ifft(x) * size if inverse else np.fft.fft(x)
        if twist:
            whole = float(pdf["__m1"].iloc[0]) * float(pdf["__m2"].iloc[0])
            y = y * np.exp(sign * 2j * np.pi * float(pdf[group].iloc[0]) * np.arange(size) / whole)
        out = pd.DataFrame({within: np.arange(size), "re": y.real, "im": y.imag})
        for n in (*series, group, "__m1", "__m2", "__n"):
            out[n] = pdf[n].iloc[0]
        return out[names]

    return session.spread(df.select(*names), [*series, group]).groupBy(*series, group).applyInPandas(run, schema)


def _power_of_two_transform(df: DataFrame, series: Sequence[str], inverse: bool = False) -> DataFrame:
    """Transform rows (series, __j, re, im, __m1, __m2, __n) of length m1 * m2; absent places are zero."""
    m1, m2 = F.col("__m1"), F.col("__m2")
    cols = df.withColumns({"__r": F.pmod("__j", m1), "__q": F.floor(F.col("__j") / m1).cast("long")})
    first = _pass(cols, series, "__r", "__q", inverse)
    second = _pass(first, series, "__q", "__r", inverse)
    out = second.withColumn("__j", F.col("__q") + m2 * F.col("__r")).drop("__q", "__r")
    if inverse:
        out = out.withColumns({x: F.col(x) / (m1 * m2) for x in ("re", "im")})
    return out


def square_modulo(j: Column, m: Column) -> Column:
    """j * j modulo m without leaving a 64-bit number, for 0 <= j < m < 2^42: j is taken in two halves of 21 bits."""
    low, high = F.pmod(j, F.lit(1 << 21)), F.floor(j / (1 << 21))
    step = F.pmod(high * j, m)  # below 2^63: high < 2^21, j < 2^42
    return F.pmod(F.pmod(step * (1 << 21), m) + F.pmod(low * j, m), m)


def _long_amplitudes(rows: DataFrame, series: Sequence[str]) -> DataFrame:
    sizes = rows.groupBy(*series).agg(F.count(F.lit(1)).alias("__n"))
    bits = F.ceil(F.log2(2.0 * F.col("__n"))).cast("int")
    sizes = sizes.withColumns(
        {"__m1": F.pow(F.lit(2.0), F.floor(bits / 2)).cast("long"), "__m2": F.pow(F.lit(2.0), F.ceil(bits / 2)).cast("long")}
    )
    # Freeze positions: the chirp and the signal are read from the same rows.
    base = session.cut(attach(rows, sizes, series))
    n, j = F.col("__n"), F.col("__j")
    angle = F.lit(np.pi) * square_modulo(j, 2 * n) / n
    keep = [*series, "__m1", "__m2", "__n"]
    signal = base.select(*keep, "__j", (F.col("__y") * F.cos(angle)).alias("re"), (-F.col("__y") * F.sin(angle)).alias("im"))
    places = F.when(j == 0, F.array(j)).otherwise(F.array(j, F.col("__m1") * F.col("__m2") - j))
    chirp = base.select(*keep, F.explode(places).alias("__k"), F.cos(angle).alias("re"), F.sin(angle).alias("im"))
    chirp = chirp.withColumnRenamed("__k", "__j")
    a = _power_of_two_transform(signal, series)
    b = _power_of_two_transform(chirp, series).select(*series, "__j", F.col("re").alias("br"), F.col("im").alias("bi"))
    re, im, br, bi = (F.col(x) for x in ("re", "im", "br", "bi"))
    product = matched(a, b, [*series, "__j"], how="inner").select(*keep, "__j", (re * br - im * bi).alias("re"), (re * bi + im * br).alias("im"))
    # The closing chirp factor has modulus one, so amplitudes need no further product.
    out = _power_of_two_transform(product, series, inverse=True).filter(F.col("__j") < F.floor(n / 2))
    size = F.sqrt(F.col("re") * F.col("re") + F.col("im") * F.col("im"))
    return out.select(*series, F.col("__j").alias("k"), n.alias("n"), (2.0 / n * size).alias("amplitude"))
