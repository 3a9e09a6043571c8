"""Lag products of long series in two levels of Fourier transforms.

A correlation at lag k is a sum over all (i, i+k).  Rows are never paired, nor are blocks: series are cut into blocks of ``BLOCK`` positions and each is
transformed by itself; per range of frequencies a second transform over the block numbers gives the products of all blocks at every distance;
the way back turns each distance into its lags.  What is shuffled is a few times the series, whatever its length.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from burstframe.operators.reuse import keep
from burstframe.operators.series import attach

BLOCK = 4096
#: Values (blocks times frequencies) of one group of the second transform; one frequency is the least.
GROUP_VALUES = 1 << 18


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def _cross(x: pd.Series, y: pd.Series) -> pd.Series:
    # element m is sum_i x[i] * y[i + m - (len(x) - 1)]
    return pd.Series([np.correlate(b, a, "full") for a, b in zip(x, y)])


def blocks(df: DataFrame, keys: Sequence[str], pos: str, columns: Sequence[str], size: int = BLOCK) -> DataFrame:
    """One row per (key, block) with the block's values as arrays in position order."""
    rows = df.select(
        *keys,
        F.floor(F.col(pos) / F.lit(size)).cast("long").alias("_b"),
        F.struct(F.col(pos).alias("_p"), *columns).alias("_r"),
    )
    packed = rows.groupBy(*keys, "_b").agg(F.array_sort(F.collect_list("_r")).alias("_rows"))
    return packed.select(*keys, "_b", *[F.col("_rows")[c].alias(c) for c in columns])


def _reversed_pairs(values: np.ndarray, size: int) -> np.ndarray:
    """Circular correlation of length 2 * size as lags -(size-1) .. size-1."""
    return np.concatenate([values[..., size + 1 :], values[..., :size]], axis=-1)


def _spectra(blk: DataFrame, keys: Sequence[str], n: str, size: int) -> DataFrame:
    """Transforms of the zero-padded blocks, cut into ranges of frequencies (``_f``) so narrow that all blocks of a range fit one group."""
    kinds = ", ".join(f"`{k}` {blk.schema[k].dataType.simpleString()}" for k in keys)
    names = [*keys, n, "_nb", "_f", "_b", "_xr", "_xi", "_yr", "_yi"]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for r in f.to_dict("records"):
                x, y = (np.fft.rfft(np.asarray(r[c], float), 2 * size) for c in ("_x", "_y"))
                step = max(1, GROUP_VALUES // r["_nb"])
                cuts = range(0, size + 1, step)
                yield pd.DataFrame([(*[r[k] for k in keys], r[n], r["_nb"], a, r["_b"], *[v[a : a + step] for v in (x.real, x.imag, y.real, y.imag)]) for a in cuts],
                                   columns=names)

    arrays = ", ".join(f"{c} array<double>" for c in names[-4:])
    return blk.mapInPandas(run, f"{kinds}, {n} bigint, _nb bigint, _f bigint, _b bigint, {arrays}")


def _across_blocks(spectra: DataFrame, keys: Sequence[str], n: str) -> DataFrame:
    """Per range of frequencies the products of all blocks ``_d`` apart, summed by a second transform over the block numbers."""
    kinds = ", ".join(f"`{k}` {spectra.schema[k].dataType.simpleString()}" for k in keys)

    def run(group: pd.DataFrame) -> pd.DataFrame:
        nb = int(group["_nb"].iloc[0])
        at = group["_b"].to_numpy()
        length = 1 << (2 * nb - 1).bit_length()

        def whole(re: str, im: str) -> np.ndarray:
            out = np.zeros((length, len(group[re].iloc[0])), complex)
            out[at] = np.stack(group[re].to_numpy()) + 1j * np.stack(group[im].to_numpy())
            return np.fft.fft(out, axis=0)

        c = np.fft.ifft(np.conj(whole("_xr", "_xi")) * whole("_yr", "_yi"), axis=0)
        apart = np.arange(1 - nb, nb)
        out = pd.DataFrame({"_d": apart, "_re": list(c[apart].real), "_im": list(c[apart].imag)})
        for name in (*keys, n, "_f"):
            out[name] = [group[name].iloc[0]] * len(out)
        return out[[*keys, n, "_f", "_d", "_re", "_im"]]

    return spectra.groupBy(*keys, "_f").applyInPandas(run, f"{kinds}, {n} bigint, _f bigint, _d bigint, _re array<double>, _im array<double>")


def lag_products(
    df: DataFrame, keys: Sequence[str], pos: str, x: str, y: str, lo: Column, hi: Column, n: str,
    size: int = BLOCK,
) -> DataFrame:
    """(key, lag, sxy) with sxy = sum_i x_i * y_(i+lag) for lo <= lag <= hi.

    ``pos`` is contiguous from 0; ``lo``/``hi`` may use the per-series column ``n``.  Series of one block need no transform.
    """
    keys = list(keys)
    prepared = df.select(*keys, pos, F.col(x).cast("double").alias("_x"), F.col(y).cast("double").alias("_y"), F.col(n).cast("long").alias(n))
    blk = blocks(prepared, keys, pos, ["_x", "_y", n], size).withColumn(n, F.col(n)[0])
    counts = prepared.groupBy(*keys).agg((F.floor(F.max(pos) / size) + 1).alias("_nb"))
    blk = keep(attach(blk, counts, keys))
    one = blk.filter("_nb = 1").select(*keys, n, (F.lit(1) - F.size("_x")).cast("long").alias("_lag0"), _cross("_x", "_y").alias("_v"))
    apart = _across_blocks(_spectra(blk.filter("_nb > 1"), keys, n, size), keys, n)
    apart = apart.filter((F.col("_d") * size + (size - 1) >= lo) & (F.col("_d") * size - (size - 1) <= hi))
    met = apart.groupBy(*keys, n, "_d").agg(F.array_sort(F.collect_list(F.struct("_f", "_re", "_im"))).alias("_r"))

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def back(re: pd.Series, im: pd.Series) -> pd.Series:
        return pd.Series([_reversed_pairs(np.fft.irfft(np.asarray(a, float) + 1j * np.asarray(b, float), 2 * size), size) for a, b in zip(re, im)])

    many = met.select(*keys, n, (F.col("_d") * size - (size - 1)).alias("_lag0"), back(F.flatten("_r._re"), F.flatten("_r._im")).alias("_v"))
    lags = one.unionByName(many).select(*keys, n, "_lag0", F.posexplode("_v").alias("_i", "_p")).withColumn(
        "lag", (F.col("_lag0") + F.col("_i")).cast("long"))
    inside = (F.col("lag") >= lo) & (F.col("lag") <= hi) & (F.abs("lag") < F.col(n))
    return lags.filter(inside).groupBy(*keys, "lag").agg(F.sum("_p").alias("sxy"))
