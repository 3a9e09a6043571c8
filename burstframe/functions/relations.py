"""Published relations between burst properties, and afterglow formulas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Log y = slope * log x + intercept, scatter in dex.
RELATIONS = {
    "amati": ("eiso", "epeak_rest", 0.57, -27.2, 0.2),
    "yonetoku": ("epeak_rest", "lpeak", 2.0, 47.0, 0.25),
    "ghirlanda": ("epeak_rest", "egamma", 1.74, 30.38, 0.27),
}


def relation(name: str, x: Column, y: Column) -> Column:
    """Struct of expected log value, offset in dex and in sigma, and the outlier flag."""
    _, _, slope, intercept, scatter = RELATIONS[name]
    expected = F.lit(slope) * F.log10(x) + F.lit(intercept)
    off = F.log10(y) - expected
    return F.struct(
        expected.alias("log_expected"), off.alias("offset_dex"), (off / F.lit(scatter)).alias("sigma_offset"),
        (F.abs(off / F.lit(scatter)) > 2.0).alias("is_outlier"))


def lag_luminosity(lag: Column, lpeak: Column) -> Column:
    expected = F.lit(0.05) * F.pow(lpeak / F.lit(1e52), F.lit(-0.4))
    ratio = F.when(expected > 0, lag / expected).otherwise(F.lit(0.0))
    return F.struct(expected.alias("expected_lag"), ratio.alias("ratio"),
                    ((ratio > 0.5) & (ratio < 2.0)).alias("consistent"))


def variability_luminosity(v: Column, lpeak: Column) -> Column:
    log_expected = F.lit(2.0) - F.lit(0.5) * F.log10(lpeak)
    expected = F.pow(F.lit(10.0), log_expected)
    ratio = F.when(expected > 0, v / expected).otherwise(F.lit(0.0))
    return F.struct(log_expected.alias("log_expected"), ratio.alias("ratio"),
                    ((ratio > 0.5) & (ratio < 2.0)).alias("consistent"))


def all_relations(df: DataFrame) -> DataFrame:
    """Each check only where its fields are present."""
    out = df
    for name, (x, y, *_rest) in RELATIONS.items():
        if x in df.columns and y in df.columns:
            both = F.col(x).isNotNull() & F.col(y).isNotNull()
            out = out.withColumn(name, F.when(both, relation(name, F.col(x), F.col(y))))
    for name, col, fn in (("lag_luminosity", "lag", lag_luminosity),
                          ("variability_luminosity", "variability", variability_luminosity)):
        if col in df.columns and "lpeak" in df.columns:
            both = F.col(col).isNotNull() & F.col("lpeak").isNotNull()
            out = out.withColumn(name, F.when(both, fn(F.col(col), F.col("lpeak"))))
    return out


def closure(decay: Column, beta: Column, regime: str = "ISM") -> Column:
    """Array of structs (relation, predicted, consistent) for a decay and a spectral index."""
    half = (F.lit(3.0) * beta - F.lit(1.0)) / F.lit(2.0)
    if regime == "ISM":
        rows = [("FS_ISM_Synchrotron_SlowCool", half), ("FS_ISM_IC_SlowCool", (F.lit(3.0) * beta + F.lit(1.0)) / F.lit(2.0)),
                ("FS_ISM_Synchrotron_FastCool", beta / F.lit(2.0) - F.lit(0.25))]
    else:
        rows = [("FS_Wind_Synchrotron_SlowCool", half - F.lit(0.5))]
    return F.array(*[
        F.struct(F.lit(n).alias("relation"), p.alias("predicted"), (F.abs(decay - p) < 0.3).alias("consistent"))
        for n, p in rows])


def jet_angle(t_break: Column, e_iso: Column, n: float = 1.0) -> Column:
    """Opening angle; break time in seconds, energy in erg."""
    return F.lit(0.07) * F.sqrt(F.lit(n) * (e_iso / F.lit(1e51)) / (t_break / F.lit(86400.0)))


def forward_shock(t: Column, e: Column = None, n: Column = None) -> Column:
    e = F.lit(1e51) if e is None else e
    n = F.lit(1.0) if n is None else n
    return F.pow(e, F.lit(0.25)) * F.sqrt(n) / F.lit(1e28 * 1e28) * F.pow(t + F.lit(1.0), F.lit(-0.75))
