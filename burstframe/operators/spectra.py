"""Operators over count spectra and photon lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def slice_spectra(photons: DataFrame, intervals: DataFrame, channel: Column, key: str = "burst_id") -> DataFrame:
    """Counts per (burst, slice, channel) for half-open time slices.

    Photons are first counted per (burst, whole-time cell, exact time class) only where a cell
    lies inside one slice, so a bright burst joins a handful of cell rows; only photons in cells that a slice border
    cuts are compared one by one.
    """
    cell = F.floor("t").cast("long")
    rows = photons.select(key, "t", cell.alias("_cell"), channel.alias("channel"))
    span = intervals.select(
        key, "slice", "lo", "hi", F.explode(F.sequence(F.floor("lo").cast("long"), F.floor("hi").cast("long"))).alias("_cell"))
    whole = (F.col("lo") <= F.col("_cell")) & (F.col("hi") >= F.col("_cell") + 1)
    binned = rows.groupBy(key, "_cell", "channel").agg(F.count(F.lit(1)).alias("_n"))
    inside = binned.join(span.filter(whole), [key, "_cell"]).groupBy(key, "slice", "channel").agg(F.sum("_n").alias("counts"))
    cut = rows.join(span.filter(~whole), [key, "_cell"]).filter("t >= lo AND t < hi").groupBy(key, "slice", "channel").agg(
        F.count(F.lit(1)).alias("counts"))
    return inside.unionByName(cut).groupBy(key, "slice", "channel").agg(F.sum("counts").alias("counts"))


def choose_model(fits: DataFrame, key: str = "burst_id") -> DataFrame:
    """Lowest AIC among successful fits; the first fit (by ``fit_order``) when none succeeded."""
    cols = [c for c in fits.columns if c != key]
    rec = F.struct(*cols)
    ok = F.col("fit_success")
    best = F.min_by(F.when(ok, rec), F.when(ok, F.struct("aic", "fit_order")))
    return fits.groupBy(key).agg(F.coalesce(best, F.min_by(rec, "fit_order")).alias("_f")).select(key, "_f.*")


def flux_points(measurements: DataFrame) -> DataFrame:
    """Finite, positive points."""
    return measurements.filter(F.col("flux").isNotNull() & ~F.isnan("flux") & (F.col("flux") > 0))


# Fit bounds per model; shape axes with the coarse grid, and the norm range.
def _axes() -> dict:
    from burstframe.operators.fit import Axis

    return {
        "Band": [Axis("alpha", -3.0, 1.0, 9), Axis("beta", -5.0, -1.5, 6), Axis("epeak", 10.0, 1e4, 13, True)],
        "CPL": [Axis("alpha", -3.0, 1.0, 17), Axis("epeak", 10.0, 1e4, 25, True)],
        "PL": [Axis("index", -3.0, 1.0, 81)],
        "BB": [Axis("kT", 0.1, 100.0, 121, True)],
        "SBPL": [Axis("alpha1", -3.0, 1.0, 9), Axis("alpha2", -5.0, -1.0, 7), Axis("e_break", 10.0, 1e4, 13, True)],
    }


NORM_BOUNDS = (1e-5, 1000.0)
N_PARAMS = {"Band": 4, "CPL": 3, "PL": 2, "BB": 2, "SBPL": 4}


def fit_model(
    spectra: DataFrame, model: str, keys=("burst_id",), refine: bool = True, errors: bool = False
) -> DataFrame:
    """Cash-statistic fit of one model: params map, cstat (alias chi_sq), dof, aic, bic."""
    from burstframe.functions.spectral_models import MODELS
    from burstframe.operators.fit import curvature_errors, profile_fit
    from burstframe.operators.series import attach

    axes = _axes()[model]
    names, build = MODELS[model]

    def unit(p, x):
        return build(x.col("energy"), *[p[n] for n in names], 1.0, x=x)

    # the Band break needs alpha > -2 and alpha > beta
    allowed = (lambda p: (p["alpha"] > -2.0) & (p["alpha"] > p["beta"])) if model == "Band" else None
    fit = profile_fit(spectra, list(keys), axes, unit, stat="cash", y="counts", err=None, refine=refine,
                      norm_bounds=NORM_BOUNDS, allowed=allowed)
    k = N_PARAMS[model]
    pars = F.map_from_arrays(F.array(*[F.lit(n) for n in [*names, "norm"]]), F.array(*[F.col(n) for n in [*names, "norm"]]))
    cols = [*keys, F.lit(model).alias("model"), F.when(F.col("fit_success"), pars).alias("params"), F.col("stat").alias("cstat"),
            F.col("stat").alias("chi_sq"), (F.col("n_points") - k).alias("dof"), (F.col("stat") + 2 * k).alias("aic"),
            (F.col("stat") + k * F.ln(F.col("n_points").cast("double"))).alias("bic"), "fit_success"]
    if not errors:
        return fit.select(*cols)
    errs = curvature_errors(spectra, list(keys), fit, list(names), unit, stat="cash", y="counts")
    if model in ("BB", "SBPL"):
        emap = F.map_from_arrays(F.array(*[F.lit(n) for n in [*names, "norm"]]),
                                 F.array(*[F.lit(float("inf")) for _ in [*names, "norm"]]))
    else:
        emap = F.map_from_arrays(F.array(*[F.lit(n) for n in [*names, "norm"]]),
                                 F.array(*[F.col(f"{n}_err") for n in [*names, "norm"]]))
    return attach(fit, errs, list(keys), "left").select(*cols, emap.alias("errors"))


def fit_spectra(spectra: DataFrame, models, keys=("burst_id",), refine: bool = True) -> DataFrame:
    """Union of the fits of several models; unknown names are an error."""
    unknown = [m for m in models if m not in N_PARAMS]
    if unknown:
        raise ValueError(f"unknown spectral model: {unknown}")
    out = None
    for order, m in enumerate(models):
        one = fit_model(spectra, m, keys, refine).withColumn("fit_order", F.lit(order))
        out = one if out is None else out.unionByName(one)
    return out
