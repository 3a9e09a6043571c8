"""Photon models N(E), statistics and energetics as column expressions."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

from burstframe.functions.arithmetic import SPARK, Arrays, Columns

# Pivot energy (keV), keV in erg as used for fluxes, light speed (cm/s), Mpc (cm).
PIVOT = 100.0
KEV_ERG = 1.602e-9
LIGHT_SPEED = 2.998e10
MPC_CM = 3.086e24


def _x(e: Column) -> Column:
    return e / PIVOT


def band(e: Column, alpha: Column, beta: Column, epeak: Column, norm: Column, x: Columns | Arrays = SPARK) -> Column:
    """Exponential cutoff below (alpha - beta) Ep / (2 + alpha), power law above, joined smoothly."""
    brk = (alpha - beta) * epeak / (alpha + 2.0)
    low = norm * x.pow(_x(e), alpha) * x.exp(-(alpha + 2.0) * e / epeak)
    high = norm * x.pow(_x(brk), alpha - beta) * x.exp(beta - alpha) * x.pow(_x(e), beta)
    return x.when(e < brk, low, high)


def cutoff_power_law(e: Column, alpha: Column, epeak: Column, norm: Column, x: Columns | Arrays = SPARK) -> Column:
    return norm * x.pow(_x(e), alpha) * x.exp(-(alpha + 2.0) * e / epeak)


def power_law(e: Column, index: Column, norm: Column, x: Columns | Arrays = SPARK) -> Column:
    return norm * x.pow(_x(e), index)


def blackbody(e: Column, kt: Column, norm: Column, x: Columns | Arrays = SPARK) -> Column:
    z = x.clip(-100.0, 100.0, e / kt)
    return norm * e * e / (x.exp(z) - 1.0)


def smooth_broken_power_law(e, a1, a2, e_break, norm, delta: float = 0.3, x: Columns | Arrays = SPARK) -> Column:
    r = e / e_break
    bend = x.pow(x.pow(r, -a1 * delta) + x.pow(r, -a2 * delta), -1.0 / delta)
    return norm * x.pow(_x(e), -a1) * bend


# name -> (parameter names, builder)
MODELS: dict[str, tuple[tuple[str, ...], Callable[..., Column]]] = {
    "Band": (("alpha", "beta", "epeak"), band),
    "CPL": (("alpha", "epeak"), cutoff_power_law),
    "PL": (("index",), power_law),
    "BB": (("kT",), blackbody),
    "SBPL": (("alpha1", "alpha2", "e_break"), smooth_broken_power_law),
}


def chi_squared(counts: Column, model_rate: Column, exposure: Column, area: Column) -> Column:
    """Aggregate: sum (n - e)^2 / e with e floored at 1e-10."""
    e = F.greatest(model_rate * exposure * area, F.lit(1e-10))
    return F.sum((counts - e) * (counts - e) / e)


def cash(counts: Column, model_rate: Column, exposure: Column, area: Column) -> Column:
    """Aggregate: 2 sum (e - n ln e)."""
    e = F.greatest(model_rate * exposure * area, F.lit(1e-10))
    return F.lit(2.0) * F.sum(e - counts * F.ln(e))


def quadrature(f: Callable[[Column], Column], lo: Column, hi: Column, n: int, unrolled: bool = False) -> Column:
    """Gauss-Legendre integral of f over [lo, hi] with n nodes, inside one row.

    ``unrolled`` writes the nodes out as one generated expression, for short integrands.
    """
    nodes, weights = (v.tolist() for v in np.polynomial.legendre.leggauss(n))
    half, mid = (hi - lo) / F.lit(2.0), (hi + lo) / F.lit(2.0)
    if unrolled:
        return half * sum((F.lit(w) * f(mid + half * F.lit(x)) for x, w in zip(nodes, weights)), F.lit(0.0))
    table = F.array(*[F.struct(F.lit(x).alias("x"), F.lit(w).alias("w")) for x, w in zip(nodes, weights)])
    return half * F.aggregate(table, F.lit(0.0), lambda acc, p: acc + p["w"] * f(mid + half * p["x"]))


def model_value(model: Column, e: Column, p: dict[str, Column]) -> Column:
    """N(E) of Band, CPL or PL rows, chosen by name."""
    return (
        F.when(model == "Band", band(e, p["alpha"], p["beta"], p["epeak"], p["norm"]))
        .when(model == "CPL", cutoff_power_law(e, p["alpha"], p["epeak"], p["norm"]))
        .when(model == "PL", power_law(e, p["index"], p["norm"]))
    )


def flux(model: Column, p: dict[str, Column], ok: Column, lo: Column, hi: Column, energy: bool, n: int = 24) -> Column:
    """Energy flux (erg) or photon flux over [lo, hi]; 0 for failed fits or other models.

    The integral runs over ln E in two parts that meet at the Band break (or the middle), where the model has a kink.
    """
    def integrand(u: Column) -> Column:
        e = F.exp(u)
        # dE = E du
        return model_value(model, e, p) * (e * e if energy else e)

    a, b = F.ln(lo), F.ln(hi)
    brk = F.when(model == "Band", F.ln((p["alpha"] - p["beta"]) * p["epeak"] / (p["alpha"] + F.lit(2.0))))
    knee = F.greatest(a, F.least(b, F.coalesce(brk, (a + b) / F.lit(2.0))))
    value = (quadrature(integrand, a, knee, n) + quadrature(integrand, knee, b, n)) * F.lit(KEV_ERG if energy else 1.0)
    return F.when(ok & model.isin("Band", "CPL", "PL"), value).otherwise(F.lit(0.0))


def epeak_of(model: Column, alpha: Column, x: Column) -> Column:
    return F.when(model == "Band", (alpha - x) * x / (alpha + F.lit(2.0))).otherwise(x)


def luminosity_distance(z: Column, h0: float = 70.0, om: float = 0.3, ol: float = 0.7, n: int = 16) -> Column:
    """Flat-universe luminosity distance in cm."""
    inv_e = lambda v: F.lit(1.0) / F.sqrt(
        F.lit(om) * (F.lit(1.0) + v) * (F.lit(1.0) + v) * (F.lit(1.0) + v) + F.lit(ol))
    integral = quadrature(inv_e, F.lit(0.0), z, n, unrolled=True)
    hubble = h0 * 1e5 / MPC_CM
    return (F.lit(1.0) + z) * F.lit(LIGHT_SPEED / hubble) * integral


def isotropic_energy(energy_flux: Column, dl: Column, duration: float = 100.0) -> Column:
    import math

    return F.lit(4 * math.pi) * dl * dl * energy_flux * F.lit(duration)


def peak_luminosity(peak_flux: Column, z: Column, dl: Column) -> Column:
    import math

    return F.lit(4 * math.pi) * dl * dl * peak_flux * (F.lit(1.0) + z)


def flux_density_factor(e0: Column, e: Column, gamma: Column) -> Column:
    return F.pow(e0, gamma - F.lit(1.0)) * F.pow(e, F.lit(1.0) - gamma)


def fit_quality(reduced: Column) -> Column:
    return (F.when(reduced < 0.8, "Excellent").when(reduced < 1.2, "Good").when(reduced < 2.0, "Acceptable")
            .when(reduced.isNotNull(), "Poor"))
