"""Distributed grid-profile fits: one operator for every curve fit.

Shape parameters run over a grid, the normalisation (and an offset, if any) has a closed form, so a fit
is a few sums per (series, grid point) followed by the best few; from these starts every series descends until it has converged; ``fit_success``
needs that.  Series of at most ``local_fit.POINTS`` points are packed into rows and fitted there (``local_fit.py``).  For longer ones the grid is
exploded inside the scan of the points (no join), a round of the descent is one aggregate (``descent.py``), and partial sums combine map-side, so the
number of points per series does not matter.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from burstframe.functions.arithmetic import SPARK, Arrays, Columns
from burstframe.operators import local_fit
from burstframe.operators.descent import descend
from burstframe.operators.reuse import keep
from burstframe.operators.series import attach

TINY = 1e-300


@dataclass(frozen=True)
class Axis:
    """Shape parameter on n grid values in [lo, hi]; limits may be per-series columns of the points."""

    name: str
    lo: float | str
    hi: float | str
    n: int
    log: bool = False

    def limit(self, which: str) -> Column:
        v = getattr(self, which)
        c = F.col(v) if isinstance(v, str) else F.lit(float(v))
        return F.ln(c) if self.log else c

    def unscale(self, c: Column) -> Column:
        return F.exp(c) if self.log else c


def _clamp(c: Column, bounds) -> Column:
    if bounds is None:
        return c
    lo, hi = (F.col(b) if isinstance(b, str) else F.lit(float(b)) for b in bounds)
    return F.greatest(lo, F.least(hi, c))


def _strides(sizes: Sequence[int]) -> list[int]:
    out, s = [], 1
    for n in reversed(sizes):
        out.append(s)
        s *= n
    return list(reversed(out))


def _sum_columns(stat: str, y: str, err: str) -> list[Column]:
    m, v = F.col("_m"), F.col(y)
    if stat == "cash":
        e = F.greatest(m * F.col("exposure") * F.col("area"), F.lit(TINY))
        return [F.sum(v).alias("_sn"), F.sum(e).alias("_se"), F.sum(v * F.ln(e)).alias("_snl")]
    w = F.lit(1.0) if err is None else F.lit(1.0) / (F.col(err) * F.col(err))
    cols = [F.sum(v * m * w).alias("_sym"), F.sum(m * m * w).alias("_smm"), F.sum(v * v * w).alias("_syy")]
    if stat == "chi2_offset":
        cols += [F.sum(w).alias("_s1"), F.sum(m * w).alias("_sm"), F.sum(v * w).alias("_sy")]
    return cols


def _norm_and_stat(stat: str, bounds, offset_bounds) -> tuple[Column, Column, Column | None]:
    c = F.col
    if stat == "cash":
        n = _clamp(F.try_divide(c("_sn"), c("_se")), bounds)
        return n, F.lit(2.0) * (n * c("_se") - c("_snl") - c("_sn") * F.ln(F.greatest(n, F.lit(TINY)))), None
    if stat == "chi2":
        n = _clamp(F.try_divide(c("_sym"), c("_smm")), bounds)
        return n, c("_syy") - F.lit(2.0) * n * c("_sym") + n * n * c("_smm"), None
    a = _clamp(F.try_divide(c("_s1") * c("_sym") - c("_sm") * c("_sy"), c("_s1") * c("_smm") - c("_sm") * c("_sm")), bounds)
    k = _clamp(F.try_divide(c("_sy") - a * c("_sm"), c("_s1")), offset_bounds)
    two = F.lit(2.0)
    chi = (c("_syy") - two * k * c("_sy") - two * a * c("_sym") + k * k * c("_s1") + two * a * k * c("_sm")
           + a * a * c("_smm"))
    return a, chi, k


def _evaluate(points, keys, axes, model, stat, y, err, n_grid, values, norm_bounds, offset_bounds, per_key_cols,
              allowed, starts) -> DataFrame:
    """The ``starts`` best grid points per key (``_s`` from 0) for grids given as scaled value columns of ``_g``."""
    grid = points.withColumn("_g", F.explode(F.sequence(F.lit(0), F.lit(n_grid - 1))))
    params = {a.name: a.unscale(v) for a, v in zip(axes, values)}
    grid = grid.withColumns({f"_p_{k}": v for k, v in params.items()})
    p = {k: F.col(f"_p_{k}") for k in params}
    if allowed is not None:
        grid = grid.filter(allowed(p))
    grid = grid.withColumn("_m", model(p, SPARK))
    sums = grid.groupBy(*keys, "_g").agg(
        *_sum_columns(stat, y, err), F.count(F.lit(1)).alias("_n"),
        *[F.first(f"_p_{k}").alias(k) for k in params], *[F.first(c).alias(c) for c in per_key_cols])
    norm, value, offset = _norm_and_stat(stat, norm_bounds, offset_bounds)
    cols = {"norm": norm, "stat": value}
    if offset is not None:
        cols["offset"] = offset
    scored = sums.withColumns(cols).filter(F.col("stat").isNotNull() & ~F.isnan("stat"))
    best = F.slice(F.sort_array(F.collect_list(F.struct("stat", "_g", *params, *[c for c in cols if c != "stat"]))), 1, starts)  # of a grid of fixed size
    return scored.groupBy(*keys).agg(best.alias("_w")).select(*keys, F.posexplode("_w").alias("_s", "_b")).select(*keys, "_s", *[f"_b.{c}" for c in [*params, *cols]])


ROWS_PER_SLICE = 100_000


def _clustered(points: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Kept copy of the points with each series in one partition, long series cut into slices by hash.

    Every round scans it, and the sums per (series, grid point) then shrink map-side to about one row
    per series and grid point instead of one per point and grid point.
    """
    sizes = points.groupBy(*keys).agg(F.count(F.lit(1)).alias("_np"))
    slices = F.ceil(F.col("_np") / F.lit(float(ROWS_PER_SLICE)))
    rows = attach(points, sizes, keys).withColumn("_slice", F.pmod(F.xxhash64(*points.columns), slices))
    n = int(points.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return keep(rows.repartition(n, *keys, "_slice").drop("_slice"))


def profile_fit(
    points: DataFrame,
    keys: Sequence[str],
    axes: Sequence[Axis],
    model: Callable[[dict, Columns | Arrays], Column],
    stat: str = "chi2",
    y: str = "flux",
    err: str | None = "flux_err",
    refine: bool = True,
    starts: int = 3,
    start: DataFrame | None = None,
    norm_bounds=None,
    offset_bounds=None,
    min_points: int = 1,
    allowed: Callable[[dict[str, Column]], Column] | None = None,
) -> DataFrame:
    """Best parameters per key: shape axes, ``norm`` (``offset``), ``stat``, ``n_points``, ``converged``, ``fit_success``.

    ``model`` maps parameters to the unit-norm model at a point; its second argument has the columns and functions it may use (``functions/arithmetic.py``), as it
    is evaluated on Spark columns and on arrays.  ``stat`` is chi2, chi2_offset or cash.  The descent begins at the
    ``starts`` best grid points, or at ``start`` (keys and axis values) without a grid; ``refine=False`` stops at the grid, whose
    best point counts as a success.
    """
    limits = [v for a in axes for v in (a.lo, a.hi) if isinstance(v, str)]
    bound_cols = [b for bs in (norm_bounds, offset_bounds) if bs for b in bs if isinstance(b, str)]
    per_key = list(dict.fromkeys(limits + bound_cols))
    sizes = points.groupBy(*keys).agg(F.count(F.lit(1)).alias("_np"))
    long = sizes.where(F.col("_np") > local_fit.POINTS)
    some_long = start is not None or not long.isEmpty()
    out = None
    if start is None:
        short = points if not some_long else attach(points, sizes.where(F.col("_np") <= local_fit.POINTS), keys).drop("_np")
        short = short.where(" AND ".join(f"`{k}` IS NOT NULL" for k in keys) or "true")
        out = keep(local_fit.fit_packed(short, keys, axes, model, stat, y, err, norm_bounds, offset_bounds, allowed, starts, refine, per_key))
    if some_long:
        rows = points if start is not None else points.join(long.select(*keys), list(keys), "left_semi")
        far = _fit_rounds(rows, keys, axes, model, stat, y, err, refine, starts, start, norm_bounds, offset_bounds, per_key, allowed)
        out = far if out is None else out.unionByName(far)
    ok = (F.col("_np") >= min_points) & F.col("stat").isNotNull() & F.col("converged")
    names = [a.name for a in axes] + ["norm"] + (["offset"] if stat == "chi2_offset" else [])
    return out.select(
        *keys, *[F.when(ok, F.col(n)).alias(n) for n in names], F.when(ok, F.col("stat")).alias("stat"),
        F.col("_np").alias("n_points"), F.coalesce("converged", F.lit(False)).alias("converged"), F.coalesce(ok, F.lit(False)).alias("fit_success"))


def _fit_rounds(points, keys, axes, model, stat, y, err, refine, starts, start, norm_bounds, offset_bounds, per_key, allowed) -> DataFrame:
    """Fits of series of any length: one aggregate for the grid and one for each round of the descent."""
    points = _clustered(points, keys)
    common = (keys, axes, model, stat, y, err)
    sizes = [a.n for a in axes]
    values = []
    for a, s in zip(axes, _strides(sizes)):
        i = F.floor(F.col("_g") / F.lit(s)) % F.lit(a.n)
        frac = i / F.lit(float(max(a.n - 1, 1)))
        values.append(a.limit("lo") + (a.limit("hi") - a.limit("lo")) * frac)
    total = 1
    for n in sizes:
        total *= n
    if start is None:
        best = _evaluate(points, *common, total, values, norm_bounds, offset_bounds, per_key, allowed, starts if refine else 1)
        start = best.select(*keys, "_s", *[a.name for a in axes])
    if refine:
        found = descend(points, keys, start, axes, model, stat, y, err, norm_bounds, offset_bounds, allowed)
        best = found.groupBy(*keys).agg(F.min_by(F.struct(*[c for c in found.columns if c not in keys]), "stat").alias("_w")).select(*keys, "_w.*")
        best = best.where(F.col("stat") < float("inf"))
    else:
        best = best.drop("_s").withColumn("converged", F.lit(True))
    if "offset" not in best.columns:
        best = best.withColumn("offset", F.lit(0.0))
    seen = points.groupBy(*keys).agg(F.first("_np").alias("_np"))
    return attach(seen, best, keys, "left").select(*keys, *[a.name for a in axes], "norm", "offset", "stat", "converged", "_np")


def curvature_errors(
    points: DataFrame, keys: Sequence[str], fits: DataFrame, names: Sequence[str],
    model: Callable[[dict, Columns | Arrays], Column], stat: str = "chi2", y: str = "flux", err: str | None = "flux_err",
    rel_step: float = 1e-3,
) -> DataFrame:
    """sqrt(2 / f'') per parameter (``x_err``) and 1 / sqrt(f'') (``x_err_compat``), others held fixed.

    One pass: every point is evaluated at the optimum and at +-h of each parameter.
    """
    all_names = [*names, "norm"]
    base = fits.filter("fit_success").select(*keys, *[F.col(n).alias(f"_b_{n}") for n in all_names])
    g = attach(points, base, keys).withColumn("_v", F.explode(F.sequence(F.lit(0), F.lit(2 * len(all_names)))))
    p = {}
    for i, n in enumerate(all_names):
        b = F.col(f"_b_{n}")
        h = F.greatest(F.abs(b), F.lit(1e-3)) * F.lit(rel_step)
        p[n] = b + F.when(F.col("_v") == 2 * i + 1, h).when(F.col("_v") == 2 * i + 2, -h).otherwise(F.lit(0.0))
    value = model({n: p[n] for n in names}, SPARK) * p["norm"]
    if stat == "cash":
        e = F.greatest(value * F.col("exposure") * F.col("area"), F.lit(1e-10))
        term = F.lit(2.0) * (e - F.col(y) * F.ln(e))
    else:
        term = (F.col(y) - value) * (F.col(y) - value) / (F.col(err) * F.col(err))
    s = g.withColumn("_t", term).groupBy(*keys, *[f"_b_{n}" for n in all_names]).agg(
        *[F.sum(F.when(F.col("_v") == v, F.col("_t"))).alias(f"_s{v}") for v in range(2 * len(all_names) + 1)])
    cols = []
    for i, n in enumerate(all_names):
        h = F.greatest(F.abs(F.col(f"_b_{n}")), F.lit(1e-3)) * F.lit(rel_step)
        f2 = (F.col(f"_s{2 * i + 1}") - F.lit(2.0) * F.col("_s0") + F.col(f"_s{2 * i + 2}")) / (h * h)
        inf = F.lit(float("inf"))
        cols += [F.when(f2 > 0, F.sqrt(F.lit(2.0) / f2)).otherwise(inf).alias(f"{n}_err"),
                 F.when(f2 > 0, F.lit(1.0) / F.sqrt(f2)).otherwise(inf).alias(f"{n}_err_compat")]
    return s.select(*keys, *cols)
