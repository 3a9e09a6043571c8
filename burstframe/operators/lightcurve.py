"""Light-curve operators: photons to bins, rebinning, subtraction, peaks, merging."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from burstframe.operators.reuse import keep
from burstframe.operators.series import asof_merge, attach, dense_grid, first_max, median_by_position, sliding, with_position

KEYS = ("burst_id", "band")


def _edge_exact(idx: Column, t: Column, t0: Column, b: float) -> Column:
    """Move a bin index to agree with the float edges t0 + i*b (left closed)."""
    lo = t0 + idx * F.lit(b)
    hi = t0 + (idx + 1) * F.lit(b)
    return F.when(t < lo, idx - 1).when(t >= hi, idx + 1).otherwise(idx)


def _dyadic_unit(b: float) -> float | None:
    """Largest power of two u <= 1 with b an exact multiple of u, if any."""
    u = 1.0
    for _ in range(24):
        if (b / u) == int(b / u):
            return u
        u /= 2
    return None


def bin_events(
    photons: DataFrame,
    keys: Sequence[str] = KEYS,
    binsize: float = 1.0,
    energy_range: tuple[float, float] | None = None,
    t: str = "t",
    energy: str = "energy",
) -> DataFrame:
    """Histogram of arrival times per series on floor(min t) .. ceil(max t), empty bins included.

    Bins are left closed, the last one is closed on both sides.  Bin sizes made of halves
    (1, 0.5, 0.25, 3 ...) are pre-aggregated map-side before the series start is known, so
    only binned rows are shuffled; others need the start joined to the photons first.
    """
    src = photons
    if energy_range is not None:
        src = src.filter(F.col(energy).between(*energy_range))
    tc = F.col(t)
    unit = _dyadic_unit(binsize)
    if unit is not None:
        cells = keep(
            src.groupBy(*keys, F.floor(tc / F.lit(unit)).cast("long").alias("_cell"))
            .agg(F.count(F.lit(1)).alias("_n"), F.min(tc).alias("_lo"), F.max(tc).alias("_hi"))
        )
        spans = cells.groupBy(*keys).agg(F.min("_lo").alias("_lo"), F.max("_hi").alias("_hi"))
    else:
        spans = src.groupBy(*keys).agg(F.min(tc).alias("_lo"), F.max(tc).alias("_hi"))
    spans = spans.select(
        *keys,
        F.floor("_lo").cast("double").alias("_t0"),
        F.ceil((F.ceil("_hi") - F.floor("_lo")).cast("double") / F.lit(binsize)).cast("long").alias("_nb"),
    ).filter("_nb > 0")
    if unit is not None:
        ratio = int(binsize / unit)
        idx = F.floor(
            (F.col("_cell") - F.floor(F.col("_t0") / F.lit(unit)).cast("long")) / F.lit(ratio)
        ).cast("long")
        counted = attach(cells.select(*keys, "_cell", "_n"), spans, keys)
        counts = counted.groupBy(*keys, F.least(idx, F.col("_nb") - 1).alias("bin_idx")).agg(
            F.sum("_n").alias("_n")
        )
    else:
        idx = F.floor((tc - F.col("_t0")) / F.lit(binsize)).cast("long")
        idx = _edge_exact(idx, tc, F.col("_t0"), binsize)
        counted = attach(src.select(*keys, tc.alias(t)), spans, keys)
        counts = counted.groupBy(*keys, F.least(idx, F.col("_nb") - 1).alias("bin_idx")).agg(
            F.count(F.lit(1)).alias("_n")
        )
    grid = dense_grid(spans, F.col("_nb")).select(*keys, "bin_idx", "_t0")
    return _rates(grid.join(counts, [*keys, "bin_idx"], "left"), keys, binsize)


def bin_events_fixed(
    photons: DataFrame,
    keys: Sequence[str] = KEYS,
    bin_size: float = 0.064,
    trange: tuple[float, float] = (-50.0, 300.0),
    t: str = "t",
) -> DataFrame:
    """Histogram on a fixed grid over a closed time range; one pass with map-side combine."""
    import math

    lo, hi = map(float, trange)
    n_bins = math.ceil((hi + bin_size - lo) / bin_size) - 1
    tc = F.col(t)
    idx = _edge_exact(F.floor((tc - F.lit(lo)) / F.lit(bin_size)).cast("long"), tc, F.lit(lo), bin_size)
    counts = (
        photons.filter(tc.between(lo, hi))
        .groupBy(*keys, F.least(idx, F.lit(n_bins - 1)).cast("long").alias("bin_idx"))
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    series = counts.select(*keys).distinct().withColumn("_t0", F.lit(lo))
    grid = dense_grid(series, F.lit(n_bins))
    return _rates(grid.join(counts, [*keys, "bin_idx"], "left"), keys, bin_size)


def _rates(binned: DataFrame, keys: Sequence[str], b: float) -> DataFrame:
    n = F.coalesce(F.col("_n"), F.lit(0)).cast("long")
    edge = F.col("_t0") + F.col("bin_idx") * F.lit(b)
    nxt = F.col("_t0") + (F.col("bin_idx") + 1) * F.lit(b)
    return binned.select(
        *keys,
        "bin_idx",
        ((edge + nxt) / F.lit(2.0)).alias("t"),
        (n / F.lit(b)).alias("rate"),
        (F.sqrt(n.cast("double")) / F.lit(b)).alias("rate_err"),
        n.alias("counts"),
        F.lit(b).alias("binsize"),
    )


def bin_for_instrument(photons: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Coded-mask defaults: 15-150 keV at 64 ms."""
    return bin_events(photons, keys, binsize=0.064, energy_range=(15.0, 150.0))


def sum_channels(spectra: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Pre-binned (tstart, tend, channel, counts) rows to a light curve."""
    dt = F.when(F.col("tend") > F.col("tstart"), F.col("tend") - F.col("tstart")).otherwise(F.lit(1.0))
    total = F.sum("counts").cast("double")
    lc = spectra.groupBy(*keys, "tstart", "tend").agg(total.alias("counts")).select(
        *keys,
        ((F.col("tstart") + F.col("tend")) / 2).alias("t"),
        "counts",
        (F.col("counts") / dt).alias("rate"),
        (F.sqrt("counts") / dt).alias("rate_err"),
        (F.col("tend") - F.col("tstart")).alias("_dt"),
    )
    lc = keep(lc)
    return attach(lc.drop("_dt"), median_by_position(lc, keys, "_dt", "binsize"), keys)


def prefer_source(tte: DataFrame, cspec: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Event-list light curve where a series has one, else the pre-binned one."""
    cols = [c for c in tte.columns if c in cspec.columns]
    fallback = cspec.join(tte.select(*keys).distinct(), list(keys), "left_anti")
    return (
        tte.select(*cols).withColumn("data_type", F.lit("tte"))
        .unionByName(fallback.select(*cols).withColumn("data_type", F.lit("cspec")))
    )


def select_rows(df: DataFrame, filter_expr: str) -> DataFrame:
    """Rows that satisfy a column expression."""
    return df.filter(F.expr(filter_expr))


def rebin(lc: DataFrame, new_binsize: float, keys: Sequence[str] = KEYS, pos: str | None = "bin_idx") -> DataFrame:
    """Groups of ``round(new/old)`` consecutive rows; an incomplete tail is dropped.

    ``pos`` must be the 0-based row position; pass None to number the rows first.
    """
    if pos is None:
        lc, pos = with_position(lc, keys, ["t"], "_pos"), "_pos"
    factor = F.bround(F.lit(new_binsize) / F.col("binsize")).cast("long")
    grouped = lc.withColumn("_f", factor).filter("_f >= 1")
    return (
        grouped.groupBy(*keys, "_f", F.floor(F.col(pos) / F.col("_f")).cast("long").alias("bin_idx"))
        .agg(
            F.count(F.lit(1)).alias("_n"),
            F.avg("t").alias("t"),
            F.avg("rate").alias("rate"),
            F.sqrt(F.sum(F.col("rate_err") * F.col("rate_err"))).alias("_e"),
        )
        .filter("_n = _f")
        .select(*keys, "bin_idx", "t", "rate", (F.col("_e") / F.col("_f")).alias("rate_err"),
                F.lit(float(new_binsize)).alias("binsize"))
    )


def rebin_rejected(lc: DataFrame, new_binsize: float, keys: Sequence[str] = KEYS) -> DataFrame:
    """Series whose bins are already wider than asked for."""
    return (
        lc.groupBy(*keys).agg(F.max("binsize").alias("binsize"))
        .filter(F.bround(F.lit(new_binsize) / F.col("binsize")) < 1)
        .select(*keys, F.lit("new bin size is smaller than the current one").alias("reason"))
    )


def background_subtract(
    lc: DataFrame, bg_interval: tuple[float, float] = (-100.0, -10.0), keys: Sequence[str] = KEYS
) -> DataFrame:
    """Subtract the mean rate of an interval; floor at zero; errors in quadrature."""
    bg = (
        lc.filter(F.col("t").between(*bg_interval))
        .groupBy(*keys)
        .agg(F.avg("rate").alias("bg_rate"),
             F.sqrt(F.avg(F.col("rate_err") * F.col("rate_err"))).alias("bg_rate_err"))
    )
    out = attach(lc, bg, keys, "left")
    has = F.col("bg_rate").isNotNull()
    return out.withColumn(
        "rate", F.when(has, F.greatest(F.col("rate") - F.col("bg_rate"), F.lit(0.0))).otherwise(F.col("rate"))
    ).withColumn(
        "rate_err",
        F.when(has, F.sqrt(F.col("rate_err") * F.col("rate_err") + F.col("bg_rate_err") * F.col("bg_rate_err")))
        .otherwise(F.col("rate_err")),
    )


def find_peak(lc: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Time, rate and error of the first maximum, and its signal to noise."""
    peak = lc.groupBy(*keys).agg(first_max("rate", "t", "t", "rate", "rate_err").alias("p"))
    return peak.select(
        *keys,
        F.col("p.t").alias("peak_time"),
        F.col("p.rate").alias("peak_rate"),
        F.col("p.rate_err").alias("peak_err"),
        F.when(F.col("p.rate_err") == 0, F.lit(float("inf")))
        .otherwise(F.try_divide(F.col("p.rate"), F.col("p.rate_err"))).alias("snr"),
    )


def fluence(
    lc: DataFrame, time_range: tuple[float, float] | None = None, keys: Sequence[str] = KEYS
) -> DataFrame:
    """Sum of rate x bin over a closed range; (0, 0) for a series with no bin in it."""
    inside = F.lit(True) if time_range is None else F.col("t").between(*time_range)
    r = F.col("rate") * F.col("binsize")
    e = F.col("rate_err") * F.col("binsize")
    return lc.groupBy(*keys).agg(
        F.coalesce(F.sum(F.when(inside, r)), F.lit(0.0)).alias("fluence"),
        F.coalesce(F.sqrt(F.sum(F.when(inside, e * e))), F.lit(0.0)).alias("fluence_err"),
    )


def savgol_weights(window: int) -> list[list[float]]:
    """Quadratic least-squares smoothing weights: row j gives the value at offset j of the window."""
    h = window // 2
    n = float(window)
    xs = range(-h, h + 1)
    s2 = float(sum(x**2 for x in xs))
    s4 = float(sum(x**4 for x in xs))
    det = n * s4 - s2 * s2
    rows = []
    for at in xs:
        rows.append([(s4 - s2 * x * x) / det + at * x / s2 + at * at * (n * x * x - s2) / det for x in xs])
    return rows


def smooth(
    lc: DataFrame, window: int = 5, keys: Sequence[str] = KEYS, pos: str = "bin_idx",
    columns: Sequence[str] = ("rate", "rate_err"),
) -> DataFrame:
    """Second-order smoothing; the ends take the polynomial of the first or last window.

    The window shrinks to half the series length, is made odd, and below 3 leaves rows as they are.
    """
    sizes = lc.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    half = F.least(F.lit(window), F.floor(F.col("_n") / 2)).cast("long")
    win = F.when(half % 2 == 0, half + 1).otherwise(half)
    rows = attach(lc, sizes, keys).withColumn("_w", win)
    widest = window if window % 2 else window + 1
    reach = widest - 1
    odd = [w for w in range(3, widest + 1, 2)]

    def build(spec):
        cols = {}
        for c in columns:
            at = {
                k: F.lag(c, -k).over(spec) if k < 0 else F.lead(c, k).over(spec) if k > 0 else F.col(c)
                for k in range(-reach, reach + 1)
            }
            expr = F.col(c)
            for w in odd:
                h = w // 2
                weights = savgol_weights(w)
                branch = None
                for j in range(w):
                    # j = offset of the row inside the window that smooths it
                    value = sum((at[k - j] * F.lit(weights[j][k]) for k in range(w)), F.lit(0.0))
                    if j < h:
                        cond = F.col(pos) == j
                    elif j > h:
                        cond = F.col(pos) == F.col("_n") - (w - j)
                    else:
                        continue
                    branch = F.when(cond, value) if branch is None else branch.when(cond, value)
                centre = sum((at[k - h] * F.lit(weights[h][k]) for k in range(w)), F.lit(0.0))
                branch = branch.otherwise(centre)
                expr = F.when(F.col("_w") == w, branch).otherwise(expr)
            cols[f"{c}_smooth"] = expr
        return cols

    return sliding(rows, keys, pos, reach, build).drop("_n", "_w")


def regrid_linear(
    source: DataFrame, target: DataFrame, keys: Sequence[str], values: Sequence[str], t: str = "t"
) -> DataFrame:
    """Linear interpolation of ``source`` at the times of ``target``; 0 outside the source range."""
    kept = [c for c in target.columns if c not in values]
    rows = asof_merge(source, target.select(*kept), keys, t, values)
    at, t0, t1 = F.col(t), F.col(f"_left.{t}"), F.col(f"_right.{t}")
    out = []
    for v in values:
        v0, v1 = F.col(f"_left.{v}"), F.col(f"_right.{v}")
        lin = F.when(at == t0, v0).otherwise(v0 + (v1 - v0) * ((at - t0) / (t1 - t0)))
        out.append(F.coalesce(lin, F.lit(0.0)).alias(v))
    return rows.select(*kept, *out)


def merge_bands(
    lc: DataFrame, burst: str = "burst_id", band: str = "band", same_grid: bool = False
) -> DataFrame:
    """Sum of all bands on the grid of the first band (lowest band name), errors in quadrature."""
    if not same_grid:
        first = lc.groupBy(burst).agg(F.min(band).alias("_first"))
        grid = attach(lc, first, [burst]).filter(F.col(band) == F.col("_first")).select(burst, "t", "binsize")
        bands = lc.select(burst, band).distinct()
        targets = grid.join(bands, burst)
        lc = regrid_linear(lc, targets, [burst, band], ["rate", "rate_err"])
    return lc.groupBy(burst, "t").agg(
        F.sum("rate").alias("rate"),
        F.sqrt(F.sum(F.col("rate_err") * F.col("rate_err"))).alias("rate_err"),
        F.min("binsize").alias("binsize"),
        F.array_join(F.array_sort(F.collect_set(band)), ", ").alias("bands"),
    )


def band_label(emin: Column, emax: Column) -> Column:
    """'15-25 keV', or '' when a limit is missing."""
    return F.when(
        emin.isNotNull() & emax.isNotNull(),
        F.concat(F.bround(emin).cast("long").cast("string"), F.lit("-"),
                 F.bround(emax).cast("long").cast("string"), F.lit(" keV")),
    ).otherwise(F.lit(""))
