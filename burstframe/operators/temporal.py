"""Temporal properties: durations, variability, autocorrelation, pulses, hardness, lags."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from burstframe.operators import lag_fit
from burstframe.operators.fit import Axis, curvature_errors, profile_fit
from burstframe.operators.lag_fit import fine_grid_lag, fit_lag, lag_errors  # noqa: F401
from burstframe.operators.lags import BLOCK, blocks, lag_products
from burstframe.operators.lightcurve import KEYS, find_peak, rebin, regrid_linear
from burstframe.operators.reuse import keep
from burstframe.operators.series import attach, dense_grid, running_sums, sliding, with_position


def cumulative_counts(lc: DataFrame, keys: Sequence[str] = KEYS, pos: str = "bin_idx") -> DataFrame:
    """Running sum of the rate."""
    return running_sums(lc, keys, pos, {"cum_rate": F.col("rate")})


def _interp_time(left: Column, right: Column, first: Column, p: float) -> Column:
    """Time at fraction p between the last point at or below p and the first above it."""
    slope = (right["t"] - left["t"]) / (right["f"] - left["f"])
    return (
        F.when(left.isNull(), first).when(right.isNull(), left["t"])
        .otherwise(slope * (F.lit(p) - left["f"]) + left["t"])
    )


def duration(
    lc: DataFrame, fraction: float = 0.9, keys: Sequence[str] = KEYS, pos: str = "bin_idx", prefix: str = ""
) -> DataFrame:
    """Interval holding the central ``fraction`` of the counts, by linear interpolation.

    Series with no positive total give NULLs.
    """
    lo, hi = (1 - fraction) / 2, 1 - (1 - fraction) / 2
    counts = F.col("rate") * F.col("binsize")
    total = lc.groupBy(*keys).agg(F.sum(counts).alias("_total"))
    rows = attach(running_sums(lc, keys, pos, {"_cum": counts}), total, keys)
    f = F.when(F.col("_total") != 0, F.col("_cum") / F.col("_total"))
    pt = F.struct(f.alias("f"), F.col("t").alias("t"))
    agg = rows.groupBy(*keys).agg(
        F.min_by("t", F.col(pos)).alias("_first"), F.max("_total").alias("_total"),
        *[F.max_by(F.when(f <= p, pt), F.when(f <= p, F.col(pos))).alias(f"_l{i}") for i, p in enumerate((lo, hi))],
        *[F.min_by(F.when(f > p, pt), F.when(f > p, F.col(pos))).alias(f"_r{i}") for i, p in enumerate((lo, hi))],
    )
    ok = F.col("_total") != 0
    start = F.when(ok, _interp_time(F.col("_l0"), F.col("_r0"), F.col("_first"), lo))
    end = F.when(ok, _interp_time(F.col("_l1"), F.col("_r1"), F.col("_first"), hi))
    out = agg.select(*keys, "_total", start.alias(f"{prefix}t_start"), end.alias(f"{prefix}t_end"))
    dur = F.col(f"{prefix}t_end") - F.col(f"{prefix}t_start")
    return out.select(
        *keys, f"{prefix}t_start", f"{prefix}t_end", dur.alias(f"{prefix}duration"),
        F.when(F.col("_total") > 0, dur * F.sqrt(F.lit(2.0) / F.col("_total"))).alias(f"{prefix}duration_err"),
    )


def t90_bootstrap_error(
    lc: DataFrame, n_sims: int = 100, confidence: float = 0.9, seed: int = 1,
    keys: Sequence[str] = KEYS, pos: str = "bin_idx",
) -> DataFrame:
    """Population deviation of the duration over resampled series (bins drawn with replacement).

    Draw i of simulation s picks bin floor(u(s, i) * n) with a hash-seeded u, so retries repeat it.
    Draws are counted per (series, simulation, bin) map-side; the resampled series stays in time order.
    """
    lo, hi = (1 - confidence) / 2, 1 - (1 - confidence) / 2
    sizes = lc.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    draws = attach(lc.select(*keys, pos), sizes, keys).withColumn(
        "_sim", F.explode(F.sequence(F.lit(0), F.lit(n_sims - 1)))
    )
    u = F.shiftrightunsigned(F.xxhash64(F.lit(seed), *keys, F.col("_sim"), F.col(pos)), 11) / F.lit(2.0**53)
    picks = draws.groupBy(*keys, "_sim", F.floor(u * F.col("_n")).cast("long").alias(pos)).agg(
        F.count(F.lit(1)).alias("_m")
    )
    per = picks.join(lc.select(*keys, pos, "t", (F.col("rate") * F.col("binsize")).alias("_c")), [*keys, pos])
    sim = [*keys, "_sim"]
    cum = running_sums(per, sim, pos, {"_cum": F.col("_c") * F.col("_m")})
    total = per.groupBy(*sim).agg(F.sum(F.col("_c") * F.col("_m")).alias("_total")).filter("_total > 0")
    rows = attach(cum, total, sim)
    # a bin drawn m times contributes its first copy (interpolated into) and its last copy
    first_f = (F.col("_cum") - F.col("_c") * (F.col("_m") - 1)) / F.col("_total")
    last_f = F.col("_cum") / F.col("_total")
    pts = rows.select(*sim, F.inline(F.array(
        F.struct((F.col(pos) * 2).alias("o"), first_f.alias("f"), F.col("t").alias("t")),
        F.struct((F.col(pos) * 2 + 1).alias("o"), last_f.alias("f"), F.col("t").alias("t")),
    )))
    return _resampled_deviation(sizes, pts, keys, lo, hi)


def _resampled_deviation(sizes: DataFrame, pts: DataFrame, keys: Sequence[str], lo: float, hi: float) -> DataFrame:
    """Deviation of the durations of resampled series given as (keys, _sim, order o, cumulative fraction f, time t)."""
    sim = [*keys, "_sim"]
    f, pt = F.col("f"), F.struct("f", "t")
    agg = pts.groupBy(*sim).agg(
        F.min_by("t", "o").alias("_first"),
        *[F.max_by(F.when(f <= p, pt), F.when(f <= p, F.col("o"))).alias(f"_l{i}") for i, p in enumerate((lo, hi))],
        *[F.min_by(F.when(f > p, pt), F.when(f > p, F.col("o"))).alias(f"_r{i}") for i, p in enumerate((lo, hi))],
    )
    dur = (_interp_time(F.col("_l1"), F.col("_r1"), F.col("_first"), hi)
           - _interp_time(F.col("_l0"), F.col("_r0"), F.col("_first"), lo))
    errs = agg.groupBy(*keys).agg(F.stddev_pop(dur).alias("t90_err"), F.count(F.lit(1)).alias("n_valid"))
    return attach(sizes, errs, keys, "left").select(
        *keys, F.coalesce("t90_err", F.lit(0.0)).alias("t90_err"), F.coalesce("n_valid", F.lit(0)).alias("n_valid"))


def t90_bootstrap_draw_order(
    lc: DataFrame, n_sims: int = 100, confidence: float = 0.9, seed: int = 1,
    keys: Sequence[str] = KEYS, pos: str = "bin_idx",
) -> DataFrame:
    """As :func:`t90_bootstrap_error`, but counts are cumulated in the order of the draws, so single durations may be negative.

    ``pos`` numbers the bins of a series from 0 without gaps.  Draw i of simulation s picks bin floor(u * n), u being the first 52 bits of the md5 of
    'seed|keys|s|i'; null keys are left out of that text.  The drawn bins come by a join on (series, bin), sums run over chunks of draws, so
    neither a series nor a simulation has to fit a task.  Simulations without a positive total are skipped; a series without any has error 0.
    """
    keys = list(keys)
    lo, hi = (1 - confidence) / 2, 1 - (1 - confidence) / 2
    sim = [*keys, "_sim"]
    sizes = lc.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    draws = attach(lc.select(*keys, F.col(pos).alias("o")), sizes, keys).withColumn("_sim", F.explode(F.sequence(F.lit(0), F.lit(n_sims - 1))))
    u = F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(seed), *keys, "_sim", "o")), 1, 13), 16, 10).cast("double") / F.lit(2.0**52)
    draws = draws.select(*sim, "o", F.floor(u * F.col("_n")).cast("long").alias(pos))
    drawn = keep(draws.join(lc.select(*keys, F.col(pos).cast("long").alias(pos), "t", (F.col("rate") * F.col("binsize")).alias("_c")), [*keys, pos]))
    total = drawn.groupBy(*sim).agg(F.sum("_c").alias("_total")).filter("_total > 0")
    pts = attach(running_sums(drawn, sim, "o", {"_cum": F.col("_c")}), total, sim).select(*sim, "o", (F.col("_cum") / F.col("_total")).alias("f"), "t")
    return _resampled_deviation(sizes, pts, keys, lo, hi)


def peak_flux(lc: DataFrame, binsize: float = 1.0, keys: Sequence[str] = KEYS) -> DataFrame:
    """Peak after rebinning to ``binsize``."""
    return find_peak(rebin(lc, binsize, keys), keys)


def variability_index(rate: str = "rate") -> Column:
    hi, lo = F.max(rate), F.min(rate)
    return (
        F.when(hi + lo == 0, F.lit(0.0))
        .otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.try_divide(hi - lo, hi + lo))))
    )


def fractional_rms(rate: str = "rate", err: str = "rate_err") -> Column:
    excess = F.var_pop(rate) - F.avg(F.col(err) * F.col(err))
    mean = F.avg(rate)
    return F.when((excess > 0) & (mean != 0), F.try_divide(F.sqrt(excess), mean)).otherwise(F.lit(0.0))


def variability(lc: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    return lc.groupBy(*keys).agg(
        variability_index().alias("variability_index"), fractional_rms().alias("fractional_rms"))


def autocorrelation(
    lc: DataFrame, max_lag: int | None = None, keys: Sequence[str] = KEYS, pos: str = "bin_idx",
    block: int = BLOCK,
) -> DataFrame:
    """Autocorrelation of the mean-subtracted rate for lags 0 .. max_lag-1 (default n // 4)."""
    stats = lc.groupBy(*keys).agg(
        F.avg("rate").alias("_m"), F.count(F.lit(1)).alias("_n"), F.max("binsize").alias("_bs"))
    rows = attach(lc, stats, keys).withColumn("_x", F.col("rate") - F.col("_m"))
    top = (F.floor(F.col("_n") / 4) if max_lag is None else F.least(F.lit(max_lag), F.col("_n"))) - 1
    prods = lag_products(rows, keys, pos, "_x", "_x", F.lit(0), top.cast("long"), "_n", block)
    zero = prods.filter("lag = 0").select(*keys, F.col("sxy").alias("_z"))
    return prods.join(zero, list(keys)).join(stats.select(*keys, "_bs"), list(keys)).select(
        *keys, "lag", (F.col("lag") * F.col("_bs")).alias("lag_time"),
        F.when(F.col("_z") != 0, F.col("sxy") / F.col("_z")).alias("acf"))


def minimum_variability_timescale(acf: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """First lag with acf < 0.5, else the last lag."""
    return acf.groupBy(*keys).agg(
        F.coalesce(F.min(F.when(F.col("acf") < 0.5, F.col("lag_time"))), F.max("lag_time")).alias("min_timescale"))


_BOUNDS = T.ArrayType(T.StructType([T.StructField(c, T.LongType()) for c in ("pos", "left", "right")]))


@F.pandas_udf(_BOUNDS)
def _local_bounds(rates: pd.Series, start: pd.Series, peaks: pd.Series) -> pd.Series:
    """Positions next to the nearest bin at or above half of each peak, -1 when outside the block."""
    out = []
    for r, s, ps in zip(rates, start, peaks):
        r = np.asarray(r)
        found = []
        for p in ps:
            i = p - s
            high = np.flatnonzero(r >= r[i] / 2)
            j = np.searchsorted(high, i)
            left = high[j - 1] + 1 + s if j > 0 else -1
            right = high[j + 1] - 1 + s if j + 1 < len(high) else -1
            found.append({"pos": int(p), "left": int(left), "right": int(right)})
        out.append(found)
    return pd.Series(out)


def detect_pulses(lc: DataFrame, keys: Sequence[str] = KEYS, pos: str = "bin_idx", block: int = BLOCK) -> DataFrame:
    """Strict local maxima (middle of flat tops) at or above the mean rate, with their bounds.

    A bound moves outward while the next bin is below half of the peak.  Bounds are found
    inside the block of the peak; the few peaks without one there (their heights at least double from one to
    the next) look up the nearest block whose maximum is high enough.
    """
    keys = list(keys)
    flagged = sliding(lc.select(*keys, pos, "t", "rate"), keys, pos, 1,
                      lambda w: {"_new": (F.coalesce(F.lag("rate", 1).over(w) != F.col("rate"), F.lit(True))).cast("long")})
    runs = running_sums(flagged, keys, pos, {"_run": F.col("_new")})
    tops = runs.groupBy(*keys, (F.col("_run") - 1).alias("_run")).agg(
        F.first("rate").alias("rate"), F.min(pos).alias("_a"), F.max(pos).alias("_z"))
    nb = sliding(tops, keys, "_run", 1, lambda w: {"_pr": F.lag("rate", 1).over(w), "_nr": F.lead("rate", 1).over(w)})
    stats = lc.groupBy(*keys).agg(F.avg("rate").alias("_mean"), F.max(pos).alias("_last"))
    peaks = keep(attach(nb.filter("rate > _pr AND rate > _nr"), stats, keys).filter("rate >= _mean").select(
        *keys, F.floor((F.col("_a") + F.col("_z")) / 2).cast("long").alias("_peak"), "rate", "_last"))
    size = F.lit(block)
    blk = keep(blocks(lc, keys, pos, ["rate"], block))
    grouped = peaks.groupBy(*keys, F.floor(F.col("_peak") / size).cast("long").alias("_b")).agg(
        F.collect_list("_peak").alias("_peaks"))
    local = grouped.join(blk, [*keys, "_b"]).select(
        *keys, F.inline(_local_bounds("rate", F.col("_b") * size, "_peaks"))).withColumnRenamed("pos", "_peak")
    known = keep(peaks.join(local, [*keys, "_peak"]))
    tops_of = blk.select(*keys, F.col("_b").alias("_ob"), F.array_max("rate").alias("_bmax"))
    own = F.floor(F.col("_peak") / size).cast("long")

    def far(side: str) -> DataFrame:
        open_ = known.filter(F.col(side) < 0).select(*keys, "_peak", (F.col("rate") / 2).alias("_half"))
        before = F.col("_ob") < own if side == "left" else F.col("_ob") > own
        pick = F.max("_ob") if side == "left" else F.min("_ob")
        at = open_.join(tops_of, keys).filter(before & (F.col("_bmax") >= F.col("_half"))).groupBy(
            *keys, "_peak", "_half").agg(pick.alias("_b"))
        hit = at.join(blk, [*keys, "_b"])
        numbered = F.transform("rate", lambda v, i: F.when(v >= F.col("_half"), i.cast("long")))
        edge = F.array_max(numbered) + 1 if side == "left" else F.array_min(numbered) - 1
        return hit.select(*keys, "_peak", (edge + F.col("_b") * size).alias(f"_{side}"))

    full = known.join(far("left"), [*keys, "_peak"], "left").join(far("right"), [*keys, "_peak"], "left")
    bounded = full.select(
        *keys, "_peak", F.col("rate").alias("peak_rate"),
        F.when(F.col("left") >= 0, F.col("left")).otherwise(F.coalesce("_left", F.lit(0))).alias("_lo"),
        F.when(F.col("right") >= 0, F.col("right")).otherwise(F.coalesce("_right", F.col("_last"))).alias("_hi"))
    # three time look-ups in one pass over the bins instead of three joins
    wanted = bounded.select(*keys, "_peak", "peak_rate", F.inline(F.array(
        F.struct(F.col("_peak").alias(pos), F.lit("p").alias("_what")),
        F.struct(F.col("_lo").alias(pos), F.lit("s").alias("_what")),
        F.struct(F.col("_hi").alias(pos), F.lit("e").alias("_what")))))
    timed = wanted.join(lc.select(*keys, pos, "t"), [*keys, pos])
    what = F.col("_what")
    return timed.groupBy(*keys, "_peak", "peak_rate").agg(
        F.max(F.when(what == "p", F.col("t"))).alias("peak_time"),
        F.max(F.when(what == "s", F.col("t"))).alias("start_time"),
        F.max(F.when(what == "e", F.col("t"))).alias("end_time"),
    ).withColumn("width", F.col("end_time") - F.col("start_time")).drop("_peak")


def hardness_columns(h: Column, s: Column, eh: Column, es: Column) -> tuple[Column, Column, Column]:
    """(H-S)/(H+S), its error, and H/S; the normalised pair is 0 where H+S <= 0."""
    tot = h + s
    norm = F.when(tot > 0, F.try_divide(h - s, tot)).otherwise(F.lit(0.0))
    var = F.try_divide(F.lit(4.0) * s * s * eh * eh + F.lit(4.0) * h * h * es * es, tot * tot * tot * tot)
    err = F.when(tot > 0, F.sqrt(var)).otherwise(F.lit(0.0))
    return norm, err, F.when(s > 0, F.try_divide(h, s))


def hardness_ratio(
    lc: DataFrame, hard: str, soft: str, burst: str = "burst_id", band: str = "band", same_grid: bool = False
) -> DataFrame:
    """Hardness evolution on the grid with fewer points (ties: the soft one)."""
    both = lc.filter(F.col(band).isin(hard, soft))
    is_hard = F.col(band) == hard
    if not same_grid:
        n = both.groupBy(burst).agg(
            F.sum(is_hard.cast("long")).alias("_nh"), F.sum((~is_hard).cast("long")).alias("_ns")
        ).filter("_nh > 0 AND _ns > 0").select(
            burst, F.when(F.col("_nh") < F.col("_ns"), F.lit(hard)).otherwise(F.lit(soft)).alias("_grid"))
        grid = attach(both, n, [burst]).filter(F.col(band) == F.col("_grid")).select(burst, "t")
        targets = grid.select(burst, "t", F.explode(F.array(F.lit(hard), F.lit(soft))).alias(band))
        both = regrid_linear(both, targets, [burst, band], ["rate", "rate_err"])
    wide = both.groupBy(burst, "t").agg(
        F.max(F.when(is_hard, F.col("rate"))).alias("_h"), F.max(F.when(~is_hard, F.col("rate"))).alias("_s"),
        F.max(F.when(is_hard, F.col("rate_err"))).alias("_eh"), F.max(F.when(~is_hard, F.col("rate_err"))).alias("_es"),
    ).filter("_h IS NOT NULL AND _s IS NOT NULL")
    norm, err, ratio = hardness_columns(*[F.col(c) for c in ("_h", "_s", "_eh", "_es")])
    return wide.select(burst, "t", norm.alias("hr_norm"), err.alias("hr_err"), ratio.alias("hr_ratio"))


def _overlap(lc: DataFrame, low: str, high: str, burst: str, band: str) -> DataFrame:
    """Rows of two bands inside their common time range, numbered per band, on one wide row per position."""
    pair = lc.filter(F.col(band).isin(low, high))
    ends = pair.groupBy(burst, band).agg(F.min("t").alias("_a"), F.max("t").alias("_z"))
    common = ends.groupBy(burst).agg(F.max("_a").alias("_a"), F.min("_z").alias("_z"), F.count(F.lit(1)).alias("_k"))
    kept = attach(pair, common.filter("_k = 2"), [burst]).filter(F.col("t").between(F.col("_a"), F.col("_z")))
    return kept.drop("_a", "_z", "_k")


def simple_lag(
    lc: DataFrame, low: str, high: str, burst: str = "burst_id", band: str = "band", block: int = BLOCK
) -> DataFrame:
    """Lag of the first maximum of the z-scored cross-correlation; positive when ``high`` comes later."""
    kept = keep(with_position(_overlap(lc, low, high, burst, band), [burst, band], ["t"], "_pos", "_n"))
    stats = kept.groupBy(burst, band).agg(F.avg("rate").alias("_m"), F.stddev_pop("rate").alias("_sd"))
    z = keep(attach(kept, stats, [burst, band]).withColumn(
        "_z", F.when(F.col("_sd") > 0, (F.col("rate") - F.col("_m")) / F.col("_sd"))))
    is_low = F.col(band) == low
    wide = z.groupBy(burst, "_pos").agg(
        F.max(F.when(is_low, F.col("_z"))).alias("_x"), F.max(F.when(~is_low, F.col("_z"))).alias("_y"))
    sizes = z.groupBy(burst).agg(
        F.max(F.when(is_low, F.col("_n"))).alias("_nl"), F.max(F.when(~is_low, F.col("_n"))).alias("_nh"),
        F.max(F.when(~is_low, F.col("binsize"))).alias("_bs"),
        F.min("_sd").alias("_sd"))
    ok = sizes.filter("_nl >= 2 AND _nh >= 2 AND _sd > 0")
    n = F.greatest("_nl", "_nh")
    rows = attach(wide, ok.withColumn("_n", n), [burst]).select(
        burst, "_pos", F.coalesce("_x", F.lit(0.0)).alias("_x"), F.coalesce("_y", F.lit(0.0)).alias("_y"), "_n")
    prods = lag_products(rows, [burst], "_pos", "_x", "_y", -F.col("_n"), F.col("_n"), "_n", block)
    idx = F.col("lag") + F.floor(F.col("_nl") / 2)
    xc = attach(prods, ok, [burst]).withColumn("_i", idx).filter((F.col("_i") >= 0) & (F.col("_i") < F.col("_nh")))
    xc = keep(xc.withColumn("_lag", F.col("_i") - F.floor(F.col("_nh") / 2)))
    # round-off must not decide which of two equal maxima is the first
    val = F.round("sxy", 9)
    top = xc.groupBy(burst).agg(F.max(val).alias("_max"), F.max("_bs").alias("_bs"))
    marked = attach(xc.drop("_bs"), top, [burst])
    hit = marked.groupBy(burst).agg(
        F.min(F.when(val == F.col("_max"), F.col("_lag"))).alias("_peak"),
        F.max(F.when(val / F.col("_max") > 0.5, F.col("_lag"))).alias("_b"),
        F.min(F.when(val / F.col("_max") > 0.5, F.col("_lag"))).alias("_a"),
        F.max("_bs").alias("_bs"))
    out = hit.select(
        burst, (F.col("_peak") * F.col("_bs")).alias("lag"),
        F.coalesce((F.col("_b") - F.col("_a")) * F.col("_bs") / 2, F.col("_bs")).alias("lag_err"))
    return attach(sizes.select(burst), out, [burst], "left").select(
        burst, F.coalesce("lag", F.lit(0.0)).alias("lag"), F.coalesce("lag_err", F.lit(0.0)).alias("lag_err"))


def prepare_lag_pair(
    lc: DataFrame, low: str, high: str, tstart: float, tstop: float, burst: str = "burst_id", band: str = "band",
    center: bool = True,
) -> DataFrame:
    """Trim, interpolate both bands to the finer common grid, subtract means.

    Rows: (burst, pos, t, n, dt, low, high, low_err, high_err, x, y).  Bursts with fewer than four
    grid points are left out here and listed by :func:`lag_pair_rejected`.
    """
    grid = _lag_grid(lc, low, high, tstart, tstop, burst, band).filter("_n >= 4")
    cut = lc.filter(F.col(band).isin(low, high) & F.col("t").between(tstart, tstop))
    points = dense_grid(grid, F.col("_n"), "pos").select(
        burst, "pos", (F.col("_t0") + F.col("pos") * F.col("_dt")).alias("t"))
    targets = points.select("*", F.explode(F.array(F.lit(low), F.lit(high))).alias(band))
    on = regrid_linear(cut, targets, [burst, band], ["rate", "rate_err"])
    is_low = F.col(band) == low
    pick = lambda c, cond, a: F.max(F.when(cond, F.col(c))).alias(a)
    wide = keep(on.groupBy(burst, "pos", "t").agg(
        pick("rate", is_low, "low"), pick("rate", ~is_low, "high"),
        pick("rate_err", is_low, "low_err"), pick("rate_err", ~is_low, "high_err")))
    means = wide.groupBy(burst).agg(F.avg("low").alias("_ml"), F.avg("high").alias("_mh"))
    sized = attach(attach(wide, means, [burst]), grid.select(burst, F.col("_n").alias("n"), F.col("_dt").alias("dt")), [burst])
    return sized.select(
        burst, "pos", "t", "n", "dt", "low", "high", "low_err", "high_err",
        (F.col("low") - F.col("_ml") if center else F.col("low")).alias("x"),
        (F.col("high") - F.col("_mh") if center else F.col("high")).alias("y"))


def _lag_grid(lc, low, high, tstart, tstop, burst, band):
    cut = lc.filter(F.col(band).isin(low, high) & F.col("t").between(tstart, tstop))
    ends = cut.groupBy(burst, band).agg(F.min("t").alias("_a"), F.max("t").alias("_z"), F.min("binsize").alias("_b"))
    g = ends.groupBy(burst).agg(F.max("_a").alias("_t0"), F.min("_z").alias("_t1"), F.min("_b").alias("_dt"),
                                F.count(F.lit(1)).alias("_k")).filter("_k = 2")
    n = F.ceil((F.col("_t1") + F.col("_dt") / 2 - F.col("_t0")) / F.col("_dt"))
    return g.withColumn("_n", F.greatest(n, F.lit(0)).cast("long"))


def lag_pair_rejected(lc, low, high, tstart, tstop, burst="burst_id", band="band") -> DataFrame:
    return _lag_grid(lc, low, high, tstart, tstop, burst, band).filter("_n < 4").select(
        burst, F.lit("fewer than four overlapping bins").alias("reason"))


def cross_correlation(pair: DataFrame, burst: str = "burst_id", block: int = BLOCK) -> DataFrame:
    """Normalised discrete cross-correlation at every lag -n .. n (zero where undefined)."""
    norm = pair.groupBy(burst).agg(
        F.sqrt(F.sum(F.col("x") * F.col("x")) * F.sum(F.col("y") * F.col("y"))).alias("_norm"),
        F.max("n").alias("_n"), F.max("dt").alias("_dt"))
    prods = lag_products(pair.withColumnRenamed("n", "_n"), [burst], "pos", "x", "y",
                         -F.col("_n"), F.col("_n"), "_n", block)
    grid = dense_grid(norm, F.col("_n") * 2 + 1, "_i").withColumn("lag", F.col("_i") - F.col("_n"))
    return grid.join(prods, [burst, "lag"], "left").select(
        burst, "lag", (F.col("lag") * F.col("_dt")).alias("offset"),
        F.when(F.col("_norm") == 0, F.lit(0.0))
        .otherwise(F.coalesce(F.try_divide("sxy", "_norm"), F.lit(0.0))).alias("ccf"))


def split_normal(x: Column, const: Column, amplitude: Column, mu: Column, s1: Column, s2: Column) -> Column:
    """const + amplitude * exp(-(x-mu)^2 / 2 s^2), s = s1 left of mu and s2 right of it."""
    s = F.when(x < mu, s1).otherwise(s2)
    d = (x - mu) / s
    return const + amplitude * F.exp(-(d * d) / F.lit(2.0))


def cross_correlation_errors(
    pair: DataFrame, n_sims: int = 10000, noise: str = "errors", seed: int = 1,
    burst: str = "burst_id", sims_per_task: int = 500, block: int = lag_fit.CELLS,
) -> DataFrame:
    """Population deviation of the correlation per lag over noisy copies of both series.

    ``noise`` is 'errors' (measured errors) or 'poisson' (sqrt of the rate).  Work is split by (burst, simulation range); a task draws
    ``block`` values at a time (one simulation at least) and ships two moments per lag.
    """
    scale = (lambda r, e: F.sqrt(F.abs(F.col(r)))) if noise == "poisson" else (lambda r, e: F.abs(F.col(e)))
    return lag_fit.correlation_errors(pair, n_sims, scale, seed, burst, sims_per_task, block)


def spectral_lag(
    pair: DataFrame, n_ccf_sims: int = 10000, n_lag_sims: int = 1000, noise: str = "errors", burst: str = "burst_id"
) -> DataFrame:
    """Observed correlation, its errors, the fitted lag and the lag error in one row per burst."""
    pair = keep(pair)
    errs = cross_correlation_errors(pair, n_ccf_sims, noise, burst=burst)
    ccf = keep(cross_correlation(pair, burst).join(errs, [burst, "lag"]))
    fit = keep(fit_lag(ccf, burst))
    return attach(fit, lag_errors(ccf, fit, n_lag_sims, burst=burst), [burst], "left").withColumns(
        {"n_ccf_sims": F.lit(n_ccf_sims), "n_lag_sims": F.lit(n_lag_sims)})


def fit_fred_pulse(lc: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Fast-rise exponential-decay pulse A exp(-tau1/(t-ts) - (t-ts)/tau2), zero before ts.

    Limits scale with the peak time, which must be positive; bins without an error count with unit weight.
    """
    keys = list(keys)
    pk = find_peak(lc, keys).filter("peak_time > 0").select(
        *keys, (F.col("peak_rate") * 10).alias("_amax"), F.lit(0.0).alias("_amin"), F.lit(1e-4).alias("_tau0"),
        F.col("peak_time").alias("_tau1"), (F.col("peak_time") * 2).alias("_tau2"),
        (F.col("peak_time") * 0.1).alias("_ts0"), (F.col("peak_time") * 0.9).alias("_ts1"))
    pts = attach(lc, pk, keys).withColumn("_e", F.when(F.col("rate_err") > 0, F.col("rate_err")).otherwise(F.lit(1.0)))

    def model(p, x):
        dt = x.col("t") - p["t_start"]
        return x.when(dt > 0, x.exp(-p["tau_rise"] / dt - dt / p["tau_decay"]), 0.0)

    axes = [Axis("tau_rise", "_tau0", "_tau1", 9, True), Axis("tau_decay", "_tau0", "_tau2", 11, True),
            Axis("t_start", "_ts0", "_ts1", 7)]
    fit = profile_fit(pts, keys, axes, model, y="rate", err="_e", norm_bounds=("_amin", "_amax"), min_points=4)
    errs = curvature_errors(pts, keys, fit, [a.name for a in axes], model, y="rate", err="_e")
    out = attach(fit, errs, keys, "left").withColumnsRenamed(
        {"norm": "amplitude", "stat": "chi_sq", "norm_err": "amplitude_err"}).withColumn("dof", F.col("n_points") - 4)
    every = lc.select(*keys).distinct()
    return attach(every, out, keys, "left").withColumn("fit_success", F.coalesce("fit_success", F.lit(False)))
