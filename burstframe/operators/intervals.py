"""Burst intervals, polynomial background and net-count durations of detector light curves."""

from __future__ import annotations

from collections.abc import Sequence
from math import comb

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from burstframe.operators.blocks import bayesian_block_edges
from burstframe.operators.lightcurve import KEYS
from burstframe.operators.reuse import keep
from burstframe.operators.series import asof_merge, attach, running_sums, sliding, with_position

PRE = -10.0
COLS = ("tstart", "tstop", "snr", "confidence", "method")


def snr_interval(lc: DataFrame, keys: Sequence[str] = KEYS, threshold: float = 3.0) -> DataFrame:
    """First and last bin above the pre-burst mean by ``threshold`` deviations (>= 10 pre-burst bins)."""
    pre = lc.filter(F.col("t") < PRE).groupBy(*keys).agg(
        F.avg("rate").alias("_m"), F.stddev_pop("rate").alias("_s"), F.count(F.lit(1)).alias("_k")
    ).filter("_k >= 10 AND _s > 0")
    snr = (F.col("rate") - F.col("_m")) / F.col("_s")
    hit = attach(lc, pre, keys).withColumn("_snr", snr).groupBy(*keys).agg(
        F.min(F.when(F.col("_snr") > threshold, F.col("t"))).alias("tstart"),
        F.max(F.when(F.col("_snr") > threshold, F.col("t"))).alias("tstop"), F.max("_snr").alias("snr"))
    return hit.filter("tstart IS NOT NULL").select(
        *keys, "tstart", "tstop", "snr", F.least(F.col("snr") / 10, F.lit(1.0)).alias("confidence"),
        F.lit("snr_threshold").alias("method"))


def cumulative_interval(lc: DataFrame, keys: Sequence[str] = KEYS, pos: str = "bin_idx", threshold: float = 5.0) -> DataFrame:
    """Departure of the cumulative counts from the line through the pre-burst part."""
    keys = list(keys)
    cum = keep(running_sums(lc.select(*keys, pos, "t", "counts"), keys, pos, {"_cum": F.col("counts").cast("double")}))
    pre = F.col("t") < PRE
    line = cum.filter(pre).groupBy(*keys).agg(
        F.regr_slope("_cum", "t").alias("_sl"), F.regr_intercept("_cum", "t").alias("_ic"), F.count(F.lit(1)).alias("_k")
    ).filter("_k >= 10")
    dev = attach(cum, line, keys).withColumn("_dev", F.col("_cum") - (F.col("_sl") * F.col("t") + F.col("_ic")))
    sd = dev.filter(pre).groupBy(*keys).agg(F.stddev_pop("_dev").alias("_sd")).filter("_sd > 0")
    nd = attach(dev, sd, keys).withColumn("_nd", F.col("_dev") / F.col("_sd"))
    peak = nd.groupBy(*keys).agg(F.max("_nd").alias("snr"))
    flagged = with_position(nd.filter(F.col("_nd") > threshold).select(*keys, "t", "_dev"), keys, ["t"], "_i", "_nf")
    steps = keep(sliding(flagged, keys, "_i", 1, lambda w: {"_step": F.lead("_dev", 1).over(w) - F.col("_dev")}))
    spread = steps.groupBy(*keys).agg(
        F.stddev_pop("_step").alias("_ss"), F.min("t").alias("tstart"), F.max("t").alias("_last"), F.max("_nf").alias("_nf"))
    flat = attach(steps, spread.select(*keys, "_ss"), keys).filter(F.abs("_step") < F.col("_ss") * 0.5).groupBy(*keys).agg(
        F.min("t").alias("_flat"))
    out = attach(attach(spread, flat, keys, "left"), peak, keys)
    return out.select(
        *keys, "tstart", F.when(F.col("_nf") > 10, F.coalesce("_flat", "_last")).otherwise(F.col("_last")).alias("tstop"), "snr",
        F.lit(0.7).alias("confidence"), F.lit("cumulative").alias("method"))


def block_interval(lc: DataFrame, keys: Sequence[str] = KEYS, p0: float = 0.01) -> DataFrame:
    """Blocks above the mean of the two lowest by two deviations, else the highest block."""
    keys = list(keys)
    edges = keep(bayesian_block_edges(lc, keys, "events", p0))
    several = edges.groupBy(*keys).agg(F.count(F.lit(1)).alias("_nb")).filter("_nb >= 2").drop("_nb")
    starts = attach(edges, several, keys).select(*keys, F.col("t_lo").alias("t"), "block", "t_lo", "t_hi")
    at = asof_merge(starts, lc.select(*keys, "t", "counts"), keys, "t", ["block", "t_lo", "t_hi"]).filter("t < _left.t_hi")
    sums = at.groupBy(*keys, F.col("_left.block").alias("block"), F.col("_left.t_lo").alias("t_lo"), F.col("_left.t_hi").alias("t_hi")).agg(F.sum("counts").alias("_sum")).select(
        *keys, "block", "t_lo", "t_hi", (F.col("_sum") / (F.col("t_hi") - F.col("t_lo"))).alias("r"))
    # two lowest and the highest rate without a window: nested min over (rate, block)
    rec = F.struct("r", "block")
    low1 = sums.groupBy(*keys).agg(F.min(rec).alias("_l1"), F.max(F.struct("r", -F.col("block"), "t_lo", "t_hi")).alias("_top"),
                                   F.count(F.lit(1)).alias("_k"))
    low2 = attach(sums, low1.select(*keys, "_l1"), keys).filter(rec > F.col("_l1")).groupBy(*keys).agg(F.min(rec).alias("_l2"))
    bg = attach(low1, low2, keys, "left").withColumn(
        "_bg", F.when(F.col("_k") > 1, (F.col("_l1.r") + F.col("_l2.r")) / 2).otherwise(F.lit(0.0)))
    cut = F.col("_bg") + 2 * F.sqrt(F.col("_bg") + 1)
    hit = attach(sums, bg.select(*keys, "_bg"), keys).filter(F.col("r") > cut).groupBy(*keys).agg(
        F.min("t_lo").alias("_s"), F.max("t_hi").alias("_e"))
    out = attach(bg, hit, keys, "left")
    snr = (F.col("_top.r") - F.col("_bg")) / F.greatest(F.sqrt("_bg"), F.lit(1.0))
    return out.select(
        *keys, F.coalesce("_s", "_top.t_lo").alias("tstart"), F.coalesce("_e", "_top.t_hi").alias("tstop"), snr.alias("snr"),
        F.least(snr / 10, F.lit(1.0)).alias("confidence"), F.lit("bayesian_blocks").alias("method"))


def consensus_interval(intervals: Sequence[DataFrame], keys: Sequence[str] = KEYS) -> DataFrame:
    """Median start and stop over the methods that found one; confidence n / 3."""
    every = None
    for iv in intervals:
        iv = iv.select(*keys, *COLS)
        every = iv if every is None else every.unionByName(iv)
    half = F.lit(0.5)
    return every.groupBy(*keys).agg(
        F.percentile("tstart", half).alias("tstart"), F.percentile("tstop", half).alias("tstop"),
        (F.count(F.lit(1)) / F.lit(3.0)).alias("confidence"), F.lit("combined").alias("method"))


MAX_ORDER = 4
_MODEL = T.StructType([
    T.StructField("poly_order", T.IntegerType()), T.StructField("coefficients", T.ArrayType(T.DoubleType())),
    T.StructField("bic", T.DoubleType()), T.StructField("chi2", T.DoubleType())])


@F.pandas_udf(_MODEL)
def _solve(moments: pd.Series, rhs: pd.Series, syy: pd.Series, n: pd.Series, mid: pd.Series, half: pd.Series) -> pd.DataFrame:
    """Best polynomial order by BIC from weighted sums of scaled time; coefficients of plain time, highest first."""
    out = []
    for m, y, yy, cnt, c, h in zip(moments, rhs, syy, n, mid, half):
        best = None
        for order in range(MAX_ORDER + 1):
            k = order + 1
            a = np.array([[m[i + j] for j in range(k)] for i in range(k)])
            b = np.asarray(y[:k], dtype=float)
            coef = np.linalg.lstsq(a, b, rcond=None)[0]
            chi2 = max(float(yy - 2 * coef @ b + coef @ a @ coef), 0.0)
            bic = chi2 + k * np.log(cnt)
            if best is None or bic < best[1]:
                best = (order, bic, chi2, coef)
        order, bic, chi2, coef = best
        plain = np.zeros(order + 1)
        for p, v in enumerate(coef):
            for j in range(p + 1):
                plain[j] += v * comb(p, j) * (-c) ** (p - j) / h**p
        out.append((order, [float(x) for x in plain[::-1]], float(bic), chi2))
    return pd.DataFrame(out, columns=_MODEL.names)


def polynomial_background(lc: DataFrame, intervals: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Weighted polynomial (order 0-4 by BIC) outside the burst +- max(5, 0.2 duration).

    One aggregate gives the weighted moments of scaled time; the 5x5 solves run on one row per series.
    """
    keys = list(keys)
    buf = F.greatest(F.lit(5.0), F.lit(0.2) * (F.col("tstop") - F.col("tstart")))
    iv = intervals.select(*keys, (F.col("tstart") - buf).alias("_b0"), (F.col("tstop") + buf).alias("_b1"))
    bg = attach(lc.select(*keys, "t", "rate", "rate_err"), iv, keys).filter((F.col("t") < F.col("_b0")) | (F.col("t") > F.col("_b1")))
    rng = bg.groupBy(*keys).agg(
        ((F.min("t") + F.max("t")) / 2).alias("_mid"), F.greatest((F.max("t") - F.min("t")) / 2, F.lit(1e-9)).alias("_half"),
        F.count(F.lit(1)).alias("_n"),
        F.min(F.when(F.col("t") < F.col("_b0"), F.col("t"))).alias("_p0"), F.max(F.when(F.col("t") < F.col("_b0"), F.col("t"))).alias("_p1"),
        F.min(F.when(F.col("t") > F.col("_b1"), F.col("t"))).alias("_q0"), F.max(F.when(F.col("t") > F.col("_b1"), F.col("t"))).alias("_q1"),
    ).filter("_n >= 10")
    x = (F.col("t") - F.col("_mid")) / F.col("_half")
    w = F.when(F.col("rate_err") > 0, F.lit(1.0) / (F.col("rate_err") * F.col("rate_err"))).otherwise(F.lit(1.0))
    rows = attach(bg, rng, keys).withColumns({"_x": x, "_w": w})

    def power(p: int) -> Column:
        c = F.lit(1.0)
        for _ in range(p):
            c = c * F.col("_x")
        return c

    sums = rows.groupBy(*keys, "_mid", "_half", "_n", "_p0", "_p1", "_q0", "_q1").agg(
        F.array(*[F.sum(F.col("_w") * power(p)) for p in range(2 * MAX_ORDER + 1)]).alias("_m"),
        F.array(*[F.sum(F.col("_w") * F.col("rate") * power(p)) for p in range(MAX_ORDER + 1)]).alias("_r"),
        F.sum(F.col("_w") * F.col("rate") * F.col("rate")).alias("_yy"))
    fit = sums.withColumn("_f", _solve("_m", "_r", "_yy", "_n", "_mid", "_half"))
    dof = F.greatest(F.col("_n") - F.col("_f.poly_order") - 1, F.lit(1))
    return fit.select(
        *keys, "_f.poly_order", "_f.coefficients", "_f.bic", (F.col("_f.chi2") / dof).alias("chi2_red"),
        (F.col("_f.bic") / dof).alias("bic_red"),
        F.struct(F.coalesce("_p0", F.lit(-100.0)).alias("lo"), F.coalesce("_p1", F.lit(-10.0)).alias("hi")).alias("pre_interval"),
        F.struct(F.coalesce("_q0", F.lit(100.0)).alias("lo"), F.coalesce("_q1", F.lit(300.0)).alias("hi")).alias("post_interval"))


def evaluate_polynomial(coefficients: Column, t: Column) -> Column:
    """Horner evaluation, highest power first."""
    return F.aggregate(coefficients, F.lit(0.0), lambda acc, c: acc * t + c)


def net_durations(
    lc: DataFrame, intervals: DataFrame, background: DataFrame | None = None, keys: Sequence[str] = KEYS, pos: str = "bin_idx"
) -> DataFrame:
    """T90 and T50 from net counts in the burst region +- max(5, 0.3 duration), as bin times.

    Without a background model the mean counts before start - 5 are used (0 when there are none).
    """
    keys = list(keys)
    iv = intervals.select(*keys, "tstart", "tstop")
    rows = attach(lc.select(*keys, pos, "t", "counts", "binsize"), iv, keys)
    flat = rows.filter(F.col("t") < F.col("tstart") - 5).groupBy(*keys).agg(F.avg("counts").alias("_flat"))
    rows = attach(rows, flat, keys, "left")
    level = F.coalesce("_flat", F.lit(0.0))
    if background is not None:
        rows = attach(rows, background.select(*keys, "coefficients"), keys, "left")
        level = F.coalesce(evaluate_polynomial(F.col("coefficients"), F.col("t")) * F.col("binsize"), level)
    buf = F.greatest(F.lit(5.0), F.lit(0.3) * (F.col("tstop") - F.col("tstart")))
    region = rows.filter(F.col("t").between(F.col("tstart") - buf, F.col("tstop") + buf)).select(
        *keys, pos, "t", F.greatest(F.col("counts") - level, F.lit(0.0)).alias("_net"))
    region = keep(region)
    cum = running_sums(region, keys, pos, {"_cum": F.col("_net")})
    total = region.groupBy(*keys).agg(F.sum("_net").alias("_tot")).filter("_tot > 0")
    # the last fraction is 1 by definition; rounding keeps sums of different order comparable
    frac = F.round(F.col("_cum") / F.col("_tot"), 12)
    at = lambda p: F.min(F.when(frac >= p, F.col("t")))
    q = attach(cum, total, keys).groupBy(*keys).agg(
        at(0.05).alias("_a"), at(0.95).alias("_b"), at(0.25).alias("_c"), at(0.75).alias("_d"))
    return q.select(*keys, (F.col("_b") - F.col("_a")).alias("t90"), F.col("_a").alias("t90_start"),
                    (F.col("_d") - F.col("_c")).alias("t50"), F.col("_c").alias("t50_start"))


def apply_overrides(intervals: DataFrame, overrides: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Reviewed start and stop replace the detected ones; rejected bursts drop out."""
    ov = overrides.select(*keys, F.col("tstart").alias("_s"), F.col("tstop").alias("_e"), F.col("accept").alias("_ok"))
    out = attach(intervals, ov, keys, "left").filter("coalesce(_ok, true)")
    changed = F.col("_s").isNotNull() | F.col("_e").isNotNull()
    return out.withColumns({
        "tstart": F.coalesce("_s", "tstart"), "tstop": F.coalesce("_e", "tstop"),
        "method": F.when(changed, "user_adjusted").otherwise(F.col("method"))}).drop("_s", "_e", "_ok")


def review_analysis(
    lc: DataFrame, result: DataFrame, overrides: DataFrame, keys: Sequence[str] = KEYS, model: str = "polynomial"
) -> DataFrame:
    """The result of :func:`detector_analysis` after a review; only the series with a new interval are computed again.

    ``overrides`` has at most one row per series: tstart, tstop (null keeps what stands) and accept (null counts as true).  A series with a new start or stop gets
    its background and durations anew and the method 'user_adjusted'; one that is not accepted keeps its values.  Both, and accepted ones, have the decision in
    ``note``.  Series without an interval, or without a review, stay as they are.  ``model`` is 'polynomial' or 'flat' (mean counts before the burst).
    """
    keys = list(keys)
    ov = overrides.select(*keys, F.col("tstart").cast("double").alias("_s"), F.col("tstop").cast("double").alias("_e"), F.coalesce("accept", F.lit(True)).alias("_ok"))
    rows = attach(result, ov, keys, "left").withColumn("_new", F.coalesce(
        F.col("_ok") & F.col("tstart").isNotNull() & (F.col("_s").isNotNull() | F.col("_e").isNotNull()), F.lit(False)))
    rows = keep(rows)
    start, stop = F.coalesce("_s", "tstart"), F.coalesce("_e", "tstop")
    todo = keep(rows.where("_new").select(*keys, start.alias("tstart"), stop.alias("tstop")))
    part = lc.join(todo.select(*keys), keys, "left_semi")
    if model == "polynomial":
        part = keep(part)
    bg = keep(polynomial_background(part, todo, keys)) if model == "polynomial" else None
    new = net_durations(part, todo, bg, keys)
    if bg is not None:
        new = attach(attach(todo.select(*keys), bg, keys, "left"), new, keys, "left")
    fresh = [c for c in new.columns if c not in keys and c in result.columns]
    out = attach(rows, new.select(*keys, *[F.col(c).alias(f"_n_{c}") for c in fresh]), keys, "left")
    said = (F.when(F.col("_new"), F.concat(F.lit("interval adjusted to ["), start.cast("string"), F.lit(", "), stop.cast("string"), F.lit("]")))
            .when(~F.col("_ok"), "automatic result rejected").when(F.col("_ok") & F.col("tstart").isNotNull(), "automatic result accepted"))
    changed = {c: F.when(F.col("_new"), F.col(f"_n_{c}")).otherwise(F.col(c)) for c in fresh}
    empty = F.when(F.col("_new") & F.col("_n_t90").isNull(), "no significant counts in burst region")
    before = F.when(F.col("_new"), empty).otherwise(F.nullif("note", F.lit(""))) if "note" in result.columns else empty
    changed |= {"tstart": F.when(F.col("_new"), start).otherwise(F.col("tstart")), "tstop": F.when(F.col("_new"), stop).otherwise(F.col("tstop")),
                "method": F.when(F.col("_new"), "user_adjusted").otherwise(F.col("method")), "note": F.concat_ws("; ", before, said)}
    return out.withColumns(changed).select(*result.columns, *[c for c in ("note",) if c not in result.columns])


def detector_analysis(lc: DataFrame, keys: Sequence[str] = KEYS, overrides: DataFrame | None = None) -> DataFrame:
    """Intervals, consensus, background and durations; one row per series with a status."""
    keys = list(keys)
    lc = keep(lc)
    found = consensus_interval([snr_interval(lc, keys), block_interval(lc, keys), cumulative_interval(lc, keys)], keys)
    if overrides is not None:
        found = apply_overrides(found, overrides, keys)
    found = keep(found)
    bg = keep(polynomial_background(lc, found, keys))
    dur = net_durations(lc, found, bg, keys)
    out = attach(attach(attach(lc.select(*keys).distinct(), found, keys, "left"), bg, keys, "left"), dur, keys, "left")
    return out.withColumns({
        "status": F.when(F.col("tstart").isNull(), "failed").otherwise("completed"),
        "note": F.when(F.col("tstart").isNull(), "no burst interval found")
        .when(F.col("t90").isNull(), "no significant counts in burst region").otherwise("")})
