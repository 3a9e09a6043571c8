"""Sample statistics, correlation fits, histograms and cross-matching."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from burstframe.functions.geometry import separation
from burstframe.operators.series import attach, median_by_position, with_position


def finite(c: Column) -> Column:
    return c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf"))


def log_pairs(df: DataFrame, x: str, y: str, x_err: str | None = None, y_err: str | None = None, err_frac: float = 0.1) -> DataFrame:
    """lx, ly and their errors for positive finite pairs; a missing error is a tenth of the value."""
    vx, vy = F.col(x), F.col(y)
    ex = F.coalesce(F.col(x_err), vx * err_frac) if x_err else vx * err_frac
    ey = F.coalesce(F.col(y_err), vy * err_frac) if y_err else vy * err_frac
    ln10 = F.lit(math.log(10.0))
    return df.filter(finite(vx) & finite(vy) & (vx > 0) & (vy > 0)).select(
        "*", F.log10(vx).alias("lx"), F.log10(vy).alias("ly"), (ex / (vx * ln10)).alias("sx"), (ey / (vy * ln10)).alias("sy"))


def line_quality(pairs: DataFrame, line: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Scatter, R^2, 2-sigma outliers and size for a line (slope, intercept) over (lx, ly)."""
    rows = attach(pairs, line, keys)
    res = F.col("ly") - (F.col("slope") * F.col("lx") + F.col("intercept"))
    rows = rows.withColumn("_res", res)
    q = rows.groupBy(*keys, "slope", "intercept").agg(
        F.stddev_pop("_res").alias("scatter"), F.sum(F.col("_res") * F.col("_res")).alias("_ss"),
        F.var_pop("ly").alias("_v"), F.count(F.lit(1)).alias("n_points")).filter("n_points >= 3")
    q = q.withColumn("r_squared", F.when(F.col("_v") > 0, 1 - F.col("_ss") / (F.col("_v") * F.col("n_points"))).otherwise(F.lit(0.0)))
    sc = q.select(*keys, "scatter")
    marked = attach(rows, sc, keys)
    out = marked.groupBy(*keys).agg(
        F.sum(F.when((F.col("scatter") > 0) & (F.abs("_res") > 2 * F.col("scatter")), 1).otherwise(0)).alias("n_outliers"))
    both = attach(q, out, keys)
    return both.select(*keys, "slope", "intercept", "scatter", "r_squared", "n_outliers", "n_points")


def least_squares(pairs: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    return pairs.groupBy(*keys).agg(F.regr_slope("ly", "lx").alias("slope"), F.regr_intercept("ly", "lx").alias("intercept"))


def orthogonal_unweighted(pairs: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Closed form from variances and covariance; a sample without covariance keeps the flat line."""
    m = pairs.groupBy(*keys).agg(
        F.var_pop("lx").alias("_vx"), F.var_pop("ly").alias("_vy"), F.covar_pop("lx", "ly").alias("_c"),
        F.avg("lx").alias("_mx"), F.avg("ly").alias("_my"))
    d = F.col("_vy") - F.col("_vx")
    slope = F.when(F.col("_c") != 0, (d + F.sqrt(d * d + 4 * F.col("_c") * F.col("_c"))) / (2 * F.col("_c"))).otherwise(F.lit(0.0))
    return m.select(*keys, slope.alias("slope"), (F.col("_my") - slope * F.col("_mx")).alias("intercept"))


def orthogonal_weighted(pairs: DataFrame, keys: Sequence[str] = (), limit: int = 500, tol: float = 1e-10) -> DataFrame:
    """Line with errors in both coordinates (York's equations), one aggregate pass per round.

    Only the slope and the weighted means (one row per key) move between rounds; rounds
    end when no slope changes by more than ``tol``; ``converged`` says whether it did within ``limit`` rounds.
    """
    from burstframe.operators.reuse import keep

    wx, wy = 1 / (F.col("sx") * F.col("sx")), 1 / (F.col("sy") * F.col("sy"))
    line = keep(least_squares(pairs, keys).withColumn("done", F.lit(False)))
    for _ in range(limit):
        rows = attach(pairs, line, keys)
        b = F.col("slope")
        rows = rows.withColumn("_w", wx * wy / (wx + b * b * wy))
        mean = rows.groupBy(*keys).agg(
            (F.sum(F.col("_w") * F.col("lx")) / F.sum("_w")).alias("_mx"), (F.sum(F.col("_w") * F.col("ly")) / F.sum("_w")).alias("_my"))
        rows = attach(rows, mean, keys)
        u, v = F.col("lx") - F.col("_mx"), F.col("ly") - F.col("_my")
        beta = F.col("_w") * (u / wy + b * v / wx)
        nxt = rows.withColumn("_be", beta).groupBy(*keys).agg(
            (F.sum(F.col("_w") * F.col("_be") * v) / F.sum(F.col("_w") * F.col("_be") * u)).alias("_b2"),
            F.first("_mx").alias("_mx"), F.first("_my").alias("_my"), F.first("slope").alias("_old"))
        line = keep(nxt.select(*keys, F.col("_b2").alias("slope"), (F.col("_my") - F.col("_b2") * F.col("_mx")).alias("intercept"),
                               (F.abs(F.col("_b2") - F.col("_old")) < tol).alias("done")))
        if line.filter("NOT done").limit(1).count() == 0:
            break
    return line.withColumnRenamed("done", "converged")


def sample_fit(df: DataFrame, x: str, y: str, method: str = "odr", keys: Sequence[str] = (), x_err=None, y_err=None) -> DataFrame:
    """Log-log line through a sample: 'odr' (errors on both), 'odr_plain' or 'ols'."""
    pairs = log_pairs(df, x, y, x_err, y_err)
    fit = {"odr": orthogonal_weighted, "odr_plain": orthogonal_unweighted, "ols": least_squares}[method]
    return line_quality(pairs, fit(pairs, keys), keys)


def band_lines(df: DataFrame, x: str, y: str, highlight: Column | None = None) -> DataFrame:
    """OLS line with +-2 sigma at both ends of the sample; distance of a highlighted burst in sigma."""
    pairs = log_pairs(df, x, y)
    if highlight is not None:
        pairs = pairs.withColumn("_hl", highlight)
    q = line_quality(pairs, least_squares(pairs))
    ends = pairs.agg(F.min("lx").alias("x_lo"), F.max("lx").alias("x_hi"),
                     *([F.max_by(F.struct("lx", "ly"), F.col("_hl").cast("int")).alias("_h"), F.max(F.col("_hl").cast("int")).alias("_any")]
                       if highlight is not None else []))
    out = attach(q, ends, ())
    line = lambda xx: F.col("slope") * xx + F.col("intercept")
    cols = ["slope", "intercept", "scatter", "n_points", "x_lo", "x_hi", line(F.col("x_lo")).alias("y_lo"), line(F.col("x_hi")).alias("y_hi"),
            (line(F.col("x_lo")) - 2 * F.col("scatter")).alias("y_lo_minus"), (line(F.col("x_hi")) + 2 * F.col("scatter")).alias("y_hi_plus")]
    if highlight is not None:
        cols.append(F.when(F.col("_any") == 1, (F.col("_h.ly") - line(F.col("_h.lx"))) / F.col("scatter")).alias("highlight_sigma"))
    return out.select(*cols)


def histogram(df: DataFrame, value: Column, bins: int, keys: Sequence[str] = ()) -> DataFrame:
    """Equal-width bins from min to max, last one closed; empty bins included.  NULLs are ignored."""
    rows = df.select(*keys, value.alias("_v")).filter(finite(F.col("_v")))
    lim = rows.groupBy(*keys).agg(F.min("_v").alias("_a"), F.max("_v").alias("_z"), F.count(F.lit(1)).alias("n_total"))
    # a sample of one value gets half a unit on either side
    lim = lim.select(*keys, F.when(F.col("_a") == F.col("_z"), F.col("_a") - 0.5).otherwise(F.col("_a")).alias("_a"),
                     F.when(F.col("_a") == F.col("_z"), F.col("_z") + 0.5).otherwise(F.col("_z")).alias("_z"), "n_total").filter("n_total > 0")
    lim = lim.withColumn("_w", (F.col("_z") - F.col("_a")) / bins)
    placed = attach(rows, lim, keys)
    b = F.least(F.floor((F.col("_v") - F.col("_a")) / F.col("_w")), F.lit(bins - 1)).cast("long")
    counts = placed.groupBy(*keys, b.alias("bin")).agg(F.count(F.lit(1)).alias("_c"))
    grid = lim.withColumn("bin", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(bins - 1).cast("long"))))
    return grid.join(counts, [*keys, "bin"], "left").select(
        *keys, "bin", (F.col("_a") + F.col("bin") * F.col("_w")).alias("lo"), (F.col("_a") + (F.col("bin") + 1) * F.col("_w")).alias("hi"),
        F.coalesce("_c", F.lit(0)).alias("count"), "n_total")


def median_and_mean(df: DataFrame, value: Column) -> DataFrame:
    """Median, mean and size of the finite values."""
    v = df.select(value.alias("v")).filter(finite(F.col("v")))
    return attach(median_by_position(v, [], "v", "median"), v.agg(F.avg("v").alias("mean"), F.count(F.lit(1)).alias("n")), ())


def kernel_density(df: DataFrame, value: Column, points: int = 200, bins_for_scale: int = 50) -> DataFrame:
    """Gaussian density (Scott width, sample deviation) on a grid, scaled to counts per histogram bin.

    The grid is exploded inside the scan and summed map-side: 200 partial sums leave each task.
    """
    rows = df.select(value.alias("_v")).filter(finite(F.col("_v")))
    st = rows.agg(F.min("_v").alias("_a"), F.max("_v").alias("_z"), F.stddev("_v").alias("_s"), F.count(F.lit(1)).alias("_n")).filter("_n > 1 AND _s > 0")
    h = F.col("_s") * F.pow(F.col("_n").cast("double"), F.lit(-0.2))
    g = attach(rows, st, ()).withColumn("step", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(points - 1).cast("long"))))
    x = F.col("_a") + F.col("step") * (F.col("_z") - F.col("_a")) / (points - 1)
    d = (x - F.col("_v")) / h
    k = F.exp(-(d * d) / 2) / (h * math.sqrt(2 * math.pi))
    return g.groupBy("step", x.alias("x"), "_n", "_a", "_z").agg(F.sum(k).alias("_k")).select(
        "step", "x", (F.col("_k") / F.col("_n")).alias("density"),
        (F.col("_k") * (F.col("_z") - F.col("_a")) / bins_for_scale).alias("scaled"))


def class_shares(df: DataFrame, column: str) -> DataFrame:
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("count"))
    total = counts.agg(F.sum("count").alias("_t"))
    return attach(counts, total, ()).select(column, "count", (F.col("count") * 100.0 / F.col("_t")).alias("percent"))


def mission_timeline(df: DataFrame, mission: str, year: Column) -> DataFrame:
    return df.groupBy(mission).agg(
        F.coalesce(F.min(year), F.lit(2000)).alias("start_year"), F.coalesce(F.max(year), F.lit(2025)).alias("end_year"),
        F.count(F.lit(1)).alias("count"))


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pairwise-complete Pearson correlation of every column pair, in one scan and one aggregate."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[:i]]
    aggs = []
    for a, b in pairs:
        ok = finite(F.col(a)) & finite(F.col(b))
        aggs += [F.corr(F.when(ok, F.col(a)), F.when(ok, F.col(b))).alias(f"r_{a}_{b}"), F.sum(ok.cast("long")).alias(f"n_{a}_{b}")]
    wide = df.agg(*aggs)
    rows = [F.struct(F.lit(a).alias("y"), F.lit(b).alias("x"), F.col(f"r_{a}_{b}").alias("r"), F.col(f"n_{a}_{b}").alias("n")) for a, b in pairs]
    return wide.select(F.inline(F.array(*rows)))


def unpivot(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    return df.select(key, F.inline(F.array(*[F.struct(F.lit(c).alias("property"), F.col(c).cast("double").alias("value")) for c in columns])))


def population_position(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Percent rank and z-score of every burst per property.

    Ranks come from distributed row numbers (value cells), never from a window over the whole sample.
    """
    from burstframe.operators.reuse import keep

    long = keep(unpivot(df, key, columns).filter(finite(F.col("value"))))
    ranked = with_position(long, ["property"], ["value", key], "_pos", "_n")
    first = ranked.groupBy("property", "value").agg(F.min("_pos").alias("_lowest"))
    st = long.groupBy("property").agg(F.avg("value").alias("_m"), F.stddev_pop("value").alias("_s"))
    out = attach(ranked.join(first, ["property", "value"]), st, ["property"])
    return out.select(
        key, "property", "value",
        F.when(F.col("_n") > 1, F.col("_lowest") / (F.col("_n") - 1)).otherwise(F.lit(0.0)).alias("percent_rank"),
        F.when(F.col("_s") > 0, (F.col("value") - F.col("_m")) / F.col("_s")).otherwise(F.lit(0.0)).alias("z_score"))


def range_anomalies(df: DataFrame, key: str, ranges: Sequence[tuple[str, float, float]]) -> DataFrame:
    """Values outside their typical range, with the distance in range widths."""
    present = [r for r in ranges if r[0] in df.columns]
    rows = F.array(*[F.struct(F.lit(n).alias("property"), F.col(n).cast("double").alias("value"), F.lit(lo).alias("expected_lo"),
                              F.lit(hi).alias("expected_hi")) for n, lo, hi in present])
    long = df.select(key, F.inline(rows))
    over = F.greatest(F.col("expected_lo") - F.col("value"), F.col("value") - F.col("expected_hi"))
    return long.filter(F.col("value").isNotNull() & ~F.col("value").between(F.col("expected_lo"), F.col("expected_hi"))).withColumn(
        "significance", over / (F.col("expected_hi") - F.col("expected_lo")))


def cross_match(
    bursts: DataFrame, alerts: DataFrame, window: float, radius: float | None = None,
    key: str = "burst_id", time: str = "t", alert_key: str = "alert_id",
) -> DataFrame:
    """Alerts within ``window`` of a burst (and ``radius`` degrees); unmatched bursts stay with NULLs.

    Time cells one window wide plus, when a radius is given, declination strips one radius high: only alerts in
    neighbouring cells meet a burst, so a crowded time span is further split over the sky.  Both sides are shuffled by cell: the size
    of the burst table says nothing of its nine copies, which would be broadcast.
    """
    cell = lambda c: F.floor(F.col(c) / F.lit(window)).cast("long")
    near = F.explode(F.array(*[cell(time) + k for k in (-1, 0, 1)]))
    b = bursts.select(key, F.col(time).alias("_bt"), *([F.col("ra").alias("_bra"), F.col("dec").alias("_bdec")] if radius else []), near.alias("_c"))
    a = alerts.select(F.col(alert_key).alias("alert_id"), F.col(time).alias("_at"),
                      *([F.col("ra").alias("_ara"), F.col("dec").alias("_adec")] if radius else []), cell(time).alias("_c"))
    on = ["_c"]
    if radius:
        strip = lambda c: F.floor(F.col(c) / F.lit(float(radius))).cast("long")
        b = b.withColumn("_d", F.explode(F.array(*[strip("_bdec") + k for k in (-1, 0, 1)])))
        a = a.withColumn("_d", strip("_adec"))
        on.append("_d")
    hit = a.join(b.hint("merge"), on).filter(F.abs(F.col("_at") - F.col("_bt")) <= window)
    cols = [key, "alert_id", (F.col("_at") - F.col("_bt")).alias("dt")]
    if radius:
        sep = separation(F.col("_bra"), F.col("_bdec"), F.col("_ara"), F.col("_adec"))
        hit = hit.withColumn("separation", sep).filter(F.col("separation") <= radius)
        cols.append("separation")
    return bursts.select(key).join(hit.select(*cols), key, "left")
