"""Queries over burst intervals, background, durations and blocks."""

from __future__ import annotations

from pyspark.sql import functions as F

from burstframe.operators import blocks as B
from burstframe.operators import intervals as I
from burstframe.operators.series import attach
from burstframe.plans.registry import query, r6
from burstframe.sources import views as V

K = ["burst_id", "band"]

SNR_CTES = """
pre AS (SELECT burst_id, band, avg(rate) AS m, stddev_pop(rate) AS s FROM lightcurves_dense WHERE t < -10 GROUP BY 1, 2
        HAVING count(*) >= 10 AND stddev_pop(rate) > 0),
z AS (SELECT l.*, (rate - m) / s AS snr FROM lightcurves_dense l JOIN pre USING (burst_id, band)),
snr AS (SELECT burst_id, band, min(t) FILTER (WHERE snr > 1.5) AS tstart, max(t) FILTER (WHERE snr > 1.5) AS tstop, max(snr) AS snr
        FROM z GROUP BY 1, 2)"""


@query("interval_by_snr", "lightcurves_dense", f"""WITH {SNR_CTES}
SELECT burst_id, tstart, tstop, round(snr, 5) AS snr, round(least(snr / 10, 1), 6) AS confidence FROM snr WHERE tstart IS NOT NULL""")
def _(spark, d):
    return I.snr_interval(V.lightcurves_dense(spark, d), K, 1.5).select(
        "burst_id", "tstart", "tstop", r6("snr", 5).alias("snr"), r6("confidence").alias("confidence"))


CUM_CTES = """
cm AS (SELECT burst_id, band, bin_idx, t, sum(counts) OVER (PARTITION BY burst_id, band ORDER BY bin_idx)::DOUBLE AS c FROM lightcurves_dense),
ln AS (SELECT burst_id, band, regr_slope(c, t) AS sl, regr_intercept(c, t) AS ic FROM cm WHERE t < -10 GROUP BY 1, 2 HAVING count(*) >= 10),
dv AS (SELECT cm.*, c - (sl * t + ic) AS dev FROM cm JOIN ln USING (burst_id, band)),
sd AS (SELECT burst_id, band, stddev_pop(dev) AS sd FROM dv WHERE t < -10 GROUP BY 1, 2 HAVING stddev_pop(dev) > 0),
nd AS (SELECT dv.*, dev / sd AS nd FROM dv JOIN sd USING (burst_id, band)),
fl AS (SELECT *, lead(dev) OVER (PARTITION BY burst_id, band ORDER BY t) - dev AS step FROM nd WHERE nd > 5),
sp AS (SELECT burst_id, band, stddev_pop(step) AS ss, min(t) AS tstart, max(t) AS last, count(*) AS nf FROM fl GROUP BY 1, 2),
ft AS (SELECT fl.burst_id, fl.band, min(t) AS flat FROM fl JOIN sp USING (burst_id, band) WHERE abs(step) < ss * 0.5 GROUP BY 1, 2),
pk AS (SELECT burst_id, band, max(nd) AS snr FROM nd GROUP BY 1, 2),
cum AS (SELECT sp.burst_id, sp.band, tstart, CASE WHEN nf > 10 THEN coalesce(flat, last) ELSE last END AS tstop, snr
        FROM sp LEFT JOIN ft USING (burst_id, band) JOIN pk USING (burst_id, band))"""


@query("interval_by_cumulative_counts", "lightcurves_dense",
       f"WITH {CUM_CTES} SELECT burst_id, tstart, tstop, round(snr, 5) AS snr FROM cum")
def _(spark, d):
    return I.cumulative_interval(V.lightcurves_dense(spark, d), K).select("burst_id", "tstart", "tstop", r6("snr", 5).alias("snr"))


@query("interval_by_blocks")
def _(spark, d):
    return I.block_interval(V.lightcurves_dense(spark, d), K)


CONS_CTES = f"""{SNR_CTES}, {CUM_CTES},
un AS (SELECT burst_id, band, tstart, tstop FROM snr WHERE tstart IS NOT NULL UNION ALL SELECT burst_id, band, tstart, tstop FROM cum),
cons AS (SELECT burst_id, band, median(tstart) AS tstart, median(tstop) AS tstop, count(*) / 3e0 AS confidence FROM un GROUP BY 1, 2)"""


def consensus(lc):
    return I.consensus_interval([I.snr_interval(lc, K, 1.5), I.cumulative_interval(lc, K)], K)


@query("interval_consensus", "lightcurves_dense",
       f"WITH {CONS_CTES} SELECT burst_id, tstart, tstop, round(confidence, 6) AS confidence FROM cons")
def _(spark, d):
    return consensus(V.lightcurves_dense(spark, d)).select("burst_id", "tstart", "tstop", r6("confidence").alias("confidence"))


def full_consensus(lc):
    """All three methods at their default thresholds."""
    return I.consensus_interval([I.snr_interval(lc, K), I.block_interval(lc, K), I.cumulative_interval(lc, K)], K)


@query("interval_consensus_three_methods")
def _(spark, d):
    return full_consensus(V.lightcurves_dense(spark, d))


@query("burst_duration_three_methods")
def _(spark, d):
    """Photons to light curves, consensus of the three interval methods, net-count T90 and class."""
    from burstframe.operators.classify import by_duration

    lc = V.lightcurves_dense(spark, d)
    out = I.net_durations(lc, full_consensus(lc), None, K)
    return out.withColumn("duration_class", by_duration(F.col("t90")))


def fixed_interval(lc):
    """The same interval for every series: -2 .. 4 s."""
    return lc.select(*K).distinct().select(*K, F.lit(-2.0).alias("tstart"), F.lit(4.0).alias("tstop"))


@query("polynomial_background")
def _(spark, d):
    lc = V.lightcurves_dense(spark, d)
    return I.polynomial_background(lc, fixed_interval(lc), K)


@query("polynomial_background_evaluation")
def _(spark, d):
    lc = V.lightcurves_dense(spark, d)
    bg = I.polynomial_background(lc, fixed_interval(lc), K)
    return attach(lc, bg, K).select("burst_id", "bin_idx", "t", "rate",
                                    I.evaluate_polynomial(F.col("coefficients"), F.col("t")).alias("background"))


@query("polynomial_evaluation", "lightcurves", """
SELECT burst_id, band, bin_idx, round(0.002::DOUBLE * t * t - 0.5::DOUBLE * t + 3, 6) AS value FROM lightcurves""")
def _(spark, d):
    coef = F.array(F.lit(0.002), F.lit(-0.5), F.lit(3.0))
    return V.lightcurves(spark, d).select(*K, "bin_idx", r6(I.evaluate_polynomial(coef, F.col("t"))).alias("value"))


def net_sql(source: str, cte: str) -> str:
    return f"""
WITH {cte}
rw AS (SELECT l.burst_id, l.band, l.bin_idx, l.t, l.counts, i.tstart, i.tstop FROM {source} l JOIN iv i USING (burst_id, band)),
fb AS (SELECT burst_id, band, avg(counts) AS f FROM rw WHERE t < tstart - 5 GROUP BY 1, 2),
rg AS (SELECT rw.*, greatest(counts - coalesce(f, 0), 0) AS net FROM rw LEFT JOIN fb USING (burst_id, band)
       WHERE t BETWEEN tstart - greatest(5, 0.3 * (tstop - tstart)) AND tstop + greatest(5, 0.3 * (tstop - tstart))),
cu AS (SELECT *, round(sum(net) OVER (PARTITION BY burst_id, band ORDER BY bin_idx) / nullif(sum(net) OVER (PARTITION BY burst_id, band), 0), 12) AS f FROM rg),
q AS (SELECT burst_id, band, min(t) FILTER (WHERE f >= 0.05) AS a, min(t) FILTER (WHERE f >= 0.95) AS b,
        min(t) FILTER (WHERE f >= 0.25) AS c, min(t) FILTER (WHERE f >= 0.75) AS d FROM cu GROUP BY 1, 2 HAVING sum(net) > 0)"""


IV_FIXED = "iv AS (SELECT DISTINCT burst_id, band, -2e0 AS tstart, 4e0 AS tstop FROM {src}),"


@query("net_count_durations", "lightcurves", net_sql("lightcurves", IV_FIXED.format(src="lightcurves")) + """
SELECT burst_id, band, b - a AS t90, a AS t90_start, d - c AS t50, c AS t50_start FROM q""")
def _(spark, d):
    lc = V.lightcurves(spark, d)
    return I.net_durations(lc, fixed_interval(lc), None, K)


@query("burst_duration_and_class", "lightcurves_dense", net_sql("lightcurves_dense", f"{CONS_CTES}, iv AS (SELECT * FROM cons),") + """
SELECT burst_id, round(b - a, 6) AS t90, round(d - c, 6) AS t50,
       CASE WHEN b - a < 2 THEN 'Short' WHEN b - a < 10000 THEN 'Long' ELSE 'Ultra-long' END AS duration_class FROM q""")
def _(spark, d):
    """Photons to light curves, consensus interval, net-count T90 and class."""
    from burstframe.operators.classify import by_duration

    lc = V.lightcurves_dense(spark, d)
    dur = I.net_durations(lc, consensus(lc), None, K)
    return dur.select("burst_id", r6("t90").alias("t90"), r6("t50").alias("t50"), by_duration(F.col("t90")).alias("duration_class"))


@query("interval_overrides", "lightcurves_dense", f"""WITH {CONS_CTES},
ov AS (SELECT DISTINCT burst_id, band, CASE WHEN length(burst_id) % 2 = 0 THEN -3e0 END AS s, CASE WHEN length(burst_id) % 2 = 0 THEN 3e0 END AS e,
         burst_id <> 'view' AS ok FROM lightcurves_dense)
SELECT burst_id, coalesce(s, tstart) AS tstart, coalesce(e, tstop) AS tstop,
       CASE WHEN s IS NOT NULL OR e IS NOT NULL THEN 'user_adjusted' ELSE 'combined' END AS method
FROM cons LEFT JOIN ov USING (burst_id, band) WHERE coalesce(ok, true)""")
def _(spark, d):
    lc = V.lightcurves_dense(spark, d)
    even = F.length("burst_id") % 2 == 0
    ov = lc.select(*K).distinct().select(*K, F.when(even, F.lit(-3.0)).alias("tstart"), F.when(even, F.lit(3.0)).alias("tstop"),
                                         (F.col("burst_id") != "view").alias("accept"))
    return I.apply_overrides(consensus(lc), ov, K).select("burst_id", "tstart", "tstop", "method")


def reviews(lc):
    """A new interval, a new start, a rejection or nothing, by the length of the series' name."""
    n = F.length("burst_id") % 4
    return lc.select(*K).distinct().select(*K, F.when(n < 2, F.lit(-3.0)).alias("tstart"), F.when(n == 0, F.lit(3.0)).alias("tstop"), (n != 2).alias("accept"))


@query("interval_review", "lightcurves_dense", net_sql("lightcurves_dense", f"""{CONS_CTES},
ov AS (SELECT burst_id, band, tstart AS t0, tstop AS t1, length(burst_id) % 4 AS n FROM cons),
iv AS (SELECT burst_id, band, CASE WHEN n < 2 THEN -3e0 ELSE t0 END AS tstart, CASE WHEN n = 0 THEN 3e0 ELSE t1 END AS tstop FROM ov),""") + """
SELECT burst_id, round(tstart, 6) AS tstart, round(tstop, 6) AS tstop, CASE WHEN n < 2 THEN 'user_adjusted' ELSE 'combined' END AS method,
       CASE WHEN n < 2 THEN 'adjusted' WHEN n = 2 THEN 'rejected' ELSE 'accepted' END AS decision,
       round(b - a, 6) AS t90, round(a, 6) AS t90_start, round(d - c, 6) AS t50, round(c, 6) AS t50_start
FROM ov JOIN iv USING (burst_id, band) LEFT JOIN q USING (burst_id, band)""")
def _(spark, d):
    """Reviewed intervals with durations computed again for the series that changed."""
    from burstframe.operators.reuse import keep

    lc = V.lightcurves_dense(spark, d)
    found = keep(consensus(lc))
    result = keep(attach(found, I.net_durations(lc, found, None, K), K, "left"))
    out = I.review_analysis(lc, result, reviews(lc), K, "flat")
    return out.select("burst_id", r6("tstart").alias("tstart"), r6("tstop").alias("tstop"), "method", F.regexp_extract("note", "(adjusted|rejected|accepted)", 1).alias("decision"),
                      *[r6(c).alias(c) for c in ("t90", "t90_start", "t50", "t50_start")])


@query("detector_review")
def _(spark, d):
    """The whole detector analysis, then a review of it with polynomial backgrounds."""
    from burstframe.operators.reuse import keep

    lc = V.lightcurves_dense(spark, d)
    return I.review_analysis(lc, keep(I.detector_analysis(lc, K)), reviews(lc), K)


@query("detector_analysis")
def _(spark, d):
    return I.detector_analysis(V.lightcurves_dense(spark, d), K)


@query("bayesian_blocks_measured")
def _(spark, d):
    return B.bayesian_blocks(V.lightcurves(spark, d), K)


@query("bayesian_blocks_greedy")
def _(spark, d):
    from burstframe.operators.reuse import keep

    lc = V.lightcurves(spark, d)
    return B.block_statistics(lc, keep(B.greedy_block_edges(lc, K)), K)


@query("bayesian_blocks_selected_bands")
def _(spark, d):
    return B.bayesian_blocks(V.lightcurves(spark, d), K, bands=["view", "click", "no such band"])
