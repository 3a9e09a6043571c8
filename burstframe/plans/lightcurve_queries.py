"""Queries over the light-curve operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from burstframe.operators import lightcurve as L
from burstframe.plans.registry import query, r6
from burstframe.sources import views as V

LC = ["burst_id", "band", "bin_idx"]


@query("event_binning", "lightcurves",
       "SELECT burst_id, band, bin_idx, t, rate, round(rate_err, 6) AS rate_err, counts FROM lightcurves")
def _(spark, d):
    return V.lightcurves(spark, d).select(*LC, "t", "rate", r6("rate_err").alias("rate_err"), "counts")


@query("event_binning_quarter", "lightcurves_dense",
       "SELECT burst_id, bin_idx, t, rate, round(rate_err, 6) AS rate_err, counts FROM lightcurves_dense")
def _(spark, d):
    return V.lightcurves_dense(spark, d).select("burst_id", "bin_idx", "t", "rate", r6("rate_err").alias("rate_err"),
                                                "counts")


FIXED_SQL = """
WITH s AS (SELECT DISTINCT burst_id, band FROM photons WHERE t BETWEEN {lo} AND {hi}),
ix AS (SELECT burst_id, band, t, floor((t - {lo}) / {b})::BIGINT AS i0 FROM photons WHERE t BETWEEN {lo} AND {hi}),
c AS (SELECT burst_id, band, least(CASE WHEN t < {lo} + i0 * {b} THEN i0 - 1
             WHEN t >= {lo} + (i0 + 1) * {b} THEN i0 + 1 ELSE i0 END, {n} - 1) AS i, count(*) AS n
      FROM ix GROUP BY 1, 2, 3),
g AS (SELECT burst_id, band, unnest(range({n})) AS i FROM s)
SELECT g.burst_id, g.band, g.i AS bin_idx, round((({lo} + g.i * {b}) + ({lo} + (g.i + 1) * {b})) / 2, 9) AS t,
       round(coalesce(n, 0) / {b}, 6) AS rate, round(sqrt(coalesce(n, 0)::DOUBLE) / {b}, 6) AS rate_err,
       coalesce(n, 0)::BIGINT AS counts
FROM g LEFT JOIN c ON g.burst_id = c.burst_id AND g.band = c.band AND g.i = c.i"""


@query("event_binning_fixed_grid", "photons",
       FIXED_SQL.format(lo="-10e0", hi="10e0", b="0.64::DOUBLE", n=32))
def _(spark, d):
    lc = L.bin_events_fixed(V.photons(spark, d), bin_size=0.64, trange=(-10, 10))
    return lc.select(*LC, r6("t", 9).alias("t"), r6("rate").alias("rate"), r6("rate_err").alias("rate_err"), "counts")


@query("event_binning_instrument_defaults", "photons", """
WITH p AS (SELECT * FROM photons WHERE energy BETWEEN 15 AND 150),
s AS (SELECT burst_id, band, floor(min(t)) AS t0, ceil((ceil(max(t)) - floor(min(t))) / 0.064::DOUBLE)::BIGINT AS nb
      FROM p GROUP BY 1, 2),
ix AS (SELECT p.burst_id, p.band, p.t, s.t0, s.nb, floor((p.t - s.t0) / 0.064::DOUBLE)::BIGINT AS i0
       FROM p JOIN s ON p.burst_id = s.burst_id AND p.band = s.band),
c AS (SELECT burst_id, band, least(CASE WHEN t < t0 + i0 * 0.064::DOUBLE THEN i0 - 1
             WHEN t >= t0 + (i0 + 1) * 0.064::DOUBLE THEN i0 + 1 ELSE i0 END, nb - 1) AS i, count(*) AS n
      FROM ix GROUP BY 1, 2, 3),
g AS (SELECT burst_id, band, t0, unnest(range(nb)) AS i FROM s WHERE nb > 0),
lc AS (SELECT g.burst_id, g.band, g.i, coalesce(n, 0)::BIGINT AS counts FROM g
       LEFT JOIN c ON g.burst_id = c.burst_id AND g.band = c.band AND g.i = c.i)
SELECT burst_id, band, count(*) AS n_bins, sum(counts)::BIGINT AS counts, max(counts) AS peak_counts,
       sum(i * counts)::BIGINT AS moment FROM lc GROUP BY 1, 2""")
def _(spark, d):
    lc = L.bin_for_instrument(V.photons(spark, d))
    return lc.groupBy("burst_id", "band").agg(
        F.count(F.lit(1)).alias("n_bins"), F.sum("counts").alias("counts"), F.max("counts").alias("peak_counts"),
        F.sum(F.col("bin_idx") * F.col("counts")).alias("moment"))


def channel_rows(spark, d):
    """Pre-binned channel counts: one row per (series, whole second, energy channel)."""
    p = V.photons(spark, d)
    return (p.groupBy("burst_id", "band", F.floor("t").cast("double").alias("tstart"),
                      F.floor(F.col("energy") / 50).cast("long").alias("channel"))
            .agg(F.count(F.lit(1)).alias("counts")).withColumn("tend", F.col("tstart") + F.lit(1.0)))


V.DUCK_VIEWS["channels"] = (("photons",), """
    SELECT burst_id, band, floor(t) AS tstart, floor(t) + 1e0 AS tend, floor(energy / 50)::BIGINT AS channel,
           count(*) AS counts FROM photons GROUP BY 1, 2, 3, 4, 5""")


CHANNEL_SUM_SQL = """SELECT burst_id, band, t, counts, counts / dt AS rate,
       round(sqrt(counts) / dt, 6) AS rate_err, median(tend - tstart) OVER (PARTITION BY burst_id, band) AS binsize
FROM (SELECT burst_id, band, tstart, tend, (tstart + tend) / 2 AS t, sum(counts)::DOUBLE AS counts,
             CASE WHEN tend > tstart THEN tend - tstart ELSE 1e0 END AS dt
      FROM channels GROUP BY 1, 2, 3, 4)"""


@query("channel_sum", "channels", CHANNEL_SUM_SQL)
def _(spark, d):
    return L.sum_channels(channel_rows(spark, d)).select(
        "burst_id", "band", "t", "counts", "rate", r6("rate_err").alias("rate_err"), "binsize")


@query("light_curve_source_preference", "photons channels", """
WITH tte AS (SELECT DISTINCT burst_id, band FROM photons WHERE energy >= 150),
all_k AS (SELECT DISTINCT burst_id, band FROM channels)
SELECT a.burst_id, a.band, CASE WHEN t.band IS NOT NULL THEN 'tte' ELSE 'cspec' END AS data_type
FROM all_k a LEFT JOIN tte t ON a.burst_id = t.burst_id AND a.band = t.band""")
def _(spark, d):
    tte = L.bin_events_fixed(V.photons(spark, d).filter("energy >= 150"), bin_size=1.0, trange=(-20, 20))
    cspec = L.sum_channels(channel_rows(spark, d))
    return L.prefer_source(tte, cspec).select("burst_id", "band", "data_type").distinct()


@query("expression_filter", "photons",
       "SELECT burst_id, band, t, energy FROM photons WHERE energy > 100 AND band <> 'error' AND t > -5")
def _(spark, d):
    return L.select_rows(V.photons(spark, d), "energy > 100 AND band <> 'error' AND t > -5")


@query("rebin_consecutive", "lightcurves", """
SELECT burst_id, band, i AS bin_idx, round(avg(t), 6) AS t, round(avg(rate), 6) AS rate,
       round(sqrt(sum(rate_err * rate_err)) / 4, 6) AS rate_err
FROM (SELECT *, bin_idx // 4 AS i FROM lightcurves) GROUP BY 1, 2, 3 HAVING count(*) = 4""")
def _(spark, d):
    out = L.rebin(V.lightcurves(spark, d), 4.0)
    return out.select(*LC, r6("t").alias("t"), r6("rate").alias("rate"), r6("rate_err").alias("rate_err"))


@query("background_subtraction", "lightcurves", """
WITH bg AS (SELECT burst_id, band, avg(rate) AS bg, avg(rate_err * rate_err) AS e2 FROM lightcurves
            WHERE t BETWEEN -100 AND -10 GROUP BY 1, 2)
SELECT l.burst_id, l.band, l.bin_idx,
       round(CASE WHEN bg IS NULL THEN rate ELSE greatest(rate - bg, 0) END, 6) AS rate,
       round(CASE WHEN bg IS NULL THEN rate_err ELSE sqrt(rate_err * rate_err + e2) END, 6) AS rate_err
FROM lightcurves l LEFT JOIN bg ON l.burst_id = bg.burst_id AND l.band = bg.band""")
def _(spark, d):
    return L.background_subtract(V.lightcurves(spark, d)).select(
        *LC, r6("rate").alias("rate"), r6("rate_err").alias("rate_err"))


PEAK_SQL = """
SELECT burst_id, band, t AS peak_time, rate AS peak_rate, round(rate_err, 6) AS peak_err,
       round(CASE WHEN rate_err = 0 THEN NULL ELSE rate / rate_err END, 6) AS snr
FROM (SELECT *, row_number() OVER (PARTITION BY burst_id, band ORDER BY rate DESC, t) AS rn FROM lightcurves)
WHERE rn = 1"""


@query("peak_and_signal_to_noise", "lightcurves", PEAK_SQL)
def _(spark, d):
    p = L.find_peak(V.lightcurves(spark, d))
    return p.select("burst_id", "band", "peak_time", "peak_rate", r6("peak_err").alias("peak_err"),
                    r6(F.when(F.col("peak_err") > 0, F.col("snr"))).alias("snr"))


@query("fluence", "lightcurves", """
SELECT burst_id, band, round(sum(rate * binsize), 6) AS fluence,
       round(sqrt(sum(rate_err * rate_err * binsize * binsize)), 6) AS fluence_err,
       round(coalesce(sum(rate * binsize) FILTER (WHERE t BETWEEN -2 AND 5), 0), 6) AS window_fluence
FROM lightcurves GROUP BY 1, 2""")
def _(spark, d):
    lc = V.lightcurves(spark, d)
    whole = L.fluence(lc)
    part = L.fluence(lc, (-2, 5)).select("burst_id", "band", r6("fluence").alias("window_fluence"))
    return whole.join(part, ["burst_id", "band"]).select(
        "burst_id", "band", r6("fluence").alias("fluence"), r6("fluence_err").alias("fluence_err"), "window_fluence")


def _smooth_sql() -> str:
    """Window 5 (or 3 on short series) by least squares over neighbours, ends by the edge window."""
    def arm(w: int) -> str:
        h = w // 2
        rows = L.savgol_weights(w)
        parts = []
        for j in range(w):
            value = " + ".join(f"({rows[j][k]!r}::DOUBLE) * nth({k - j})" for k in range(w))
            for k in range(-4, 5):
                fn = "rate" if k == 0 else (f"lead(rate, {k}) OVER w" if k > 0 else f"lag(rate, {-k}) OVER w")
                value = value.replace(f"nth({k})", fn)
            if j < h:
                parts.append(f"WHEN bin_idx = {j} THEN {value}")
            elif j > h:
                parts.append(f"WHEN bin_idx = n - {w - j} THEN {value}")
            else:
                centre = value
        return "CASE " + " ".join(parts) + f" ELSE {centre} END"

    return f"""
WITH s AS (SELECT *, count(*) OVER (PARTITION BY burst_id, band) AS n FROM lightcurves),
z AS (SELECT *, CASE WHEN least(5, n // 2) % 2 = 0 THEN least(5, n // 2) + 1 ELSE least(5, n // 2) END AS win FROM s)
SELECT burst_id, band, bin_idx, round(CASE WHEN win = 5 THEN {arm(5)} WHEN win = 3 THEN {arm(3)} ELSE rate END, 6)
       + 0e0 AS rate_smooth
FROM z WINDOW w AS (PARTITION BY burst_id, band ORDER BY bin_idx)"""


@query("smooth_quadratic", "lightcurves", _smooth_sql())
def _(spark, d):
    out = L.smooth(V.lightcurves(spark, d), columns=("rate",))
    return out.select(*LC, (r6("rate_smooth") + F.lit(0.0)).alias("rate_smooth"))


@query("merge_bands_same_grid", "lightcurves", """
SELECT burst_id, t, round(sum(rate), 6) AS rate, round(sqrt(sum(rate_err * rate_err)), 6) AS rate_err,
       string_agg(DISTINCT band, ', ' ORDER BY band) AS bands
FROM lightcurves GROUP BY 1, 2""")
def _(spark, d):
    return L.merge_bands(V.lightcurves(spark, d), same_grid=True).select(
        "burst_id", "t", r6("rate").alias("rate"), r6("rate_err").alias("rate_err"), "bands")


REGRID_SQL = """
WITH src AS (SELECT burst_id, band, t, rate, lead(t) OVER w AS t1, lead(rate) OVER w AS r1 FROM lightcurves
             WINDOW w AS (PARTITION BY burst_id, band ORDER BY t)),
tgt AS (SELECT burst_id, band, bin_idx, t + 0.25 AS t FROM lightcurves)
SELECT g.burst_id, g.band, g.bin_idx, g.t,
       round(coalesce(CASE WHEN s.t = g.t THEN s.rate ELSE s.rate + (s.r1 - s.rate) * (g.t - s.t) / (s.t1 - s.t) END,
                      0), 6) AS rate
FROM tgt g ASOF LEFT JOIN src s ON g.burst_id = s.burst_id AND g.band = s.band AND s.t <= g.t"""


@query("regrid_linear", "lightcurves", REGRID_SQL)
def _(spark, d):
    lc = V.lightcurves(spark, d)
    target = lc.select("burst_id", "band", "bin_idx", (F.col("t") + F.lit(0.25)).alias("t"))
    out = L.regrid_linear(lc, target, ["burst_id", "band"], ["rate"])
    return out.select(*LC, "t", r6("rate").alias("rate"))


@query("merge_bands_regridded", "lightcurves", """
WITH src AS (SELECT burst_id, band, t, rate, rate_err, lead(t) OVER w AS t1, lead(rate) OVER w AS r1,
                    lead(rate_err) OVER w AS e1 FROM lightcurves
             WINDOW w AS (PARTITION BY burst_id, band ORDER BY t)),
f AS (SELECT burst_id, min(band) AS b0 FROM lightcurves GROUP BY 1),
tgt AS (SELECT l.burst_id, x.band, l.t FROM lightcurves l JOIN f ON l.burst_id = f.burst_id AND l.band = f.b0
        JOIN (SELECT DISTINCT burst_id, band FROM lightcurves) x ON x.burst_id = l.burst_id),
v AS (SELECT g.burst_id, g.t,
        coalesce(CASE WHEN s.t = g.t THEN s.rate ELSE s.rate + (s.r1 - s.rate) * (g.t - s.t) / (s.t1 - s.t) END, 0) r,
        coalesce(CASE WHEN s.t = g.t THEN s.rate_err
                      ELSE s.rate_err + (s.e1 - s.rate_err) * (g.t - s.t) / (s.t1 - s.t) END, 0) e
      FROM tgt g ASOF LEFT JOIN src s ON g.burst_id = s.burst_id AND g.band = s.band AND s.t <= g.t)
SELECT burst_id, t, round(sum(r), 6) AS rate, round(sqrt(sum(e * e)), 6) AS rate_err FROM v GROUP BY 1, 2""")
def _(spark, d):
    return L.merge_bands(V.lightcurves(spark, d)).select(
        "burst_id", "t", r6("rate").alias("rate"), r6("rate_err").alias("rate_err"))


@query("band_label", "photons", """
SELECT burst_id, CASE WHEN lo IS NULL OR hi IS NULL THEN ''
            ELSE round_even(lo, 0)::BIGINT || '-' || round_even(hi, 0)::BIGINT || ' keV' END AS label
FROM (SELECT burst_id, min(energy) AS lo, CASE WHEN count(*) > 50 THEN max(energy) END AS hi FROM photons GROUP BY 1)""")
def _(spark, d):
    lims = V.photons(spark, d).groupBy("burst_id").agg(
        F.min("energy").alias("lo"), F.when(F.count(F.lit(1)) > 50, F.max("energy")).alias("hi"))
    return lims.select("burst_id", L.band_label(F.col("lo"), F.col("hi")).alias("label"))
