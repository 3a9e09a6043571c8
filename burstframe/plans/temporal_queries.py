"""Queries over the temporal operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from burstframe.operators import temporal as T
from burstframe.plans.registry import query, r6
from burstframe.sources import views as V

K = ["burst_id", "band"]


def duration_sql(fraction: float, source: str = "lightcurves") -> str:
    lo, hi = (1 - fraction) / 2, 1 - (1 - fraction) / 2
    at = lambda p, side: (
        f"CASE WHEN l{side} IS NULL THEN first_t WHEN r{side} IS NULL THEN l{side}.t ELSE "
        f"(r{side}.t - l{side}.t) / (r{side}.f - l{side}.f) * ({p!r}::DOUBLE - l{side}.f) + l{side}.t END")
    return f"""
WITH c AS (SELECT burst_id, band, bin_idx, t,
             sum(rate * binsize) OVER (PARTITION BY burst_id, band ORDER BY bin_idx) AS cum,
             sum(rate * binsize) OVER (PARTITION BY burst_id, band) AS total FROM {source}),
f AS (SELECT *, cum / total AS f FROM c WHERE total <> 0),
g AS (SELECT burst_id, band, max(total) AS total, arg_min(t, bin_idx) AS first_t,
        arg_max({{'f': f, 't': t}}, bin_idx) FILTER (WHERE f <= {lo!r}::DOUBLE) AS l0,
        arg_min({{'f': f, 't': t}}, bin_idx) FILTER (WHERE f > {lo!r}::DOUBLE) AS r0,
        arg_max({{'f': f, 't': t}}, bin_idx) FILTER (WHERE f <= {hi!r}::DOUBLE) AS l1,
        arg_min({{'f': f, 't': t}}, bin_idx) FILTER (WHERE f > {hi!r}::DOUBLE) AS r1
      FROM f GROUP BY 1, 2),
z AS (SELECT burst_id, band, total, {at(lo, 0)} AS a, {at(hi, 1)} AS b FROM g)
SELECT burst_id, band, round(a, 6) AS t_start, round(b, 6) AS t_end, round(b - a, 6) AS duration,
       round((b - a) * sqrt(2e0 / total), 6) AS duration_err FROM z"""


def duration_frame(lc, fraction):
    return T.duration(lc, fraction).select(
        *K, *[r6(c).alias(c) for c in ("t_start", "t_end", "duration", "duration_err")])


@query("duration_t90", "lightcurves", duration_sql(0.9))
def _(spark, d):
    return duration_frame(V.lightcurves(spark, d), 0.9)


@query("duration_t50", "lightcurves", duration_sql(0.5))
def _(spark, d):
    return duration_frame(V.lightcurves(spark, d), 0.5)


@query("duration_t90_dense", "lightcurves_dense", duration_sql(0.9, "lightcurves_dense"))
def _(spark, d):
    return duration_frame(V.lightcurves_dense(spark, d), 0.9)


@query("t90_bootstrap_error")
def _(spark, d):
    return T.t90_bootstrap_error(V.lightcurves_dense(spark, d))


@query("t90_bootstrap_draw_order", "lightcurves_dense", """
WITH n AS (SELECT burst_id, band, count(*) AS n FROM lightcurves_dense GROUP BY 1, 2),
d AS (SELECT burst_id, band, i AS sim, bin_idx AS o,
        floor(('0x' || substr(md5(concat_ws('|', 1, burst_id, band, i, bin_idx)), 1, 13))::BIGINT::DOUBLE / 4503599627370496e0 * n)::BIGINT AS bin_idx
      FROM lightcurves_dense JOIN n USING (burst_id, band), range(100) r(i)),
c AS (SELECT burst_id, band, sim, o, t, sum(rate * binsize) OVER w AS c, sum(rate * binsize) OVER (PARTITION BY burst_id, band, sim) AS tot
      FROM d JOIN lightcurves_dense USING (burst_id, band, bin_idx) WINDOW w AS (PARTITION BY burst_id, band, sim ORDER BY o)),
f AS (SELECT *, c / tot AS f FROM c WHERE tot > 0),
p AS (SELECT * FROM (VALUES (0, (1 - 0.9e0) / 2), (1, 1 - (1 - 0.9e0) / 2)) v(k, p)),
b AS (SELECT burst_id, band, sim, k, p, arg_min(t, o) AS t0, arg_max(t, o) FILTER (WHERE f <= p) AS lt, arg_max(f, o) FILTER (WHERE f <= p) AS lf,
        arg_min(t, o) FILTER (WHERE f > p) AS rt, arg_min(f, o) FILTER (WHERE f > p) AS rf FROM f, p GROUP BY ALL),
x AS (SELECT burst_id, band, sim, k, CASE WHEN lf IS NULL THEN t0 WHEN rf IS NULL THEN lt ELSE (rt - lt) / (rf - lf) * (p - lf) + lt END AS t FROM b),
e AS (SELECT burst_id, band, stddev_pop(y) AS err, count(*) AS k FROM (SELECT burst_id, band, sim, max(t) FILTER (WHERE k = 1) - max(t) FILTER (WHERE k = 0) AS y
      FROM x GROUP BY 1, 2, 3) GROUP BY 1, 2)
SELECT burst_id, band, round(coalesce(err, 0), 6) AS t90_err, coalesce(k, 0) AS n_valid FROM n LEFT JOIN e USING (burst_id, band)""")
def _(spark, d):
    """Resampled durations with counts cumulated in the order of the draws."""
    out = T.t90_bootstrap_draw_order(V.lightcurves_dense(spark, d))
    return out.select("burst_id", "band", r6("t90_err").alias("t90_err"), "n_valid")


@query("peak_flux_at_resolution", "lightcurves", """
WITH rb AS (SELECT burst_id, band, i, avg(t) AS t, avg(rate) AS rate FROM
              (SELECT *, bin_idx // 2 AS i FROM lightcurves) GROUP BY 1, 2, 3 HAVING count(*) = 2)
SELECT burst_id, band, t AS peak_time, rate AS peak_rate FROM
  (SELECT *, row_number() OVER (PARTITION BY burst_id, band ORDER BY rate DESC, t) AS rn FROM rb) WHERE rn = 1""")
def _(spark, d):
    return T.peak_flux(V.lightcurves(spark, d), 2.0).select(*K, "peak_time", "peak_rate")


@query("variability", "lightcurves", """
SELECT burst_id, band,
       round(CASE WHEN max(rate) + min(rate) = 0 THEN 0 ELSE
             greatest(0, least(1, (max(rate) - min(rate)) / (max(rate) + min(rate)))) END, 6) AS variability_index,
       round(CASE WHEN var_pop(rate) - avg(rate_err * rate_err) > 1e-12 AND avg(rate) <> 0
             THEN sqrt(greatest(var_pop(rate) - avg(rate_err * rate_err), 0)) / avg(rate) ELSE 0 END, 5) AS fractional_rms
FROM lightcurves GROUP BY 1, 2""")
def _(spark, d):
    out = T.variability(V.lightcurves(spark, d))
    return out.select(*K, r6("variability_index").alias("variability_index"),
                      r6("fractional_rms", 5).alias("fractional_rms"))


ACF_SQL = """
WITH m AS (SELECT burst_id, band, bin_idx AS i, rate - avg(rate) OVER w AS x, count(*) OVER w AS n, binsize
           FROM lightcurves_dense WINDOW w AS (PARTITION BY burst_id, band)),
p AS (SELECT a.burst_id, a.band, b.i - a.i AS lag, sum(a.x * b.x) AS s, max(a.binsize) AS bs
      FROM m a JOIN m b ON a.burst_id = b.burst_id AND a.band = b.band AND b.i - a.i BETWEEN 0 AND a.n // 4 - 1
      GROUP BY 1, 2, 3)
SELECT p.burst_id, p.lag, p.lag * p.bs AS lag_time, round(p.s / z.s, 6) AS acf
FROM p JOIN p z ON p.burst_id = z.burst_id AND p.band = z.band AND z.lag = 0"""


@query("autocorrelation", "lightcurves_dense", ACF_SQL)
def _(spark, d):
    return T.autocorrelation(V.lightcurves_dense(spark, d)).select("burst_id", "lag", "lag_time", r6("acf").alias("acf"))


@query("minimum_variability_timescale", "lightcurves_dense",
       f"""WITH a AS ({ACF_SQL}) SELECT burst_id,
       coalesce(min(lag_time) FILTER (WHERE acf < 0.5), max(lag_time)) AS min_timescale FROM a GROUP BY 1""")
def _(spark, d):
    return T.minimum_variability_timescale(T.autocorrelation(V.lightcurves_dense(spark, d)), ["burst_id"])


PULSE_SQL = """
WITH c AS (SELECT *, CASE WHEN lag(rate) OVER w IS DISTINCT FROM rate THEN 1 ELSE 0 END AS n
           FROM {src} WINDOW w AS (PARTITION BY burst_id, band ORDER BY bin_idx)),
r AS (SELECT *, sum(n) OVER (PARTITION BY burst_id, band ORDER BY bin_idx) AS run FROM c),
g AS (SELECT burst_id, band, run, min(bin_idx) AS a, max(bin_idx) AS z, any_value(rate) AS rate FROM r GROUP BY 1, 2, 3),
h AS (SELECT *, lag(rate) OVER w AS pr, lead(rate) OVER w AS nr FROM g
      WINDOW w AS (PARTITION BY burst_id, band ORDER BY run)),
m AS (SELECT burst_id, band, avg(rate) AS mean, max(bin_idx) AS last FROM {src} GROUP BY 1, 2),
pk AS (SELECT h.burst_id, h.band, (a + z) // 2 AS p, rate, last FROM h JOIN m USING (burst_id, band)
       WHERE rate > pr AND rate > nr AND rate >= mean),
b AS (SELECT pk.burst_id, pk.band, pk.p, pk.rate, pk.last,
             max(l.bin_idx) FILTER (WHERE l.bin_idx < pk.p) + 1 AS lo, min(l.bin_idx) FILTER (WHERE l.bin_idx > pk.p) - 1 AS hi
      FROM pk JOIN {src} l ON pk.burst_id = l.burst_id AND pk.band = l.band AND l.rate >= pk.rate / 2
      GROUP BY 1, 2, 3, 4, 5)
SELECT b.burst_id, b.band, x.t AS peak_time, b.rate AS peak_rate, s.t AS start_time, e.t AS end_time, e.t - s.t AS width
FROM b JOIN {src} x ON x.burst_id = b.burst_id AND x.band = b.band AND x.bin_idx = b.p
JOIN {src} s ON s.burst_id = b.burst_id AND s.band = b.band AND s.bin_idx = coalesce(b.lo, 0)
JOIN {src} e ON e.burst_id = b.burst_id AND e.band = b.band AND e.bin_idx = coalesce(b.hi, b.last)"""


@query("pulse_detection", "lightcurves", PULSE_SQL.format(src="lightcurves"))
def _(spark, d):
    return T.detect_pulses(V.lightcurves(spark, d)).select(*K, "peak_time", "peak_rate", "start_time", "end_time", "width")


HR_SQL = """
WITH s AS (SELECT burst_id, band, t, rate, rate_err, lead(t) OVER w AS t1, lead(rate) OVER w AS r1,
                  lead(rate_err) OVER w AS e1 FROM lightcurves WHERE band IN ('view', 'click')
           WINDOW w AS (PARTITION BY burst_id, band ORDER BY t)),
n AS (SELECT burst_id, count(*) FILTER (WHERE band = 'view') AS nh, count(*) FILTER (WHERE band = 'click') AS ns
      FROM s GROUP BY 1),
tg AS (SELECT s.burst_id, s.t, x.band FROM s JOIN n USING (burst_id), (VALUES ('view'), ('click')) x(band)
       WHERE nh > 0 AND ns > 0 AND s.band = CASE WHEN nh < ns THEN 'view' ELSE 'click' END),
v AS (SELECT g.burst_id, g.t, g.band,
        coalesce(CASE WHEN s.t = g.t THEN s.rate ELSE s.rate + (s.r1 - s.rate) * (g.t - s.t) / (s.t1 - s.t) END, 0) AS r,
        coalesce(CASE WHEN s.t = g.t THEN s.rate_err
                      ELSE s.rate_err + (s.e1 - s.rate_err) * (g.t - s.t) / (s.t1 - s.t) END, 0) AS e
      FROM tg g ASOF LEFT JOIN s ON g.burst_id = s.burst_id AND g.band = s.band AND s.t <= g.t),
w AS (SELECT burst_id, t, max(r) FILTER (WHERE band = 'view') AS h, max(r) FILTER (WHERE band = 'click') AS s,
        max(e) FILTER (WHERE band = 'view') AS eh, max(e) FILTER (WHERE band = 'click') AS es FROM v GROUP BY 1, 2)
SELECT burst_id, t, round(CASE WHEN h + s > 0 THEN (h - s) / (h + s) ELSE 0 END, 6) AS hr_norm,
       round(CASE WHEN h + s > 0 THEN sqrt((4 * s * s * eh * eh + 4 * h * h * es * es) / pow(h + s, 4)) ELSE 0 END, 6) AS hr_err,
       round(CASE WHEN s > 0 THEN h / s END, 6) AS hr_ratio FROM w"""


@query("hardness_ratio_evolution", "lightcurves", HR_SQL)
def _(spark, d):
    return T.hardness_ratio(V.lightcurves(spark, d), "view", "click").select(
        "burst_id", "t", r6("hr_norm").alias("hr_norm"), r6("hr_err").alias("hr_err"), r6("hr_ratio").alias("hr_ratio"))


SIMPLE_LAG_SQL = """
WITH p AS (SELECT * FROM lightcurves WHERE band IN ('view', 'click')),
e AS (SELECT burst_id, band, min(t) AS a, max(t) AS z FROM p GROUP BY 1, 2),
c AS (SELECT burst_id, max(a) AS a, min(z) AS z FROM e GROUP BY 1 HAVING count(*) = 2),
k AS (SELECT p.burst_id, p.band, p.rate, p.binsize, row_number() OVER (PARTITION BY p.burst_id, p.band ORDER BY t) - 1 AS i
      FROM p JOIN c ON p.burst_id = c.burst_id AND p.t BETWEEN c.a AND c.z),
zz AS (SELECT *, count(*) OVER w AS n, stddev_pop(rate) OVER w AS sd,
         (rate - avg(rate) OVER w) / nullif(stddev_pop(rate) OVER w, 0) AS x FROM k
       WINDOW w AS (PARTITION BY burst_id, band)),
sz AS (SELECT burst_id, max(n) FILTER (WHERE band = 'click') AS nl, max(n) FILTER (WHERE band = 'view') AS nh,
         max(binsize) FILTER (WHERE band = 'view') AS bs, min(sd) AS sd FROM zz GROUP BY 1),
xc AS (SELECT l.burst_id, h.i - l.i AS lag, sum(l.x * h.x) AS s FROM zz l JOIN zz h
       ON l.burst_id = h.burst_id AND l.band = 'click' AND h.band = 'view' GROUP BY 1, 2),
y AS (SELECT xc.burst_id, sz.bs, lag + nl // 2 - nh // 2 AS lag, round(s, 9) AS s FROM xc JOIN sz USING (burst_id)
      WHERE nl >= 2 AND nh >= 2 AND sd > 0 AND lag + nl // 2 >= 0 AND lag + nl // 2 < nh),
m AS (SELECT burst_id, max(s) AS mx FROM y GROUP BY 1),
o AS (SELECT y.burst_id, min(lag) FILTER (WHERE s = mx) * max(bs) AS lag,
        coalesce((max(lag) FILTER (WHERE s / mx > 0.5) - min(lag) FILTER (WHERE s / mx > 0.5)) * max(bs) / 2, max(bs)) AS lag_err
      FROM y JOIN m USING (burst_id) GROUP BY 1)
SELECT sz.burst_id, coalesce(lag, 0) AS lag, coalesce(lag_err, 0) AS lag_err FROM sz LEFT JOIN o USING (burst_id)"""


@query("spectral_lag_simple", "lightcurves", SIMPLE_LAG_SQL)
def _(spark, d):
    return T.simple_lag(V.lightcurves(spark, d), "click", "view")


LAG_PAIR_CTES = """
p AS (SELECT * FROM lightcurves WHERE band IN ('view', 'click') AND t BETWEEN -12 AND 14),
e AS (SELECT burst_id, band, min(t) AS a, max(t) AS z, min(binsize) AS b FROM p GROUP BY 1, 2),
gr AS (SELECT burst_id, max(a) AS t0, min(b) AS dt, greatest(ceil((min(z) + min(b) / 2 - max(a)) / min(b)), 0)::BIGINT AS n
       FROM e GROUP BY 1 HAVING count(*) = 2),
pt AS (SELECT burst_id, t0, dt, n, unnest(range(n)) AS pos FROM gr WHERE n >= 4),
tg AS (SELECT burst_id, n, dt, pos, t0 + pos * dt AS t, x.band FROM pt, (VALUES ('view'), ('click')) x(band)),
s AS (SELECT burst_id, band, t, rate, lead(t) OVER w AS t1, lead(rate) OVER w AS r1 FROM p
      WINDOW w AS (PARTITION BY burst_id, band ORDER BY t)),
v AS (SELECT g.burst_id, g.n, g.dt, g.pos, g.t, g.band,
        coalesce(CASE WHEN s.t = g.t THEN s.rate ELSE s.rate + (s.r1 - s.rate) * (g.t - s.t) / (s.t1 - s.t) END, 0) AS r
      FROM tg g ASOF LEFT JOIN s ON g.burst_id = s.burst_id AND g.band = s.band AND s.t <= g.t),
wd AS (SELECT burst_id, n, dt, pos, t, max(r) FILTER (WHERE band = 'click') AS low,
         max(r) FILTER (WHERE band = 'view') AS high FROM v GROUP BY 1, 2, 3, 4, 5),
pr AS (SELECT *, low - avg(low) OVER w AS x, high - avg(high) OVER w AS y FROM wd WINDOW w AS (PARTITION BY burst_id))"""


def lag_pair(spark, d):
    return T.prepare_lag_pair(V.lightcurves(spark, d), "click", "view", -12.0, 14.0)


@query("lag_pair_preparation", "lightcurves",
       f"WITH {LAG_PAIR_CTES} SELECT burst_id, pos, t, n, round(x, 6) + 0e0 AS x, round(y, 6) + 0e0 AS y FROM pr")
def _(spark, d):
    return lag_pair(spark, d).select("burst_id", "pos", "t", "n", (r6("x") + F.lit(0.0)).alias("x"),
                                     (r6("y") + F.lit(0.0)).alias("y"))


CCF_CTES = LAG_PAIR_CTES + """,
nm AS (SELECT burst_id, max(n) AS n, max(dt) AS dt, sqrt(sum(x * x) * sum(y * y)) AS norm FROM pr GROUP BY 1),
xc AS (SELECT a.burst_id, b.pos - a.pos AS lag, sum(a.x * b.y) AS s FROM pr a JOIN pr b ON a.burst_id = b.burst_id
       GROUP BY 1, 2),
gl AS (SELECT burst_id, n, dt, norm, unnest(range(-n, n + 1)) AS lag FROM nm),
ccf AS (SELECT gl.burst_id, gl.lag, gl.lag * gl.dt AS off,
          CASE WHEN norm = 0 THEN 0 ELSE coalesce(s / norm, 0) END AS c
        FROM gl LEFT JOIN xc ON gl.burst_id = xc.burst_id AND gl.lag = xc.lag)"""


@query("discrete_cross_correlation", "lightcurves",
       f"WITH {CCF_CTES} SELECT burst_id, lag, off AS \"offset\", round(c, 6) + 0e0 AS ccf FROM ccf")
def _(spark, d):
    return T.cross_correlation(lag_pair(spark, d)).select(
        "burst_id", "lag", "offset", (r6("ccf") + F.lit(0.0)).alias("ccf"))


@query("split_normal_model", "lightcurves", f"""WITH {CCF_CTES}
SELECT burst_id, lag, round(0.1::DOUBLE + 0.8::DOUBLE * exp(-pow((off - 1.5e0) / CASE WHEN off < 1.5e0 THEN 2e0 ELSE 4e0 END, 2)
       / 2), 6) AS model FROM ccf""")
def _(spark, d):
    ccf = T.cross_correlation(lag_pair(spark, d))
    lit = F.lit
    m = T.split_normal(F.col("offset"), lit(0.1), lit(0.8), lit(1.5), lit(2.0), lit(4.0))
    return ccf.select("burst_id", "lag", r6(m).alias("model"))


@query("cross_correlation_errors")
def _(spark, d):
    return T.cross_correlation_errors(lag_pair(spark, d))


@query("cumulative_counts", "lightcurves", """
SELECT burst_id, band, bin_idx, sum(rate) OVER (PARTITION BY burst_id, band ORDER BY bin_idx) AS cum_rate
FROM lightcurves""")
def _(spark, d):
    return T.cumulative_counts(V.lightcurves(spark, d)).select(*K, "bin_idx", "cum_rate")
