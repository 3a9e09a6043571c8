"""Queries over samples, histograms, cross-matches and mixtures."""

from __future__ import annotations

from pyspark.sql import functions as F

from burstframe.operators import mixture as X
from burstframe.operators import population as P
from burstframe.plans.geometry_queries import s_sep
from burstframe.plans.registry import query, r6
from burstframe.schemas import TYPICAL_RANGES
from burstframe.sources import views as V

QUALITY_SQL = """
res AS (SELECT ly - (slope * lx + intercept) AS r, ly, slope, intercept FROM pr, ln),
qu AS (SELECT max(slope) AS slope, max(intercept) AS intercept, stddev_pop(r) AS sc, sum(r * r) AS ss, var_pop(ly) AS v, count(*) AS n FROM res)
SELECT round(qu.slope, 6) AS slope, round(qu.intercept, 5) AS intercept, round(sc, 6) AS scatter, round(1 - ss / (v * n), 6) AS r_squared,
       (SELECT count(*) FROM res, qu q WHERE abs(r) > 2 * q.sc) AS n_outliers, n AS n_points FROM qu"""


def fit_frame(df):
    return df.select(r6("slope").alias("slope"), r6("intercept", 5).alias("intercept"), r6("scatter").alias("scatter"),
                     r6("r_squared").alias("r_squared"), "n_outliers", "n_points")


@query("epeak_eiso_sample_fit")
def _(spark, d):
    return P.sample_fit(V.bursts(spark, d), "eiso", "epeak", "odr")


@query("epeak_eiso_least_squares", "bursts", f"""
WITH pr AS (SELECT log10(eiso) AS lx, log10(epeak) AS ly FROM bursts), ln AS (SELECT regr_slope(ly, lx) AS slope, regr_intercept(ly, lx) AS intercept FROM pr), {QUALITY_SQL}""")
def _(spark, d):
    return fit_frame(P.sample_fit(V.bursts(spark, d), "eiso", "epeak", "ols"))


@query("epeak_luminosity_sample_fit", "bursts", f"""
WITH pr AS (SELECT log10(epeak) AS lx, log10(lpeak) AS ly FROM bursts), ln AS (SELECT regr_slope(ly, lx) AS slope, regr_intercept(ly, lx) AS intercept FROM pr), {QUALITY_SQL}""")
def _(spark, d):
    return fit_frame(P.sample_fit(V.bursts(spark, d), "epeak", "lpeak", "ols"))


@query("orthogonal_fit_unweighted", "bursts", f"""
WITH pr AS (SELECT log10(t90) AS lx, log10(hr_ratio) AS ly FROM bursts WHERE t90 > 0 AND hr_ratio > 0),
mo AS (SELECT var_pop(lx) AS vx, var_pop(ly) AS vy, covar_pop(lx, ly) AS c, avg(lx) AS mx, avg(ly) AS my FROM pr),
sl AS (SELECT (vy - vx + sqrt((vy - vx) * (vy - vx) + 4 * c * c)) / (2 * c) AS slope, mx, my FROM mo),
ln AS (SELECT slope, my - slope * mx AS intercept FROM sl), {QUALITY_SQL}""")
def _(spark, d):
    return fit_frame(P.sample_fit(V.bursts(spark, d), "t90", "hr_ratio", "odr_plain"))


def band_sql(x, y):
    return f"""
WITH pr AS (SELECT burst_name, log10({x}) AS lx, log10({y}) AS ly FROM bursts WHERE {x} > 0 AND {y} > 0),
ln AS (SELECT regr_slope(ly, lx) AS s, regr_intercept(ly, lx) AS i, min(lx) AS a, max(lx) AS z, count(*) AS n FROM pr),
sc AS (SELECT stddev_pop(ly - (s * lx + i)) AS sc FROM pr, ln),
hl AS (SELECT lx, ly FROM pr WHERE burst_name = 'Customer#000000010')
SELECT round(s, 6) AS slope, round(i, 5) AS intercept, round(sc, 6) AS scatter, n AS n_points, round(s * a + i, 5) AS y_lo, round(s * z + i, 5) AS y_hi,
  round(s * a + i - 2 * sc, 5) AS y_lo_minus, round(s * z + i + 2 * sc, 5) AS y_hi_plus, round((ly - s * lx - i) / sc, 5) AS highlight_sigma FROM ln, sc, hl"""


def band_frame(b, x, y):
    out = P.band_lines(b, x, y, F.col("burst_name") == "Customer#000000010")
    return out.select(r6("slope").alias("slope"), r6("scatter").alias("scatter"), "n_points",
                      *[r6(c, 5).alias(c) for c in ("intercept", "y_lo", "y_hi", "y_lo_minus", "y_hi_plus", "highlight_sigma")])


for _name, _x, _y in (("amati", "eiso", "epeak"), ("yonetoku", "epeak", "lpeak"), ("ghirlanda", "lpeak", "eiso")):
    query(f"{_name}_band_lines", "bursts", band_sql(_x, _y))(lambda spark, d, x=_x, y=_y: band_frame(V.bursts(spark, d), x, y))


@query("correlation_grid_pairs", "bursts", " UNION ALL ".join(
    f"SELECT '{n}' AS panel, burst_id, round({x}, 8) AS x, round({y}, 8) AS y FROM bursts WHERE {w}" for n, x, y, w in (
        ("epeak_eiso", "log10(eiso)", "log10(epeak)", "eiso > 0 AND epeak > 0"), ("epeak_lpeak", "log10(epeak)", "log10(lpeak)", "epeak > 0 AND lpeak > 0"),
        ("t90_eiso", "log10(t90)", "log10(eiso)", "t90 > 0 AND eiso > 0"), ("z_eiso", "redshift", "log10(eiso)", "redshift >= 0 AND eiso > 0"))))
def _(spark, d):
    c = F.col
    b = V.bursts(spark, d)
    pos = lambda n: F.when(c(n) > 0, F.log10(n))
    z = F.when(c("redshift") >= 0, c("redshift"))
    rows = F.array(*[F.struct(F.lit(n).alias("panel"), x.alias("x"), y.alias("y")) for n, x, y in (
        ("epeak_eiso", pos("eiso"), pos("epeak")), ("epeak_lpeak", pos("epeak"), pos("lpeak")), ("t90_eiso", pos("t90"), pos("eiso")),
        ("z_eiso", z, pos("eiso")))])
    return b.select("burst_id", F.inline(rows)).filter("x IS NOT NULL AND y IS NOT NULL").select(
        "panel", "burst_id", r6("x", 8).alias("x"), r6("y", 8).alias("y"))


def hist_sql(value, bins, where="true"):
    return f"""
WITH v AS (SELECT {value} AS v FROM bursts WHERE {where}), m AS (SELECT min(v) AS a, max(v) AS z, (max(v) - min(v)) / {bins} AS w, count(*) AS n FROM v),
c AS (SELECT least(floor((v - a) / w)::BIGINT, {bins - 1}) AS bin, count(*) AS k FROM v, m GROUP BY 1)
SELECT i AS bin, round(a + i * w, 6) AS lo, round(a + (i + 1) * w, 6) AS hi, coalesce(k, 0) AS count, n AS n_total FROM m, range({bins}) r(i) LEFT JOIN c ON c.bin = i"""


def hist_frame(h):
    return h.select("bin", r6("lo").alias("lo"), r6("hi").alias("hi"), "count", "n_total")


for _name, _col, _bins in (("t90", "t90", 50), ("fluence", "eiso", 30), ("peak_flux", "lpeak", 30)):
    query(f"{_name}_log_histogram", "bursts", hist_sql(f"log10({_col})", _bins, f"{_col} > 0"))(
        lambda spark, d, c=_col, n=_bins: hist_frame(P.histogram(V.bursts(spark, d), F.when(F.col(c) > 0, F.log10(c)), n)))


@query("luminosity_function", "bursts", hist_sql("log10(lpeak)", 30, "lpeak > 0 AND redshift IS NOT NULL"))
def _(spark, d):
    return hist_frame(P.histogram(V.bursts(spark, d).filter("redshift IS NOT NULL"), F.when(F.col("lpeak") > 0, F.log10("lpeak")), 30))


@query("t90_kernel_density", "bursts", """
WITH v AS (SELECT log10(t90) AS v FROM bursts WHERE t90 > 0), m AS (SELECT min(v) AS a, max(v) AS z, stddev(v) * pow(count(*)::DOUBLE, -0.2::DOUBLE) AS h, count(*) AS n FROM v),
g AS (SELECT i AS step, a + i * (z - a) / 199 AS x, a, z, h, n FROM m, range(200) r(i))
SELECT step, round(x, 6) AS x, round(sum(exp(-pow((x - v) / h, 2) / 2) / (h * sqrt(2 * pi()))) / n, 6) AS density,
       round(sum(exp(-pow((x - v) / h, 2) / 2) / (h * sqrt(2 * pi()))) * (z - a) / 50, 4) AS scaled FROM g, v GROUP BY step, x, n, a, z""")
def _(spark, d):
    k = P.kernel_density(V.bursts(spark, d), F.when(F.col("t90") > 0, F.log10("t90")))
    return k.select("step", r6("x").alias("x"), r6("density").alias("density"), r6("scaled", 4).alias("scaled"))


@query("redshift_histogram", "bursts", hist_sql("redshift", 30, "redshift >= 0"))
def _(spark, d):
    return hist_frame(P.histogram(V.bursts(spark, d), F.when(F.col("redshift") >= 0, F.col("redshift")), 30))


@query("redshift_summary_and_rate", "bursts", """
SELECT round(median(redshift), 6) AS median, round(avg(redshift), 6) AS mean, count(*) AS n FROM bursts WHERE redshift >= 0""")
def _(spark, d):
    m = P.median_and_mean(V.bursts(spark, d), F.when(F.col("redshift") >= 0, F.col("redshift")))
    return m.select(r6("median").alias("median"), r6("mean").alias("mean"), "n")


@query("burst_rate_by_redshift", "bursts", hist_sql("redshift", 20, "redshift >= 0"))
def _(spark, d):
    return hist_frame(P.histogram(V.bursts(spark, d), F.when(F.col("redshift") >= 0, F.col("redshift")), 20))


@query("hardness_duration_plane", "bursts", """
SELECT burst_id, round(log10(t90), 8) AS log_t90, round(log10(hr_ratio), 8) AS log_hr, t90 < 2 AS is_short FROM bursts WHERE isfinite(t90) AND isfinite(hr_ratio)""")
def _(spark, d):
    cls = F.when(F.col("t90") < 2, "Short").otherwise("Long")
    return V.bursts(spark, d).filter(P.finite(F.col("t90")) & P.finite(F.col("hr_ratio"))).select(
        "burst_id", r6(F.log10("t90"), 8).alias("log_t90"), r6(F.log10("hr_ratio"), 8).alias("log_hr"), (F.lower(cls) == "short").alias("is_short"))


@query("hardness_duration_marginals", "bursts", hist_sql("log10(hr_ratio)", 30))
def _(spark, d):
    return hist_frame(P.histogram(V.bursts(spark, d), F.log10("hr_ratio"), 30))


@query("sky_positions", "bursts", """
SELECT burst_id, round(radians(ra), 6) AS ra_rad, round(radians(dec), 6) AS dec_rad,
       CASE WHEN burst_id IN (SELECT burst_id FROM bursts ORDER BY burst_id LIMIT 10) THEN burst_name END AS label FROM bursts WHERE isfinite(ra) AND isfinite(dec)""")
def _(spark, d):
    b = V.bursts(spark, d).filter(P.finite(F.col("ra")) & P.finite(F.col("dec")))
    labels = b.orderBy("burst_id").limit(10).select("burst_id", F.col("burst_name").alias("label"))
    return b.select("burst_id", r6(F.radians("ra")).alias("ra_rad"), r6(F.radians("dec")).alias("dec_rad")).join(labels, "burst_id", "left")


@query("class_shares", "bursts", """
SELECT mission, count(*) AS count, round(count(*) * 100e0 / sum(count(*)) OVER (), 6) AS percent FROM bursts GROUP BY 1""")
def _(spark, d):
    return P.class_shares(V.bursts(spark, d), "mission").withColumn("percent", r6("percent"))


@query("mission_timeline", "", """
SELECT o_orderpriority AS mission, min(year(o_orderdate))::BIGINT AS start_year, max(year(o_orderdate))::BIGINT AS end_year, count(*) AS count FROM orders GROUP BY 1""")
def _(spark, d):
    return P.mission_timeline(V.table(spark, d, "orders").withColumnRenamed("o_orderpriority", "mission"), "mission",
                              F.year("o_orderdate").cast("long"))


CORNER = ("t90", "epeak", "eiso", "redshift")


@query("corner_correlations", "bursts", " UNION ALL ".join(
    f"SELECT '{a}' AS y, '{b}' AS x, round(corr({a}, {b}), 6) AS r, count(*) FILTER (WHERE {a} IS NOT NULL AND {b} IS NOT NULL) AS n FROM bursts"
    for i, a in enumerate(CORNER) for b in CORNER[:i]))
def _(spark, d):
    return P.correlation_matrix(V.bursts(spark, d), CORNER).withColumn("r", r6("r"))


@query("corner_histograms", "bursts", " UNION ALL ".join(
    f"SELECT '{c}' AS property, * FROM ({hist_sql(c, 20, f'{c} IS NOT NULL')})" for c in ("t90", "epeak", "redshift")))
def _(spark, d):
    long = P.unpivot(V.bursts(spark, d), "burst_id", ["t90", "epeak", "redshift"])
    h = P.histogram(long, F.col("value"), 20, ["property"])
    return h.select("property", "bin", r6("lo").alias("lo"), r6("hi").alias("hi"), "count", "n_total")


@query("population_comparison", "bursts", """
WITH l AS (SELECT burst_id, unnest([{'p': 't90', 'v': t90}, {'p': 'epeak', 'v': epeak}, {'p': 'eiso', 'v': eiso}]) AS s FROM bursts)
SELECT burst_id, s.p AS property, round(percent_rank() OVER (PARTITION BY s.p ORDER BY round(log10(s.v), 9)), 6) AS percent_rank,
       round((s.v - avg(s.v) OVER w) / stddev_pop(s.v) OVER w, 5) AS z_score FROM l WINDOW w AS (PARTITION BY s.p)""")
def _(spark, d):
    b = V.bursts(spark, d)
    out = P.population_position(b, "burst_id", ["t90", "epeak", "eiso"])
    return out.select("burst_id", "property", r6("percent_rank").alias("percent_rank"), r6("z_score", 5).alias("z_score"))


@query("range_anomalies", "bursts", """
SELECT burst_id, property, round(v, 6) AS value, round(greatest(lo - v, v - hi) / (hi - lo), 6) AS significance FROM (
  SELECT burst_id, 'epeak' AS property, epeak AS v, 10e0 AS lo, 10000e0 AS hi FROM bursts UNION ALL
  SELECT burst_id, 'redshift', redshift * 10, 0e0, 20e0 FROM bursts UNION ALL SELECT burst_id, 't90', t90 / 100, 0.01e0, 10000e0 FROM bursts)
WHERE v IS NOT NULL AND NOT v BETWEEN lo AND hi""")
def _(spark, d):
    b = V.bursts(spark, d).select("burst_id", "epeak", (F.col("redshift") * 10).alias("redshift"), (F.col("t90") / 100).alias("t90"))
    return P.range_anomalies(b, "burst_id", TYPICAL_RANGES).select("burst_id", "property", r6("value").alias("value"), r6("significance").alias("significance"))


V.DUCK_VIEWS["alerts"] = ((), """
    SELECT o_orderkey AS alert_id, (o_orderkey::DOUBLE * 7.31e0) % 1200e0 AS t, (o_orderkey::DOUBLE * 53.17e0) % 360e0 AS ra,
           (o_orderkey % 181) - 90e0 AS dec FROM orders""")
V.DUCK_VIEWS["triggers"] = (("bursts",), "SELECT burst_id, trigger_time - 59000e0 AS t, ra, dec FROM bursts")


def alerts(spark, d):
    k = F.col("o_orderkey").cast("double")
    return V.table(spark, d, "orders").select(F.col("o_orderkey").alias("alert_id"), (k * 7.31 % 1200.0).alias("t"), (k * 53.17 % 360.0).alias("ra"),
                                              (F.col("o_orderkey") % 181 - 90.0).alias("dec"))


def triggers(spark, d):
    return V.bursts(spark, d).select("burst_id", (F.col("trigger_time") - 59000.0).alias("t"), "ra", "dec")


@query("gravitational_wave_cross_match", "alerts triggers", f"""
WITH h AS (SELECT b.burst_id, a.alert_id, a.t - b.t AS dt, {s_sep("b.ra", "b.dec", "a.ra", "a.dec")} AS s FROM triggers b JOIN alerts a ON abs(a.t - b.t) <= 10)
SELECT b.burst_id, h.alert_id, round(h.dt, 6) AS dt, round(h.s, 5) AS separation FROM triggers b LEFT JOIN (SELECT * FROM h WHERE s <= 15) h USING (burst_id)""")
def _(spark, d):
    m = P.cross_match(triggers(spark, d), alerts(spark, d), 10.0, 15.0)
    return m.select("burst_id", "alert_id", r6("dt").alias("dt"), r6("separation", 5).alias("separation"))


@query("neutrino_cross_match", "alerts triggers", f"""
WITH h AS (SELECT b.burst_id, a.alert_id, {s_sep("b.ra", "b.dec", "a.ra", "a.dec")} AS s FROM triggers b JOIN alerts a ON abs(a.t - b.t) <= 100)
SELECT b.burst_id, count(h.alert_id) AS n_matches FROM triggers b LEFT JOIN (SELECT * FROM h WHERE s <= 5.5) h USING (burst_id) GROUP BY 1""")
def _(spark, d):
    m = P.cross_match(triggers(spark, d), alerts(spark, d), 100.0, 5.5)
    return m.groupBy("burst_id").agg(F.count("alert_id").alias("n_matches"))


# Components used where the check needs the same numbers in both engines.
GIVEN = [(0.3, (-0.2, 0.1), ((0.2, 0.01), (0.01, 0.05))), (0.7, (1.2, -0.1), ((0.3, -0.02), (-0.02, 0.08)))]


def s_logdens(c):
    w, (mx, my), ((a, b), (_, dd)) = c
    det = f"({a} * {dd} - ({b}) * ({b}))::DOUBLE"
    x, y = f"(x - ({mx}))", f"(y - ({my}))"
    return (f"(ln({w}::DOUBLE) - ln(2 * pi()) - 0.5 * ln({det}) - ({dd} * {x} * {x} - 2 * ({b}) * {x} * {y} + {a} * {y} * {y}) / {det} / 2)")


@query("mixture_short_probability", "bursts", f"""
WITH v AS (SELECT burst_id, log10(t90) AS x, log10(hr_ratio) AS y FROM bursts),
l AS (SELECT burst_id, exp({s_logdens(GIVEN[0])}) AS p, exp({s_logdens(GIVEN[1])}) AS q FROM v)
SELECT burst_id, round(p / (p + q), 6) AS short_probability, CASE WHEN p / (p + q) >= 0.5 THEN 'Short' ELSE 'Long' END AS mixture_class,
       round(-ln(p + q), 5) AS nll FROM l""")
def _(spark, d):
    ok, _bad = X.classify(V.bursts(spark, d), GIVEN)
    nll = X.negative_log_likelihood(F.log10("t90"), F.log10("hr_ratio"), GIVEN)
    return ok.select("burst_id", r6("short_probability").alias("short_probability"), "mixture_class", r6(nll, 5).alias("nll"))


def plane(spark, d):
    return V.bursts(spark, d).select("burst_id", F.log10("t90").alias("log_t90"), F.log10("hr_ratio").alias("log_hr"))


@query("mixture_fit_full")
def _(spark, d):
    return X.components_frame(spark, X.fit_mixture(plane(spark, d)))


@query("mixture_fit_constrained")
def _(spark, d):
    out = None
    p = plane(spark, d)
    for kind in ("tied", "diag", "spherical"):
        one = X.components_frame(spark, X.fit_mixture(p, covariance_type=kind)).withColumn("covariance_type", F.lit(kind))
        out = one if out is None else out.unionByName(one)
    return out


@query("mixture_labels")
def _(spark, d):
    p = plane(spark, d)
    return X.predict(p, X.fit_mixture(p, covariance_type="diag"))


@query("mixture_probability_surface")
def _(spark, d):
    return X.surface(plane(spark, d), GIVEN)


@query("mixture_likelihood_surface")
def _(spark, d):
    return X.surface(plane(spark, d), GIVEN, what="nll")
