"""Queries over spectral models, energetics and relations."""

from __future__ import annotations

from pyspark.sql import functions as F

from burstframe.functions import relations as R
from burstframe.functions import spectral_models as M
from burstframe.operators.reuse import spread
from burstframe.plans.registry import query, r6
from burstframe.sources import views as V

V.DUCK_VIEWS["fit_params"] = (("bursts",), """
    SELECT burst_id, CASE burst_id % 4 WHEN 0 THEN 'Band' WHEN 1 THEN 'CPL' WHEN 2 THEN 'PL' ELSE 'BB' END AS model,
           -0.5e0 - (burst_id % 10) / 10e0 AS alpha, -2.1e0 - (burst_id % 7) / 10e0 AS beta,
           -1e0 - (burst_id % 13) / 10e0 AS index, epeak, 0.01e0 * (1 + burst_id % 5) AS norm, redshift,
           burst_id % 11 <> 0 AS fit_success, 100e0 + (burst_id % 30) AS aic FROM bursts""")


def fit_params(spark, d):
    k = F.col("burst_id")
    return spread(V.bursts(spark, d)).select(
        "burst_id", F.when(k % 4 == 0, "Band").when(k % 4 == 1, "CPL").when(k % 4 == 2, "PL").otherwise("BB").alias("model"),
        (F.lit(-0.5) - (k % 10) / 10.0).alias("alpha"), (F.lit(-2.1) - (k % 7) / 10.0).alias("beta"),
        (F.lit(-1.0) - (k % 13) / 10.0).alias("index"), "epeak", (F.lit(0.01) * (k % 5 + 1)).alias("norm"), "redshift",
        (k % 11 != 0).alias("fit_success"), (F.lit(100.0) + k % 30).alias("aic"))


# SQL text of the models, with e, the parameters and norm as expressions
def q_band(e, a, b, ep, n):
    return (f"CASE WHEN {e} < ({a} - {b}) * {ep} / (2 + {a}) THEN {n} * pow({e} / 100, {a}) * exp(-(2 + {a}) * {e} / {ep}) "
            f"ELSE {n} * pow(({a} - {b}) * {ep} / (100 * (2 + {a})), {a} - {b}) * exp({b} - {a}) * pow({e} / 100, {b}) END")


def q_cpl(e, a, ep, n):
    return f"{n} * pow({e} / 100, {a}) * exp(-(2 + {a}) * {e} / {ep})"


def q_pl(e, i, n):
    return f"{n} * pow({e} / 100, {i})"


def q_bb(e, kt, n):
    return f"{n} * {e} * {e} / (exp(greatest(-100, least(100, {e} / {kt}))) - 1)"


def q_sbpl(e, a1, a2, eb, n):
    return (f"{n} * pow({e} / 100, -({a1})) * pow(pow({e} / {eb}, -({a1}) * 0.3::DOUBLE) + pow({e} / {eb}, -({a2}) "
            f"* 0.3::DOUBLE), -1 / 0.3::DOUBLE)")


@query("photon_models", "spectra", f"""
SELECT burst_id, energy, round({q_band("energy", "-0.8::DOUBLE", "-2.3::DOUBLE", "200e0", "1e0")}, 6) AS band,
       round({q_cpl("energy", "-0.8::DOUBLE", "200e0", "1e0")}, 6) AS cpl,
       round({q_pl("energy", "-1.5::DOUBLE", "1e0")}, 6) AS pl,
       round({q_bb("energy", "30e0", "0.001::DOUBLE")}, 6) AS bb,
       round({q_sbpl("energy", "1.1::DOUBLE", "2.2::DOUBLE", "150e0", "1e0")}, 6) AS sbpl FROM spectra""")
def _(spark, d):
    e, lit = F.col("energy"), F.lit
    return V.spectra(spark, d).select(
        "burst_id", "energy", r6(M.band(e, lit(-0.8), lit(-2.3), lit(200.0), lit(1.0))).alias("band"),
        r6(M.cutoff_power_law(e, lit(-0.8), lit(200.0), lit(1.0))).alias("cpl"),
        r6(M.power_law(e, lit(-1.5), lit(1.0))).alias("pl"), r6(M.blackbody(e, lit(30.0), lit(0.001))).alias("bb"),
        r6(M.smooth_broken_power_law(e, lit(1.1), lit(2.2), lit(150.0), lit(1.0))).alias("sbpl"))


@query("fit_statistics", "spectra", f"""
WITH m AS (SELECT *, greatest({q_cpl("energy", "-0.8::DOUBLE", "300e0", "10e0")} * exposure * area, 1e-10) AS e FROM spectra)
SELECT burst_id, round(sum((counts - e) * (counts - e) / e), 4) AS chi_squared,
       round(2 * sum(e - counts * ln(e)), 4) AS cstat FROM m GROUP BY 1""")
def _(spark, d):
    e, lit = F.col("energy"), F.lit
    m = M.cutoff_power_law(e, lit(-0.8), lit(300.0), lit(10.0))
    args = (F.col("counts"), m, F.col("exposure"), F.col("area"))
    return V.spectra(spark, d).groupBy("burst_id").agg(
        F.round(M.chi_squared(*args), 4).alias("chi_squared"), F.round(M.cash(*args), 4).alias("cstat"))


def q_flux(lo: str, hi: str, energy: bool, n: int = 4000) -> str:
    ex = f"exp(ln({lo}) + i * (ln({hi}) - ln({lo})) / {n})"
    mod = (f"CASE model WHEN 'Band' THEN {q_band('ee', 'alpha', 'beta', 'epeak', 'norm')} "
           f"WHEN 'CPL' THEN {q_cpl('ee', 'alpha', 'epeak', 'norm')} WHEN 'PL' THEN {q_pl('ee', 'index', 'norm')} END")
    return (f"SELECT burst_id, sum(w * ee * {'ee * ' if energy else ''}({mod})) * (ln({hi}) - ln({lo})) / {n} / 3 "
            f"{'* 1.602e-9 ' if energy else ''}AS flux FROM (SELECT f.*, CASE WHEN i = 0 OR i = {n} THEN 1 "
            f"WHEN i % 2 = 1 THEN 4 ELSE 2 END AS w, {ex} AS ee FROM fit_params f, range({n + 1}) r(i) "
            f"WHERE fit_success AND model <> 'BB') GROUP BY 1")




def params():
    return {k: F.col(k) for k in ("alpha", "beta", "epeak", "index", "norm")}


def log_pos(c):
    return F.round(F.when(c > 0, F.log10(c)), 6)


@query("energy_and_photon_flux", "fit_params", f"""
WITH e AS ({q_flux("10e0", "10000e0", True)}), p AS ({q_flux("10e0", "10000e0", False)})
SELECT f.burst_id, f.model, round(log10(e.flux), 6) AS log_energy_flux, round(log10(e.flux * 0.1::DOUBLE), 6) AS log_energy_flux_err,
       round(log10(p.flux), 6) AS log_photon_flux
FROM fit_params f LEFT JOIN e USING (burst_id) LEFT JOIN p USING (burst_id)""")
def _(spark, d):
    f = fit_params(spark, d)
    args = (F.col("model"), params(), F.col("fit_success"), F.lit(10.0), F.lit(10000.0))
    v = f.select("burst_id", "model", M.flux(*args, True).alias("e"), M.flux(*args, False).alias("p"))
    return v.select("burst_id", "model", log_pos(F.col("e")).alias("log_energy_flux"),
                    log_pos(F.col("e") * 0.1).alias("log_energy_flux_err"), log_pos(F.col("p")).alias("log_photon_flux"))


@query("flux_in_ranges", "fit_params", " UNION ALL ".join(
    f"SELECT f.burst_id, {lo}e0 AS lo, {hi}e0 AS hi, round(log10(flux), 6) AS log_flux FROM fit_params f "
    f"LEFT JOIN ({q_flux(f'{lo}e0', f'{hi}e0', True)}) USING (burst_id)" for lo, hi in ((15, 150), (50, 300), (100, 1000))))
def _(spark, d):
    ranges = F.array(*[F.struct(F.lit(float(a)).alias("lo"), F.lit(float(b)).alias("hi"))
                       for a, b in ((15, 150), (50, 300), (100, 1000))])
    wide = fit_params(spark, d).select("*", F.inline(ranges))
    v = M.flux(F.col("model"), params(), F.col("fit_success"), F.col("lo"), F.col("hi"), True)
    return wide.select("burst_id", "lo", "hi", v.alias("v")).select("burst_id", "lo", "hi", log_pos(F.col("v")).alias("log_flux"))


@query("epeak_from_parameters", "fit_params", """
SELECT burst_id, round(CASE WHEN model = 'Band' THEN (alpha - beta) * beta / (2 + alpha) ELSE epeak END, 6) AS epeak FROM fit_params""")
def _(spark, d):
    x = F.when(F.col("model") == "Band", F.col("beta")).otherwise(F.col("epeak"))
    return fit_params(spark, d).select("burst_id", r6(M.epeak_of(F.col("model"), F.col("alpha"), x)).alias("epeak"))


DL_SQL = """
dl AS (SELECT burst_id, (1 + redshift) * 2.998e10 / (70e0 * 1e5 / 3.086e24) * redshift / 400 / 3 * sum(
         CASE WHEN i = 0 OR i = 400 THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END
         / sqrt(0.3::DOUBLE * pow(1 + i * redshift / 400, 3) + 0.7::DOUBLE)) AS dl
       FROM (SELECT burst_id, redshift FROM bursts WHERE redshift IS NOT NULL), range(401) r(i) GROUP BY burst_id, redshift)"""


@query("luminosity_distance", "bursts", f"""
WITH {DL_SQL} SELECT b.burst_id, round(log10(dl), 6) AS log_dl FROM bursts b LEFT JOIN dl USING (burst_id)""")
def _(spark, d):
    return V.bursts(spark, d).select("burst_id", F.round(F.log10(M.luminosity_distance(F.col("redshift"))), 6).alias("log_dl"))


@query("isotropic_energy_and_luminosity", "fit_params bursts", f"""
WITH {DL_SQL}, e AS ({q_flux("10e0", "10000e0", True)})
SELECT f.burst_id, round(log10(4 * pi() * dl * dl * e.flux * 100), 6) AS log_eiso,
       round(log10(4 * pi() * dl * dl * 1e-6 * (1 + f.redshift)), 6) AS log_lpeak
FROM fit_params f LEFT JOIN dl USING (burst_id) LEFT JOIN e ON e.burst_id = f.burst_id""")
def _(spark, d):
    f = fit_params(spark, d).withColumns({
        "dl": M.luminosity_distance(F.col("redshift")),
        "fl": M.flux(F.col("model"), params(), F.col("fit_success"), F.lit(10.0), F.lit(10000.0), True)})
    return f.select("burst_id", log_pos(M.isotropic_energy(F.col("fl"), F.col("dl"))).alias("log_eiso"),
                    F.round(F.log10(M.peak_luminosity(F.lit(1e-6), F.col("redshift"), F.col("dl"))), 6).alias("log_lpeak"))


V.DUCK_VIEWS["xrt"] = (("afterglow_points",), """
    SELECT burst_id, t, flux, flux * 0.1::DOUBLE AS err_pos, flux * 0.05::DOUBLE AS err_neg,
           1.5e0 + (t::BIGINT % 10) / 10e0 AS gamma FROM afterglow_points""")


def xrt(spark, d):
    return V.afterglow_points(spark, d).select(
        "burst_id", "t", "flux", (F.col("flux") * 0.1).alias("err_pos"), (F.col("flux") * 0.05).alias("err_neg"),
        (F.lit(1.5) + (F.col("t").cast("long") % 10) / 10.0).alias("gamma"))


@query("flux_density_conversion", "xrt", """
WITH f AS (SELECT *, pow(10e0, gamma - 1) * pow(2e0, 1 - gamma) AS k FROM xrt)
SELECT burst_id, t, round(k, 6) AS factor, round(flux * k, 4) AS fd, round(err_pos * k, 4) AS fd_pos,
       round(err_neg * k, 4) AS fd_neg FROM f""")
def _(spark, d):
    k = M.flux_density_factor(F.lit(10.0), F.lit(2.0), F.col("gamma"))
    f = xrt(spark, d).withColumn("k", k)
    return f.select("burst_id", "t", r6("k").alias("factor"), r6(F.col("flux") * F.col("k"), 4).alias("fd"),
                    r6(F.col("err_pos") * F.col("k"), 4).alias("fd_pos"), r6(F.col("err_neg") * F.col("k"), 4).alias("fd_neg"))


@query("nu_f_nu_and_density", "spectra", f"""
WITH m AS (SELECT burst_id, energy, counts, {q_cpl("energy", "-0.8::DOUBLE", "300e0", "10e0")} AS model FROM spectra
           WHERE isfinite(counts) AND counts > 0)
SELECT burst_id, energy, energy * energy * counts AS nufnu, round(energy * energy * sqrt(counts), 4) AS nufnu_err,
       counts / 10e0 AS density, round(model / 10, 6) AS model_density,
       round((counts - model) / sqrt(counts), 5) AS residual FROM m""")
def _(spark, d):
    e, n = F.col("energy"), F.col("counts")
    model = M.cutoff_power_law(e, F.lit(-0.8), F.lit(300.0), F.lit(10.0))
    s = V.spectra(spark, d).filter("counts > 0 AND NOT isnan(counts)").withColumn("m", model)
    return s.select("burst_id", "energy", (e * e * n).alias("nufnu"), r6(e * e * F.sqrt(n), 4).alias("nufnu_err"),
                    (n / 10.0).alias("density"), r6(F.col("m") / 10.0).alias("model_density"),
                    r6((n - F.col("m")) / F.sqrt(n), 5).alias("residual"))


@query("model_curve_log_grid", "spectra", f"""
WITH r AS (SELECT burst_id, log10(min(energy)) AS a, log10(max(energy)) AS z FROM spectra GROUP BY 1),
g AS (SELECT burst_id, i, pow(10e0, a + i * (z - a) / 199) AS e FROM r, range(200) x(i))
SELECT burst_id, i AS step, round(e, 5) AS energy, round({q_band("e", "-0.8::DOUBLE", "-2.3::DOUBLE", "200e0", "1e0")}, 6) AS model FROM g""")
def _(spark, d):
    r = V.spectra(spark, d).groupBy("burst_id").agg(F.log10(F.min("energy")).alias("a"), F.log10(F.max("energy")).alias("z"))
    g = r.withColumn("step", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(199).cast("long")))).withColumn(
        "e", F.pow(F.lit(10.0), F.col("a") + F.col("step") * (F.col("z") - F.col("a")) / 199))
    lit = F.lit
    return g.select("burst_id", "step", r6("e", 5).alias("energy"),
                    r6(M.band(F.col("e"), lit(-0.8), lit(-2.3), lit(200.0), lit(1.0))).alias("model"))


@query("epeak_evolution_series", "photons", """
SELECT burst_id, floor(t)::BIGINT AS slice, round(sum(energy * energy) / sum(energy), 6) AS epeak, count(*) AS n
FROM photons WHERE isfinite(energy) GROUP BY 1, 2""")
def _(spark, d):
    e, inf = F.col("energy"), F.lit(float("inf"))
    sums = V.photons(spark, d).filter(~F.isnan("energy")).groupBy("burst_id", F.floor("t").cast("long").alias("slice")).agg(
        F.sum(e * e).alias("ee"), F.sum(e).alias("e"), F.count(F.lit(1)).alias("n"))
    # energies that add up to zero: not a number, or infinite where they cancel, as in SQL
    none = F.when(F.col("ee") == 0, F.lit(float("nan"))).otherwise(inf)
    return sums.select("burst_id", "slice", r6(F.when(F.col("e") == 0, none).otherwise(F.try_divide("ee", "e"))).alias("epeak"), "n")


@query("spectral_slices", "photons", """
WITH iv AS (SELECT burst_id, i, a + i * (z - a) / 4 AS lo, a + (i + 1) * (z - a) / 4 AS hi FROM
             (SELECT burst_id, min(t) AS a, max(t) AS z FROM photons GROUP BY 1), range(4) r(i))
SELECT p.burst_id, iv.i AS slice, floor(energy / 100)::BIGINT AS channel, count(*) AS counts
FROM photons p JOIN iv ON p.burst_id = iv.burst_id AND p.t >= lo AND p.t < hi GROUP BY 1, 2, 3""")
def _(spark, d):
    from burstframe.operators.spectra import slice_spectra

    p = V.photons(spark, d)
    ends = p.groupBy("burst_id").agg(F.min("t").alias("a"), F.max("t").alias("z"))
    step = F.col("z") - F.col("a")
    iv = ends.withColumn("slice", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(3).cast("long")))).select(
        "burst_id", "slice", (F.col("a") + F.col("slice") * step / 4).alias("lo"),
        (F.col("a") + (F.col("slice") + 1) * step / 4).alias("hi"))
    return slice_spectra(p, iv, F.floor(F.col("energy") / 100).cast("long"))


@query("sed_by_instrument", "photons", """
SELECT burst_id, band AS instrument, count(*) AS n, round(avg(energy), 6) AS energy, round(stddev_pop(energy), 6) AS spread
FROM photons WHERE isfinite(energy) AND energy > 0 GROUP BY 1, 2""")
def _(spark, d):
    return V.photons(spark, d).filter("energy > 0 AND NOT isnan(energy)").groupBy(
        "burst_id", F.col("band").alias("instrument")).agg(
        F.count(F.lit(1)).alias("n"), r6(F.avg("energy")).alias("energy"), r6(F.stddev_pop("energy")).alias("spread"))


@query("fit_quality_class", "bursts", """
SELECT burst_id, CASE WHEN hr_ratio < 0.8 THEN 'Excellent' WHEN hr_ratio < 1.2 THEN 'Good' WHEN hr_ratio < 2 THEN 'Acceptable'
       ELSE 'Poor' END AS quality FROM bursts""")
def _(spark, d):
    return V.bursts(spark, d).select("burst_id", M.fit_quality(F.col("hr_ratio")).alias("quality"))


REL = """round({s} * log10({x}) + ({i}), 6) AS {n}_expected, round((log10({y}) - {s} * log10({x}) - ({i})) / {c}, 5) AS {n}_sigma,
  abs((log10({y}) - ({s} * log10({x}) + ({i}))) / {c}) > 2 AS {n}_outlier"""


@query("relation_checks", "bursts", "SELECT burst_id, " + ", ".join(
    REL.format(n=n, x=x, y=y, s=f"{s!r}::DOUBLE", i=f"{i!r}::DOUBLE", c=f"{c!r}::DOUBLE")
    for n, x, y, s, i, c in (("amati", "eiso", "epeak", 0.57, -27.2, 0.2), ("yonetoku", "epeak", "lpeak", 2.0, 47.0, 0.25),
                             ("ghirlanda", "epeak", "eiso", 1.74, 30.38, 0.27))) + " FROM bursts")
def _(spark, d):
    b = V.bursts(spark, d)
    out = ["burst_id"]
    for n, x, y in (("amati", "eiso", "epeak"), ("yonetoku", "epeak", "lpeak"), ("ghirlanda", "epeak", "eiso")):
        rel = R.relation(n, F.col(x), F.col(y))
        out += [r6(rel["log_expected"]).alias(f"{n}_expected"), r6(rel["sigma_offset"], 5).alias(f"{n}_sigma"),
                rel["is_outlier"].alias(f"{n}_outlier")]
    return b.select(*out)


@query("lag_and_variability_luminosity", "bursts", """
WITH x AS (SELECT burst_id, 0.01e0 * (1 + burst_id % 20) AS lag, 0.1e0 * (1 + burst_id % 9) AS v, lpeak FROM bursts),
y AS (SELECT *, 0.05::DOUBLE * pow(lpeak / 1e52, -0.4::DOUBLE) AS el, pow(10e0, -0.5 * log10(lpeak) + 2) AS ev FROM x)
SELECT burst_id, round(el, 6) AS expected_lag, round(lag / el, 5) AS lag_ratio, lag / el > 0.5 AND lag / el < 2 AS lag_consistent,
       round(-0.5 * log10(lpeak) + 2, 6) AS log_expected_v, v / ev > 0.5 AND v / ev < 2 AS v_consistent FROM y""")
def _(spark, d):
    k = F.col("burst_id")
    b = V.bursts(spark, d).withColumn("lag", F.lit(0.01) * (k % 20 + 1)).withColumn("v", F.lit(0.1) * (k % 9 + 1))
    a, v = R.lag_luminosity(F.col("lag"), F.col("lpeak")), R.variability_luminosity(F.col("v"), F.col("lpeak"))
    return b.select("burst_id", r6(a["expected_lag"]).alias("expected_lag"), r6(a["ratio"], 5).alias("lag_ratio"),
                    a["consistent"].alias("lag_consistent"), r6(v["log_expected"]).alias("log_expected_v"),
                    v["consistent"].alias("v_consistent"))


@query("all_relation_checks", "bursts", """
SELECT burst_id, CASE WHEN redshift IS NOT NULL THEN round((log10(epeak * (1 + redshift)) - 0.57::DOUBLE * log10(eiso) + 27.2::DOUBLE) / 0.2::DOUBLE, 5) END AS amati_sigma,
  CASE WHEN redshift IS NOT NULL THEN round((log10(lpeak) - 2 * log10(epeak * (1 + redshift)) - 47) / 0.25, 5) END AS yonetoku_sigma FROM bursts""")
def _(spark, d):
    b = V.bursts(spark, d).withColumn("epeak_rest", F.col("epeak") * (F.col("redshift") + 1))
    out = R.all_relations(b)
    return out.select("burst_id", r6("amati.sigma_offset", 5).alias("amati_sigma"),
                      r6("yonetoku.sigma_offset", 5).alias("yonetoku_sigma"))


@query("closure_relations", "bursts", """
WITH x AS (SELECT burst_id, 0.5e0 + (burst_id % 21) / 10e0 AS a, 0.3e0 + (burst_id % 11) / 10e0 AS b FROM bursts),
y AS (SELECT burst_id, a, unnest([{'r': 'FS_ISM_Synchrotron_SlowCool', 'p': (3 * b - 1) / 2}, {'r': 'FS_ISM_IC_SlowCool', 'p': (3 * b + 1) / 2},
        {'r': 'FS_ISM_Synchrotron_FastCool', 'p': b / 2 - 0.25}, {'r': 'FS_Wind_Synchrotron_SlowCool', 'p': (3 * b - 1) / 2 - 0.5}]) AS z FROM x)
SELECT burst_id, z.r AS relation, round(z.p, 6) AS predicted, round(a - z.p, 9) < 0.3 AND round(a - z.p, 9) > -0.3 AS consistent FROM y""")
def _(spark, d):
    k = F.col("burst_id")
    a, b = F.lit(0.5) + (k % 21) / 10.0, F.lit(0.3) + (k % 11) / 10.0
    x = V.bursts(spark, d).select("burst_id", a.alias("a"), b.alias("b"))
    rel = F.concat(R.closure(F.col("a"), F.col("b"), "ISM"), R.closure(F.col("a"), F.col("b"), "wind"))
    out = x.select("burst_id", "a", F.inline(rel))
    near = F.round(F.abs(F.col("a") - F.col("predicted")), 9) < 0.3
    return out.select("burst_id", "relation", r6("predicted").alias("predicted"), near.alias("consistent"))


@query("jet_angle_and_forward_shock", "bursts", """
SELECT burst_id, round(0.07::DOUBLE * sqrt(1e0 * (eiso / 1e51) / (t90 * 1000 / 86400)), 6) AS jet_angle,
       round(log10(pow(eiso, 0.25) * sqrt(1e0) / 1e56 * pow(t90 + 1, -0.75)), 6) AS log_shock FROM bursts""")
def _(spark, d):
    return V.bursts(spark, d).select(
        "burst_id", r6(R.jet_angle(F.col("t90") * 1000.0, F.col("eiso"))).alias("jet_angle"),
        r6(F.log10(R.forward_shock(F.col("t90"), F.col("eiso")))).alias("log_shock"))
