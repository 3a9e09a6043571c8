"""Queries over curve fits: afterglows, spectra, pulses, lags."""

from __future__ import annotations

from pyspark.sql import functions as F

from burstframe.operators import afterglow as A
from burstframe.operators import spectra as S
from burstframe.operators.reuse import keep
from burstframe.plans.registry import query, r6
from burstframe.plans.spectral_queries import q_bb, q_pl
from burstframe.sources import views as V


def points(spark, d):
    return keep(V.afterglow_points(spark, d))


def rows(spark, d):
    return A.numbered(V.afterglow_points(spark, d))


def decay_ctes(source: str, extra: str = "") -> str:
    """Grid fit of the power-law decay per burst (and ``extra`` key) over ``source``."""
    k = f"burst_id{', ' + extra if extra else ''}"
    return f"""
fr AS (SELECT {k}, min(flux) * 0.5 AS lo, max(flux) * 2 AS hi, count(*) AS n_points FROM {source} GROUP BY ALL),
gs AS (SELECT {k}, g, 0.1::DOUBLE + 4.9::DOUBLE * g / 98e0 AS a,
         sum(flux * pow(t, -(0.1::DOUBLE + (5::DOUBLE - 0.1::DOUBLE) * (g / 98e0))) / (flux_err * flux_err)) AS fm,
         sum(pow(t, -2 * (0.1::DOUBLE + (5::DOUBLE - 0.1::DOUBLE) * (g / 98e0))) / (flux_err * flux_err)) AS mm,
         sum(flux * flux / (flux_err * flux_err)) AS ff
       FROM {source}, range(99) r(g) GROUP BY ALL),
gn AS (SELECT gs.*, n_points, greatest(lo, least(hi, fm / mm)) AS f0 FROM gs JOIN fr USING ({k})),
gc AS (SELECT *, ff - 2 * f0 * fm + f0 * f0 * mm AS chi FROM gn),
fit AS (SELECT {k}, arg_min(a, {{'c': chi, 'g': g}}) AS decay_index, arg_min(f0, {{'c': chi, 'g': g}}) AS norm, min(chi) AS chi_sq,
          max(n_points) AS n_points FROM gc GROUP BY ALL)"""


@query("power_law_decay_grid", "afterglow_points", f"""
WITH {decay_ctes("afterglow_points")}
SELECT burst_id, round(decay_index, 6) AS decay_index, round(log10(norm), 6) AS log_norm, n_points - 2 AS dof FROM fit""")
def _(spark, d):
    return A.power_law_decay(points(spark, d), refine=False).select(
        "burst_id", r6("decay_index").alias("decay_index"), r6(F.log10("norm")).alias("log_norm"), "dof")


@query("power_law_decay_refined")
def _(spark, d):
    return A.power_law_decay(points(spark, d), errors=True)


@query("broken_power_law_fit")
def _(spark, d):
    return A.broken_power_law(rows(spark, d))


@query("double_broken_power_law_fit")
def _(spark, d):
    return A.double_broken_power_law(rows(spark, d))


NUM = "num AS (SELECT *, row_number() OVER (PARTITION BY burst_id ORDER BY t) - 1 AS pos, count(*) OVER (PARTITION BY burst_id) AS n FROM afterglow_points)"


@query("plateau_detection", "afterglow_points", f"""
WITH {NUM},
base AS (SELECT *, greatest(3, n // 10) AS w FROM num WHERE n >= 10),
win AS (SELECT b.burst_id, s AS win, b.t, b.flux, b.flux_err FROM base b, LATERAL (SELECT unnest(range(b.pos - b.w + 1, b.pos + 1)) AS s)
        WHERE s >= 0 AND s < b.n - b.w),
{decay_ctes("win", "win")},
md AS (SELECT f.burst_id, b.t, f.decay_index AS a FROM fit f JOIN base b ON b.burst_id = f.burst_id AND b.pos = f.win + b.w // 2
       WHERE abs(decay_index) < 0.5),
sp AS (SELECT burst_id, min(t) AS st, max(t) AS et, avg(a) AS ma FROM md GROUP BY 1),
lv AS (SELECT b.burst_id, avg(flux) AS lvl FROM base b JOIN sp ON b.burst_id = sp.burst_id AND b.t BETWEEN st AND et GROUP BY 1)
SELECT k.burst_id, st IS NOT NULL AS has_plateau, st AS start_time, et AS end_time, round(log10(lvl), 6) AS plateau_level,
       round(ma, 6) AS mean_alpha
FROM (SELECT DISTINCT burst_id FROM afterglow_points) k LEFT JOIN sp USING (burst_id) LEFT JOIN lv USING (burst_id)""")
def _(spark, d):
    return A.detect_plateau(rows(spark, d)).select(
        "burst_id", "has_plateau", "start_time", "end_time", r6(F.log10("plateau_level")).alias("plateau_level"),
        r6("mean_alpha").alias("mean_alpha"))


@query("jet_break_detection", "afterglow_points", f"""
WITH {NUM},
hv AS (SELECT *, (pos >= n // 2)::INT AS half FROM num WHERE n >= 20),
{decay_ctes("hv", "half")},
wd AS (SELECT burst_id, max(decay_index) FILTER (WHERE half = 0) AS a1, max(decay_index) FILTER (WHERE half = 1) AS a2 FROM fit GROUP BY 1),
tb AS (SELECT burst_id, t FROM hv WHERE pos = n // 2),
o AS (SELECT k.burst_id, coalesce(abs(a2 - a1) > 0.5, false) AS has, a1, a2, t FROM (SELECT DISTINCT burst_id FROM num) k
      LEFT JOIN wd USING (burst_id) LEFT JOIN tb USING (burst_id))
SELECT burst_id, has AS has_jet_break, CASE WHEN has THEN t END AS break_time, round(CASE WHEN has THEN a1 END, 6) AS alpha_before,
       round(CASE WHEN has THEN a2 END, 6) AS alpha_after, round(CASE WHEN has THEN a2 - a1 END, 6) AS steepening FROM o""")
def _(spark, d):
    j = A.detect_jet_break(rows(spark, d), refine=False)
    return j.select("burst_id", "has_jet_break", "break_time", *[r6(c).alias(c) for c in ("alpha_before", "alpha_after", "steepening")])


@query("reverse_shock_flag", "afterglow_points", f"""
WITH {NUM},
ea AS (SELECT * FROM num WHERE n >= 10 AND n // 4 >= 3 AND pos < n // 4),
{decay_ctes("ea")}
SELECT k.burst_id, round(decay_index, 6) AS decay_index, decay_index IS NOT NULL AS has_reverse_shock
FROM (SELECT DISTINCT burst_id FROM num) k LEFT JOIN (SELECT * FROM fit WHERE decay_index > 2) f USING (burst_id)""")
def _(spark, d):
    return A.reverse_shock(rows(spark, d), refine=False).select("burst_id", r6("decay_index").alias("decay_index"), "has_reverse_shock")


@query("energy_injection_fit")
def _(spark, d):
    return A.energy_injection(rows(spark, d))


@query("multi_band_joint_fit")
def _(spark, d):
    o = V.table(spark, d, "orders")
    t = F.floor(V.micros("o_orderdate", "1995-01-01 00:00:00") / F.lit(86400e6)).cast("double") + 1.0
    p = o.groupBy(F.col("o_custkey").alias("burst_id"), F.col("o_orderstatus").alias("band"), t.alias("t")).agg(
        (F.avg("o_totalprice") / 1e4).alias("flux")).withColumn("flux_err", F.col("flux") * 0.1)
    out = A.multi_band_fit(keep(p))
    return out.withColumn("bands", F.to_json("bands"))


@query("normalised_afterglows", "afterglow_points", """
SELECT burst_id, t - min(t) OVER (PARTITION BY burst_id) + 0.01::DOUBLE AS t_rel, round(flux, 4) AS flux,
       round(flux - flux_err, 4) AS flux_lo, round(flux + flux_err, 4) AS flux_hi
FROM afterglow_points WHERE t > 0 AND flux > 0 AND isfinite(flux)""")
def _(spark, d):
    return A.normalised(V.afterglow_points(spark, d)).select(
        "burst_id", "t_rel", *[r6(c, 4).alias(c) for c in ("flux", "flux_lo", "flux_hi")])


def cash_grid_sql(n: int, value: str, model: str, name: str) -> str:
    return f"""
WITH g AS (SELECT s.*, g, {value} AS p FROM spectra s, range({n}) r(g)),
m AS (SELECT *, greatest(({model}) * exposure * area, 1e-300) AS e FROM g),
s AS (SELECT burst_id, g, any_value(p) AS p, sum(counts) AS sn, sum(e) AS se, sum(counts * ln(e)) AS snl, count(*) AS np FROM m GROUP BY 1, 2),
z AS (SELECT *, greatest(1e-5, least(1000, sn / se)) AS nrm FROM s),
c AS (SELECT *, 2 * (nrm * se - snl - sn * ln(nrm)) AS st FROM z)
SELECT burst_id, round(arg_min(p, {{'c': st, 'g': g}}), 6) AS {name}, round(min(st), 4) AS cstat, max(np) - 2 AS dof,
       round(min(st) + 4, 4) AS aic, round(min(st) + 2 * ln(max(np)), 4) AS bic FROM c GROUP BY 1"""


def spec_fit(spark, d, model, name):
    f = S.fit_model(V.spectra(spark, d), model, refine=False)
    return f.select("burst_id", r6(F.col("params")[name]).alias(name), r6("cstat", 4).alias("cstat"), "dof", r6("aic", 4).alias("aic"),
                    r6("bic", 4).alias("bic"))


@query("power_law_spectrum_grid", "spectra", cash_grid_sql(
    81, "-3::DOUBLE + 4::DOUBLE * (g / 80e0)", q_pl("energy", "p", "1e0"), "index"))
def _(spark, d):
    return spec_fit(spark, d, "PL", "index")


@query("blackbody_spectrum_grid", "spectra", cash_grid_sql(
    121, "exp(ln(0.1::DOUBLE) + (ln(100::DOUBLE) - ln(0.1::DOUBLE)) * (g / 120e0))", q_bb("energy", "p", "1e0"), "kT"))
def _(spark, d):
    return spec_fit(spark, d, "BB", "kT")


def fitted(spark, d, model, errors=True):
    return S.fit_model(keep(V.spectra(spark, d)), model, errors=errors).withColumns(
        {"params": F.to_json("params"), **({"errors": F.to_json("errors")} if errors else {})})


@query("band_spectrum_fit")
def _(spark, d):
    return fitted(spark, d, "Band")


@query("cutoff_power_law_spectrum_fit")
def _(spark, d):
    return fitted(spark, d, "CPL")


@query("power_law_spectrum_fit")
def _(spark, d):
    return fitted(spark, d, "PL")


@query("blackbody_spectrum_fit")
def _(spark, d):
    return fitted(spark, d, "BB")


@query("smooth_broken_spectrum_fit")
def _(spark, d):
    return fitted(spark, d, "SBPL")


@query("best_spectral_model")
def _(spark, d):
    fits = S.fit_spectra(keep(V.spectra(spark, d)), ["Band", "CPL", "PL", "BB", "SBPL"])
    return S.choose_model(fits).withColumn("params", F.to_json("params"))


@query("fred_pulse_fit")
def _(spark, d):
    from burstframe.operators.temporal import fit_fred_pulse

    return fit_fred_pulse(V.lightcurves_dense(spark, d))


@query("fred_pulses_joint_fit")
def _(spark, d):
    """Up to three pulses a series in one joint fit, their number by BIC."""
    from burstframe.operators.pulse_fit import fit_fred_pulses

    out = fit_fred_pulses(V.lightcurves_dense(spark, d))
    return out.select("burst_id", "band", "n_pulses", "chi_sq", "dof", "aic", "bic", "fit_success", F.posexplode_outer("pulses").alias("pulse", "p")).select("*", "p.*").drop("p")


@query("spectral_lag_peak_fit")
def _(spark, d):
    from burstframe.operators import temporal as T
    from burstframe.plans.temporal_queries import lag_pair

    return T.fit_lag(keep(T.cross_correlation(lag_pair(spark, d))))


@query("spectral_lag_with_errors")
def _(spark, d):
    from burstframe.operators import temporal as T
    from burstframe.plans.temporal_queries import lag_pair

    return T.spectral_lag(lag_pair(spark, d))


@query("spectral_lag_windowed_variant")
def _(spark, d):
    from burstframe.operators import temporal as T

    pair = keep(T.prepare_lag_pair(V.lightcurves_dense_pair(spark, d), "view", "click", -14.0, 16.0, center=False))
    ccf = keep(T.cross_correlation(pair).join(T.cross_correlation_errors(pair), ["burst_id", "lag"]))
    return T.fit_lag(ccf, window=(-1000, 2000)).join(T.fine_grid_lag(ccf), "burst_id", "left")
