"""Queries over rule-based classification."""

from __future__ import annotations

from pyspark.sql import functions as F

from burstframe.operators import classify as C
from burstframe.operators.spectra import choose_model
from burstframe.plans.registry import query, r6
from burstframe.plans.spectral_queries import fit_params
from burstframe.sources import views as V


@query("class_by_duration", "bursts", """
SELECT burst_id, CASE WHEN t90 < 2 THEN 'Short' WHEN t90 < 50 THEN 'Long' ELSE 'Ultra-long' END AS duration_class,
       CASE WHEN t90 < 2 THEN 'Short' WHEN t90 < 10000 THEN 'Long' ELSE 'Ultra-long' END AS hardness_class FROM bursts""")
def _(spark, d):
    return V.bursts(spark, d).select(
        "burst_id", C.by_duration(F.col("t90"), 50.0).alias("duration_class"),
        C.by_hardness(F.col("hr_ratio"), F.col("t90")).alias("hardness_class"))


@query("extended_emission", "lightcurves", """
WITH n AS (SELECT *, count(*) OVER (PARTITION BY burst_id, band) AS n FROM lightcurves),
m AS (SELECT burst_id, band, n, avg(rate) FILTER (WHERE bin_idx < n // 3) AS e,
        avg(rate) FILTER (WHERE bin_idx >= n // 3 AND bin_idx < 2 * n // 3) AS m, avg(rate) FILTER (WHERE bin_idx >= 2 * n // 3) AS l
      FROM n GROUP BY 1, 2, 3)
SELECT burst_id, band, coalesce(n >= 5 AND n // 3 >= 2 AND 2 * n // 3 >= 3 AND e > 0 AND l > 0 AND l / e > 0.01
       AND l / e < 0.3 AND m < e, false) AS has_extended_emission FROM m""")
def _(spark, d):
    return C.extended_emission(V.lightcurves(spark, d), ["burst_id", "band"])


FULL_SQL = """
WITH i AS (SELECT burst_id, t90, hr_ratio, redshift, epeak * (1 + coalesce(redshift, 1)) AS ep, burst_id % 5 = 0 AS plateau,
             burst_id % 7 = 0 AS ee, burst_id % 6 = 0 AS sn_in, burst_id % 4 = 0 AS kn_in, burst_id % 3 = 0 AS weak,
             0.2e0 + (burst_id % 10) / 10e0 AS di,
             CASE WHEN t90 < 2 THEN 'Short' WHEN t90 < 10000 THEN 'Long' ELSE 'Ultra-long' END AS c FROM bursts),
m AS (SELECT *, (c = 'Long')::INT + plateau::INT + (ep < 200)::INT + (coalesce(redshift, 10) < 2)::INT >= 2 AS sn,
        (c = 'Short')::INT + ee::INT + (ep < 100)::INT + weak::INT >= 2 AS kn,
        2 * plateau::INT + (di < 0.5)::INT - (c <> 'Long')::INT >= 2 AS mag,
        2 * (c = 'Long')::INT + 2 * sn_in::INT + (coalesce(redshift, 10) < 3)::INT + (ep < 150)::INT >= 2 AS col,
        2 * (c = 'Short')::INT + 2 * kn_in::INT + ee::INT + (c = 'Short' AND ep > 200)::INT >= 2 AS mer FROM i)
SELECT burst_id, c AS duration_class, sn AS supernova_markers, kn AS kilonova_markers, mag AS magnetar_candidate, col AS collapsar,
  mer AS compact_merger,
  CASE WHEN sn::INT + kn::INT + mag::INT + col::INT + mer::INT > 1 THEN 0.8e0
       WHEN sn::INT + kn::INT + mag::INT + col::INT + mer::INT = 1 THEN 1e0 ELSE 0.6e0 END AS confidence,
  CASE WHEN mer THEN 'Compact object merger (NS-NS or NS-BH)' WHEN mag THEN 'Magnetar-powered jet'
       WHEN col THEN 'Massive star core collapse' WHEN c = 'Short' THEN 'Compact object merger (likely)'
       WHEN c = 'Long' THEN 'Massive star core collapse (likely)' ELSE 'Unknown' END AS best_progenitor FROM m"""


def classification_input(spark, d):
    k = F.col("burst_id")
    return V.bursts(spark, d).select(
        "burst_id", "t90", F.col("hr_ratio").alias("hardness_ratio"), "redshift",
        (F.col("epeak") * (F.coalesce("redshift", F.lit(1.0)) + 1)).alias("epeak_rest"), (k % 5 == 0).alias("has_plateau"),
        (k % 7 == 0).alias("has_extended_emission"), (k % 6 == 0).alias("supernova_association"),
        (k % 4 == 0).alias("kilonova_association"), (k % 3 == 0).alias("weak_afterglow"),
        (F.lit(0.2) + (k % 10) / 10.0).alias("decay_index"))


@query("full_classification", "bursts", FULL_SQL)
def _(spark, d):
    return C.full_classification(classification_input(spark, d)).select(
        "burst_id", "duration_class", "supernova_markers", "kilonova_markers", "magnetar_candidate", "collapsar",
        "compact_merger", "confidence", "best_progenitor")


@query("model_choice_by_aic", "fit_params", """
WITH f AS (SELECT burst_id % 97 AS g, burst_id, model, aic, fit_success FROM fit_params)
SELECT g AS burst_id, coalesce(arg_min(model, {'a': aic, 'o': burst_id}) FILTER (WHERE fit_success), arg_min(model, burst_id)) AS model,
       coalesce(arg_min(burst_id, {'a': aic, 'o': burst_id}) FILTER (WHERE fit_success), min(burst_id)) AS fit_order
FROM f GROUP BY 1""")
def _(spark, d):
    f = fit_params(spark, d).select((F.col("burst_id") % 97).alias("burst_id"), F.col("burst_id").alias("fit_order"),
                                    "model", "aic", "fit_success")
    return choose_model(f).select("burst_id", "model", "fit_order")
