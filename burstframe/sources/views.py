"""Astronomy views over the driver tables, as DataFrames and as the same SQL text for DuckDB.

One day of ``events`` plays one second, orders play afterglow points, line items play count
spectra, customers play the burst catalog.  Every view covers its whole base table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from burstframe.operators.lightcurve import bin_events
from burstframe.operators.reuse import keep


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def micros(ts: str, origin: str) -> Column:
    return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'{origin}', {ts})").cast("double")


def photons(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("burst_id"),
        F.col("event_type").alias("band"),
        (micros("ts", "2024-01-15 00:00:00") / F.lit(86400e6)).alias("t"),
        F.col("value").alias("energy"),
    )


def photons_dense(spark, sf_dir):
    return photons(spark, sf_dir).select(F.col("band").alias("burst_id"), F.lit("all").alias("band"), "t", "energy")


def lightcurves(spark, sf_dir):
    return keep(bin_events(photons(spark, sf_dir)))


def lightcurves_dense(spark, sf_dir):
    return keep(bin_events(photons_dense(spark, sf_dir), binsize=0.25))


def lightcurves_dense_pair(spark, sf_dir):
    """The dense series as bands of one burst."""
    return lightcurves_dense(spark, sf_dir).select(
        F.lit("all").alias("burst_id"), F.col("burst_id").alias("band"), "bin_idx", "t", "rate", "rate_err", "binsize")


def afterglow_points(spark, sf_dir):
    days = F.floor(micros("o_orderdate", "1995-01-01 00:00:00") / F.lit(86400e6)).cast("double")
    return (
        table(spark, sf_dir, "orders")
        .select(F.col("o_custkey").alias("burst_id"), (days + F.lit(1.0)).alias("t"), "o_totalprice")
        .groupBy("burst_id", "t")
        .agg(F.avg("o_totalprice").alias("flux"))
        .withColumn("flux_err", F.col("flux") * F.lit(0.1))
    )


def spectra(spark, sf_dir):
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_suppkey").alias("burst_id"), (F.col("l_quantity") * F.lit(10.0)).alias("energy"))
        .agg(F.count(F.lit(1)).cast("double").alias("counts"))
        .withColumn("exposure", F.lit(1.0))
        .withColumn("area", F.lit(1.0))
    )


def bursts(spark, sf_dir):
    k = F.col("c_custkey")
    kd = k.cast("double")
    return table(spark, sf_dir, "customer").select(
        k.alias("burst_id"),
        F.col("c_name").alias("burst_name"),
        (kd * F.lit(97.4137) % F.lit(360.0)).alias("ra"),
        F.degrees(F.asin(F.lit(2.0) * (kd * F.lit(0.618034) % F.lit(1.0)) - F.lit(1.0))).alias("dec"),
        F.when(k % 3 != 0, F.lit(0.1) + (k % 50) / F.lit(10.0)).alias("redshift"),
        F.pow(F.lit(10.0), F.col("c_acctbal") / F.lit(4000.0) - F.lit(0.5)).alias("t90"),
        F.col("c_mktsegment").alias("mission"),
        (F.lit(59000.0) + kd * F.lit(0.75)).alias("trigger_time"),
        F.pow(F.lit(10.0), F.lit(1.5) + (k % 17) / F.lit(10.0)).alias("epeak"),
        F.pow(F.lit(10.0), F.lit(50.0) + (k % 41) / F.lit(10.0)).alias("eiso"),
        F.pow(F.lit(10.0), F.lit(49.5) + (k % 37) / F.lit(10.0)).alias("lpeak"),
        F.pow(F.lit(10.0), (k % 23) / F.lit(20.0) - F.lit(0.5)).alias("hr_ratio"),
        F.col("c_nationkey").alias("site"),
    )


# The same views for DuckDB.  Dependencies are listed so that an oracle names only what it uses.
DUCK_VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "photons": ((), """
        SELECT user_id AS burst_id, event_type AS band,
               (epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-15 00:00:00'))::DOUBLE / 86400e6 AS t,
               value AS energy
        FROM events"""),
    "photons_dense": (("photons",), "SELECT band AS burst_id, 'all' AS band, t, energy FROM photons"),
    "afterglow_points": ((), """
        SELECT burst_id, t, flux, flux * 0.1::DOUBLE AS flux_err FROM (
          SELECT o_custkey AS burst_id,
                 floor((epoch_us(o_orderdate) - epoch_us(TIMESTAMP '1995-01-01'))::DOUBLE / 86400e6) + 1e0 AS t,
                 avg(o_totalprice) AS flux
          FROM orders GROUP BY 1, 2)"""),
    "spectra": ((), """
        SELECT l_suppkey AS burst_id, l_quantity * 10e0 AS energy, count(*)::DOUBLE AS counts,
               1e0 AS exposure, 1e0 AS area
        FROM lineitem GROUP BY 1, 2"""),
    "bursts": ((), """
        SELECT c_custkey AS burst_id, c_name AS burst_name,
               (c_custkey::DOUBLE * 97.4137e0) % 360e0 AS ra,
               degrees(asin(2e0 * ((c_custkey::DOUBLE * 0.618034e0) % 1e0) - 1e0)) AS dec,
               CASE WHEN c_custkey % 3 <> 0 THEN 0.1e0 + (c_custkey % 50) / 10e0 END AS redshift,
               pow(10e0, c_acctbal / 4000e0 - 0.5e0) AS t90,
               c_mktsegment AS mission,
               59000e0 + c_custkey::DOUBLE * 0.75e0 AS trigger_time,
               pow(10e0, 1.5e0 + (c_custkey % 17) / 10e0) AS epeak,
               pow(10e0, 50e0 + (c_custkey % 41) / 10e0) AS eiso,
               pow(10e0, 49.5e0 + (c_custkey % 37) / 10e0) AS lpeak,
               pow(10e0, (c_custkey % 23) / 20e0 - 0.5e0) AS hr_ratio,
               c_nationkey AS site
        FROM customer"""),
}


def duck_binned(source: str, binsize: float) -> str:
    """DuckDB text of the dense event histogram."""
    b = f"{binsize!r}::DOUBLE"
    return f"""
        SELECT g.burst_id, g.band, g.i AS bin_idx,
               ((g.t0 + g.i * {b}) + (g.t0 + (g.i + 1) * {b})) / 2 AS t,
               coalesce(c.n, 0) / {b} AS rate, sqrt(coalesce(c.n, 0)::DOUBLE) / {b} AS rate_err,
               coalesce(c.n, 0)::BIGINT AS counts, {b} AS binsize
        FROM (SELECT burst_id, band, t0, unnest(range(nb)) AS i FROM
                (SELECT burst_id, band, floor(min(t)) AS t0,
                        ceil((ceil(max(t)) - floor(min(t))) / {b})::BIGINT AS nb
                 FROM {source} GROUP BY 1, 2)) g
        LEFT JOIN (
          SELECT p.burst_id, p.band, least(floor((p.t - s.t0) / {b})::BIGINT, s.nb - 1) AS i, count(*) AS n
          FROM {source} p JOIN (SELECT burst_id, band, floor(min(t)) AS t0,
                        ceil((ceil(max(t)) - floor(min(t))) / {b})::BIGINT AS nb
                 FROM {source} GROUP BY 1, 2) s ON p.burst_id = s.burst_id AND p.band = s.band
          GROUP BY 1, 2, 3) c
        ON g.burst_id = c.burst_id AND g.band = c.band AND g.i = c.i"""


DUCK_VIEWS["lightcurves"] = (("photons",), duck_binned("photons", 1.0))
DUCK_VIEWS["lightcurves_dense"] = (("photons", "photons_dense"), duck_binned("photons_dense", 0.25))


def duck(views: str, body: str) -> str:
    """Prefix ``body`` with the CTEs it needs, in dependency order."""
    ordered: list[str] = []

    def need(name: str) -> None:
        for dep in DUCK_VIEWS[name][0]:
            need(dep)
        if name not in ordered:
            ordered.append(name)

    for v in views.split():
        need(v)
    body = body.strip()
    ctes = ", ".join(f"{n} AS ({DUCK_VIEWS[n][1]})" for n in ordered)
    if not ctes:
        return body
    if body.upper().startswith("WITH "):
        return f"WITH {ctes}, {body[5:]}"
    return f"WITH {ctes} {body}"
