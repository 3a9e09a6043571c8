"""Queries over stages and streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from burstframe.operators import catalog as C
from burstframe.plans import stages as G
from burstframe.plans.classification_queries import FULL_SQL
from burstframe.plans.circular_queries import archive
from burstframe.plans.population_queries import alerts, triggers
from burstframe.plans.registry import query, r6
from burstframe.plans.source_queries import scratch
from burstframe.plans.temporal_queries import duration_sql
from burstframe.sources import views as V
from burstframe.streaming import live


def inputs(spark, d):
    return {"bursts": V.bursts(spark, d), "photons": V.photons(spark, d), "spectra": V.spectra(spark, d),
            "afterglow_points": V.afterglow_points(spark, d)}


@query("stage_acquisition", "bursts photons spectra afterglow_points", """
SELECT burst_id, coalesce(p, 0) AS n_photons, coalesce(s, 0) AS n_spectra, coalesce(a, 0) AS n_afterglow_points FROM bursts
LEFT JOIN (SELECT burst_id, count(*) AS p FROM photons GROUP BY 1) USING (burst_id) LEFT JOIN (SELECT burst_id, count(*) AS s FROM spectra GROUP BY 1) USING (burst_id)
LEFT JOIN (SELECT burst_id, count(*) AS a FROM afterglow_points GROUP BY 1) USING (burst_id)""")
def _(spark, d):
    t = {**inputs(spark, d), "archive": archive(spark, d), "alerts": alerts(spark, d), "trigger_points": triggers(spark, d)}
    return G.acquisition(t)["metadata"]


@query("stage_temporal", "lightcurves", f"""WITH d AS ({duration_sql(0.9)}) SELECT d.burst_id, d.band, d.duration AS t90, peak_rate, fluence FROM d
JOIN (SELECT burst_id, band, max(rate) AS peak_rate, round(sum(rate * binsize), 6) AS fluence FROM lightcurves GROUP BY 1, 2) m USING (burst_id, band)""")
def _(spark, d):
    p = G.temporal(inputs(spark, d))["temporal_properties"]
    return p.select("burst_id", "band", r6("t90_duration").alias("t90"), "peak_rate", r6("fluence").alias("fluence"))


@query("stage_spectral")
def _(spark, d):
    return G.spectral(inputs(spark, d))["derived_quantities"]


@query("stage_afterglow")
def _(spark, d):
    return G.afterglow(inputs(spark, d))["afterglow_params"]


@query("stage_classification", "bursts", """
SELECT burst_id, CASE WHEN t90 < 2 THEN 'Short' WHEN t90 < 10000 THEN 'Long' ELSE 'Ultra-long' END AS duration_class FROM bursts""")
def _(spark, d):
    return G.classification({"bursts": V.bursts(spark, d)})["classification"].select("burst_id", "duration_class")


@query("stage_summary")
def _(spark, d):
    t, _status = G.run(spark, inputs(spark, d), ["acquisition", "classification", "summary"])
    return t["analysis_results"].select("burst_id", F.to_json("metadata").alias("metadata"), F.to_json("classification").alias("classification"))


@query("stage_selection_status", "", """
SELECT * FROM (VALUES ('acquisition', 'completed', ''), ('temporal', 'skipped', 'not requested'), ('spectral', 'skipped', 'missing input: spectra'),
  ('afterglow', 'skipped', 'not requested'), ('classification', 'completed', ''), ('summary', 'skipped', 'not requested')) v(stage, status, note)""")
def _(spark, d):
    t = inputs(spark, d)
    t.pop("spectra")
    return G.run(spark, t, ["acquisition", "spectral", "classification", "temporal"], skip=["temporal"])[1]


@query("batch_work_list", "bursts", """
WITH w AS (SELECT DISTINCT o_custkey AS burst_id FROM orders WHERE o_orderstatus = 'P')
SELECT burst_id, CASE WHEN t90 < 2 THEN 'Short' WHEN t90 < 10000 THEN 'Long' ELSE 'Ultra-long' END AS duration_class FROM bursts WHERE burst_id IN (SELECT burst_id FROM w)""")
def _(spark, d):
    work = V.table(spark, d, "orders").filter("o_orderstatus = 'P'").select(F.col("o_custkey").alias("burst_id"))
    t, _status = G.run(spark, {"bursts": V.bursts(spark, d)}, ["classification"], work_list=work)
    return t["classification"].select("burst_id", "duration_class")


@query("batch_status_counts", "bursts", """
SELECT CASE WHEN burst_id IN (SELECT o_custkey FROM orders) AND burst_id IN (SELECT l_suppkey FROM lineitem) THEN 'successful' ELSE 'failed' END AS status,
       count(*) AS count FROM bursts GROUP BY 1""")
def _(spark, d):
    made = {"afterglow_params": V.table(spark, d, "orders").select(F.col("o_custkey").alias("burst_id")),
            "model_comparison": V.table(spark, d, "lineitem").select(F.col("l_suppkey").alias("burst_id"))}
    return G.batch_status(V.bursts(spark, d), made)


@query("stage_resume", "", """SELECT 'completed' AS status, count(*) AS count FROM range(2) UNION ALL SELECT 'skipped', count(*) FROM range(4)""")
def _(spark, d):
    t = {"bursts": V.bursts(spark, d)}
    first, _status = G.run(spark, t, ["acquisition"])
    _, status = G.run_from(spark, t, "classification", first)
    return status.groupBy("status").agg(F.count(F.lit(1)).alias("count"))


@query("stage_resume_records", "bursts photons", """
SELECT burst_id, coalesce(n, 0) AS n_photons, CASE WHEN t90 < 2 THEN 'Short' WHEN t90 < 10000 THEN 'Long' ELSE 'Ultra-long' END AS duration_class
FROM bursts LEFT JOIN (SELECT burst_id, count(*) AS n FROM photons GROUP BY 1) USING (burst_id)""")
def _(spark, d):
    t = {"bursts": V.bursts(spark, d), "photons": V.photons(spark, d)}
    first, _status = G.run(spark, t, ["acquisition"])
    full, _status = G.run_from(spark, {"bursts": t["bursts"]}, "classification", first)
    return full["analysis_results"].select("burst_id", F.col("metadata.n_photons").alias("n_photons"), F.col("classification.duration_class").alias("duration_class"))


@query("live_light_curve", "", """
SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS t_start, user_id AS burst_id, event_type AS band, count(*) AS counts FROM events
WHERE date_trunc('day', ts) + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) - INTERVAL 2 DAY GROUP BY 1, 2, 3""")
def _(spark, d):
    src, out, ck = scratch(spark), scratch(spark), scratch(spark)
    e = V.table(spark, d, "events").select(F.col("ts").cast("timestamp").alias("ts"), F.col("user_id").alias("burst_id"), F.col("event_type").alias("band"))
    e.write.parquet(src)
    live.drain(live.live_light_curve(live.file_stream(spark, src, e.schema)), out, ck)
    return spark.read.parquet(out).select(F.col("t_start").cast("timestamp_ntz").alias("t_start"), "burst_id", "band", "counts")


@query("live_circulars", "archive", "SELECT 30000 + k AS circular_number FROM archive UNION ALL SELECT 60000 + k FROM archive")
def _(spark, d):
    src, out, ck = scratch(spark), scratch(spark), scratch(spark)
    a = archive(spark, d).select("event_code", "text", F.timestamp_seconds(F.col("k") % 1000 + 86400).alias("ts"))
    # every text arrives twice
    a.unionByName(a).write.parquet(src)
    live.drain(live.live_circulars(live.file_stream(spark, src, a.schema)), out, ck)
    return spark.read.parquet(out).select("circular_number")
