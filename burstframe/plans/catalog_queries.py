"""Queries over catalog tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from burstframe.operators import catalog as C
from burstframe.plans.registry import query, r6
from burstframe.schemas import BURST_CLASSES, MISSIONS
from burstframe.sources import views as V


def cat(spark, d):
    b = V.bursts(spark, d)
    return b.withColumn("classification", F.when(F.col("t90") < 2, "Short").otherwise("Long"))


V.DUCK_VIEWS["cat"] = (("bursts",), "SELECT *, CASE WHEN t90 < 2 THEN 'Short' ELSE 'Long' END AS classification FROM bursts")


def new_names(spark, d):
    """Insert batch: orders name their customer; every second customer name is replaced by an unseen one."""
    k = F.col("o_custkey")
    return V.table(spark, d, "orders").select(
        F.when(k % 2 == 0, F.concat(F.lit("New#"), k.cast("string"))).otherwise(F.concat(F.lit("Customer#"), F.lpad(k.cast("string"), 9, "0"))).alias("burst_name"),
        (F.lit(0.0) + k).alias("t90"))


@query("insert_unique", "bursts", """
WITH n AS (SELECT DISTINCT CASE WHEN o_custkey % 2 = 0 THEN 'New#' || o_custkey ELSE 'Customer#' || lpad(o_custkey::VARCHAR, 9, '0') END AS burst_name,
             o_custkey::DOUBLE AS t90 FROM orders)
SELECT burst_name, round(t90, 6) AS t90 FROM bursts UNION ALL SELECT burst_name, t90 FROM n WHERE burst_name NOT IN (SELECT burst_name FROM bursts)""")
def _(spark, d):
    table = V.bursts(spark, d).select("burst_name", "t90")
    after, _ = C.insert_unique(table, new_names(spark, d), "burst_name")
    return after.select("burst_name", r6("t90").alias("t90"))


@query("insert_rejected", "bursts", """
WITH n AS (SELECT CASE WHEN o_custkey % 2 = 0 THEN 'New#' || o_custkey ELSE 'Customer#' || lpad(o_custkey::VARCHAR, 9, '0') END AS burst_name FROM orders),
k AS (SELECT burst_name, burst_name IN (SELECT burst_name FROM bursts) AS known, row_number() OVER (PARTITION BY burst_name) AS i FROM n)
SELECT burst_name, CASE WHEN known THEN 'key exists' ELSE 'repeated in batch' END AS reason FROM k WHERE known OR i > 1""")
def _(spark, d):
    table = V.bursts(spark, d).select("burst_name", "t90")
    return C.insert_unique(table, new_names(spark, d), "burst_name")[1].select("burst_name", "reason")


@query("point_lookup", "bursts", "SELECT burst_id, burst_name, round(t90, 6) AS t90 FROM bursts WHERE burst_name = 'Customer#000000042'")
def _(spark, d):
    return C.lookup(V.bursts(spark, d), "burst_name", "Customer#000000042").select("burst_id", "burst_name", r6("t90").alias("t90"))


@query("update_by_key", "bursts", """
WITH u AS (SELECT o_custkey AS burst_id, max(o_totalprice) AS t90 FROM orders GROUP BY 1)
SELECT b.burst_id, round(CASE WHEN u.burst_id IS NOT NULL THEN u.t90 ELSE b.t90 END, 6) AS t90, mission FROM bursts b LEFT JOIN u USING (burst_id)""")
def _(spark, d):
    upd = V.table(spark, d, "orders").groupBy(F.col("o_custkey").alias("burst_id")).agg(F.max("o_totalprice").alias("t90"))
    return C.update_by_key(V.bursts(spark, d).select("burst_id", "t90", "mission"), upd, "burst_id").select("burst_id", r6("t90").alias("t90"), "mission")


def delete_case(spark, d, cascade):
    tables = {"bursts": V.bursts(spark, d).select("burst_id"),
              "observations": V.table(spark, d, "orders").select(F.col("o_custkey").alias("burst_id"), "o_orderkey")}
    gone = V.table(spark, d, "orders").filter("o_orderstatus = 'P'").groupBy(F.col("o_custkey").alias("burst_id")).agg(
        F.count(F.lit(1)).alias("n")).filter("n >= 5")
    out = C.delete_by_key(tables, "bursts", gone, "burst_id", cascade)
    return out["bursts"].select("burst_id", F.lit("bursts").alias("table")).unionByName(
        out["observations"].select("burst_id", F.lit("observations").alias("table"))).groupBy("burst_id", "table").agg(F.count(F.lit(1)).alias("n"))


DELETE_SQL = """
WITH g AS (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P' GROUP BY 1 HAVING count(*) >= 5)
SELECT burst_id, 'bursts' AS "table", count(*) AS n FROM bursts WHERE burst_id NOT IN (SELECT o_custkey FROM g) GROUP BY 1
UNION ALL SELECT o_custkey AS burst_id, 'observations' AS "table", count(*) AS n FROM orders {w} GROUP BY 1"""


@query("delete_by_key", "bursts", DELETE_SQL.format(w=""))
def _(spark, d):
    return delete_case(spark, d, False)


@query("delete_by_key_cascading", "bursts", DELETE_SQL.format(w="WHERE o_custkey NOT IN (SELECT o_custkey FROM g)"))
def _(spark, d):
    return delete_case(spark, d, True)


@query("observation_rows", "", """
SELECT o_orderkey AS obs_id, o_custkey AS burst_id, o_orderpriority AS instrument FROM orders WHERE o_custkey = 42
UNION ALL SELECT l_orderkey AS obs_id, l_suppkey AS burst_id, 'BAT' AS instrument FROM lineitem WHERE l_suppkey = 42""")
def _(spark, d):
    obs = V.table(spark, d, "orders").select(F.col("o_orderkey").alias("obs_id"), F.col("o_custkey").alias("burst_id"), F.col("o_orderpriority").alias("instrument"))
    new = V.table(spark, d, "lineitem").select(F.col("l_orderkey").alias("obs_id"), F.col("l_suppkey").alias("burst_id"), F.lit("BAT").alias("instrument"))
    return C.lookup(C.append(obs, new), "burst_id", 42)


@query("spectral_fit_storage", "", """
SELECT o_orderkey AS fit_id, CASE WHEN o_orderkey % 4 = 0 THEN 'Band' ELSE 'CPL' END AS model, o_totalprice AS epeak, (o_orderkey % 9) / -10e0 AS alpha FROM orders""")
def _(spark, d):
    k = F.col("o_orderkey")
    fits = V.table(spark, d, "orders").select(
        k.alias("fit_id"), F.when(k % 4 != 0, F.lit("CPL")).alias("model"),
        F.create_map(F.lit("epeak"), F.col("o_totalprice"), F.lit("alpha"), (k % 9) / F.lit(-10.0)).alias("params"),
        F.create_map(F.lit("epeak"), F.lit(1.0)).alias("errors"))
    back = C.fits_from_storage(C.fits_to_storage(fits))
    return back.select("fit_id", "model", F.col("params")["epeak"].alias("epeak"), F.col("params")["alpha"].alias("alpha"))


@query("lightcurve_summary", "lightcurves", """
SELECT burst_id, band, min(t) AS time_start, max(t) AS time_end, round(avg(rate), 6) AS rate, round(avg(rate_err), 6) AS rate_err, max(binsize) AS binsize
FROM lightcurves GROUP BY 1, 2""")
def _(spark, d):
    return C.lightcurve_summary(V.lightcurves(spark, d), ["burst_id", "band"]).withColumns({"rate": r6("rate"), "rate_err": r6("rate_err")})


@query("afterglow_and_flux_rows", "", """
SELECT o_custkey AS burst_id, o_orderkey AS row_id, o_totalprice AS flux, o_orderkey % 2 = 0 AS is_upper_limit FROM orders WHERE o_custkey = 7""")
def _(spark, d):
    f = V.table(spark, d, "orders").select(F.col("o_custkey").alias("burst_id"), F.col("o_orderkey").alias("row_id"),
                                           F.col("o_totalprice").alias("flux"), (F.col("o_orderkey") % 2 == 0).alias("is_upper_limit"))
    return C.lookup(C.append(f.limit(0), f), "burst_id", 7)


@query("circular_insert", "", """
SELECT o_orderkey AS circular_number, o_totalprice AS extracted_ra, -o_totalprice AS extracted_dec FROM orders""")
def _(spark, d):
    new = V.table(spark, d, "orders").select(
        F.col("o_orderkey").alias("circular_number"), F.struct(F.col("o_totalprice").alias("ra"), (-F.col("o_totalprice")).alias("dec")).alias("pos"))
    flat = new.select("circular_number", F.col("pos.ra").alias("extracted_ra"), F.col("pos.dec").alias("extracted_dec"))
    return C.insert_unique(flat.limit(0), flat, "circular_number")[0]


@query("all_bursts_newest_first", "bursts", "SELECT burst_id, trigger_time FROM bursts ORDER BY trigger_time DESC")
def _(spark, d):
    return C.newest_first(V.bursts(spark, d)).select("burst_id", "trigger_time")


@query("bursts_by_class", "cat", "SELECT burst_id, classification FROM cat WHERE classification = 'Short' ORDER BY trigger_time DESC")
def _(spark, d):
    return C.by_class(cat(spark, d), "Short").select("burst_id", "classification")


@query("bursts_with_redshift", "bursts", "SELECT burst_id, redshift FROM bursts WHERE redshift IS NOT NULL ORDER BY redshift DESC")
def _(spark, d):
    return C.with_redshift(V.bursts(spark, d)).select("burst_id", "redshift")


@query("burst_count", "bursts", "SELECT count(*) AS n FROM bursts")
def _(spark, d):
    return V.bursts(spark, d).agg(F.count(F.lit(1)).alias("n"))


@query("catalog_listing", "cat", """
SELECT * FROM (SELECT 'time' AS listing, burst_name, classification FROM cat ORDER BY trigger_time DESC, burst_name LIMIT 50)
UNION ALL SELECT * FROM (SELECT 'name' AS listing, burst_name, classification FROM cat ORDER BY burst_name LIMIT 50)
UNION ALL SELECT * FROM (SELECT 'type' AS listing, burst_name, classification FROM cat ORDER BY classification, burst_name LIMIT 50)""")
def _(spark, d):
    c = cat(spark, d)
    out = None
    for label, sort in (("time", "timestamp"), ("name", "name"), ("type", "type")):
        one = C.listing(c, sort).select(F.lit(label).alias("listing"), "burst_name", "classification")
        out = one if out is None else out.unionByName(one)
    return out


@query("enum_normalisation", "", """
WITH v AS (SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN 'swift' WHEN 1 THEN 'Fermi' WHEN 2 THEN 'xmm' WHEN 3 THEN 'nonsense' ELSE 'XMM-Newton' END AS m,
             CASE o_orderkey % 3 WHEN 0 THEN 'ultra_long' WHEN 1 THEN 'Short' ELSE o_orderstatus END AS c FROM orders)
SELECT o_orderkey, CASE m WHEN 'swift' THEN 'Swift' WHEN 'Fermi' THEN 'Fermi' WHEN 'nonsense' THEN 'Swift' ELSE 'XMM-Newton' END AS mission,
       CASE c WHEN 'ultra_long' THEN 'Ultra-long' WHEN 'Short' THEN 'Short' ELSE 'Long' END AS class FROM v""")
def _(spark, d):
    k = F.col("o_orderkey")
    m = (F.when(k % 5 == 0, "swift").when(k % 5 == 1, "Fermi").when(k % 5 == 2, "xmm").when(k % 5 == 3, "nonsense").otherwise("XMM-Newton"))
    c = F.when(k % 3 == 0, "ultra_long").when(k % 3 == 1, "Short").otherwise(F.col("o_orderstatus"))
    return V.table(spark, d, "orders").select("o_orderkey", C.normalise_enum(m, MISSIONS, "Swift").alias("mission"),
                                              C.normalise_enum(c, BURST_CLASSES, "Long").alias("class"))


@query("record_round_trip", "bursts", "SELECT burst_id, burst_name, round(ra, 6) AS ra, redshift, mission FROM bursts")
def _(spark, d):
    b = V.bursts(spark, d).select("burst_id", "burst_name", "ra", "redshift", "mission")
    js = b.select(F.to_json(F.struct("*", F.lit(1).alias("unknown_field"))).alias("j"))
    return js.select(F.from_json("j", b.schema).alias("r")).select("r.*").withColumn("ra", r6("ra"))


@query("completion_status", "bursts", """
SELECT burst_id, burst_id IN (SELECT user_id FROM events) AS temporal, burst_id IN (SELECT o_custkey FROM orders) AS afterglow,
       burst_id IN (SELECT l_suppkey FROM lineitem) AS spectral FROM bursts""")
def _(spark, d):
    s = C.completion_status(V.bursts(spark, d), {
        "temporal": V.photons(spark, d), "afterglow": V.table(spark, d, "orders").select(F.col("o_custkey").alias("burst_id")),
        "spectral": V.table(spark, d, "lineitem").select(F.col("l_suppkey").alias("burst_id"))})
    return s.select("burst_id", *[F.col("stages")[n].alias(n) for n in ("temporal", "afterglow", "spectral")])


@query("resume_missing_bursts", "bursts", "SELECT burst_id FROM bursts WHERE burst_id NOT IN (SELECT l_suppkey FROM lineitem)")
def _(spark, d):
    done = V.table(spark, d, "lineitem").select(F.col("l_suppkey").alias("burst_id"))
    return C.missing_results(V.bursts(spark, d).select("burst_id"), done)


@query("t90_range", "bursts", "SELECT burst_id, round(t90, 6) AS t90 FROM bursts WHERE t90 BETWEEN 1 AND 10")
def _(spark, d):
    return C.t90_between(V.bursts(spark, d), 1.0, 10.0).select("burst_id", r6("t90").alias("t90"))


@query("unknown_name_check", "bursts", """
SELECT DISTINCT event_type AS name FROM events WHERE event_type NOT IN (SELECT lower(mission) FROM bursts)""")
def _(spark, d):
    req = V.table(spark, d, "events").select(F.col("event_type").alias("name"))
    return C.unknown_names(req, V.bursts(spark, d).select(F.lower("mission").alias("name")), "name")
