"""Queries over scans and sinks.  Files are written from the driver tables first, then scanned back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from burstframe.plans.registry import query, r6
from burstframe.plans.spectral_queries import xrt
from burstframe.session import ensure_checkpoint_dir
from burstframe.sources import scans as S
from burstframe.sources import sinks as K
from burstframe.sources import views as V


def scratch(spark) -> str:
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/files-{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"


# per burst and whole second: counts and their error in four energy quarters
V.DUCK_VIEWS["quad"] = (("photons",), """
    SELECT burst_id, floor(t) AS t, """ + ", ".join(
        f"count(*) FILTER (WHERE floor(energy / 125) {'>=' if i == 3 else '='} {i})::DOUBLE AS r{i}" for i in range(4)) + " FROM photons GROUP BY 1, 2")


def quad(spark, d):
    q = F.floor(F.col("energy") / 125)
    return V.photons(spark, d).groupBy("burst_id", F.floor("t").cast("double").alias("t")).agg(
        *[F.sum(((q >= 3) if i == 3 else (q == i)).cast("double")).alias(f"r{i}") for i in range(4)])


def quad_files(spark, d, tag):
    path = scratch(spark)
    cols = [F.col("t"), *[c for i in range(4) for c in (F.col(f"r{i}"), F.sqrt(f"r{i}"))]]
    line = F.concat(F.lit("  "), F.concat_ws("   ", *[c.cast("string") for c in cols]))
    name = F.concat(F.lit("GRB"), F.lpad(F.col("burst_id").cast("string"), 6, "0"), F.lit("A"), F.lit(tag))
    rows = quad(spark, d).select(name.alias("file"), line.alias("value"))
    # the count is explicit: a file costs far more than its rows, and AQE would merge the small partitions into one task
    rows.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "file").write.partitionBy("file").text(path)
    return path


BANDS = [("15-25", 0), ("25-50", 1), ("50-100", 2), ("100-350", 3)]
QUAD_ROWS = " UNION ALL ".join(
    f"SELECT 'GRB' || lpad(burst_id::VARCHAR, 6, '0') || 'A' AS burst_name, '{b}' AS band, t, r{i} AS rate, round(sqrt(r{i}), 6) AS rate_err, burst_id FROM quad"
    for b, i in BANDS)


@query("four_band_ascii_scan", "quad", f"SELECT burst_name, band, t, rate, rate_err, 0.064::DOUBLE AS binsize FROM ({QUAD_ROWS})")
def _(spark, d):
    rows, _bad = S.four_band_light_curves(spark, quad_files(spark, d, "_64ms_lc"))
    return rows.select("burst_name", "band", "t", "rate", r6("rate_err").alias("rate_err"), "binsize")


@query("four_band_scan_median_step", "quad", f"""
WITH s AS (SELECT burst_id, coalesce(median(dt) FILTER (WHERE dt > 0), 1) AS b FROM
  (SELECT burst_id, t - lag(t) OVER (PARTITION BY burst_id ORDER BY t) AS dt FROM quad) GROUP BY 1)
SELECT burst_name, band, count(*) AS n, max(b) AS binsize FROM ({QUAD_ROWS}) JOIN s USING (burst_id) GROUP BY 1, 2""")
def _(spark, d):
    rows, _bad = S.four_band_light_curves(spark, quad_files(spark, d, "_lc"))
    return rows.groupBy("burst_name", "band").agg(F.count(F.lit(1)).alias("n"), F.max("binsize").alias("binsize"))


def xrt_files(spark, d):
    """Flux density and photon index as two text files; the burst sits in the folder name by its leading digit."""
    x = xrt(spark, d).withColumn("burst", F.concat(F.lit("b"), F.substring(F.col("burst_id").cast("string"), 1, 1)))
    t = F.col("t") + F.col("burst_id") / 10000
    flux, index = scratch(spark), scratch(spark)
    text = lambda *c: F.concat_ws(" ", *[v.cast("string") for v in c])
    one, half = F.lit(1.0), F.lit(0.5)
    x.select("burst", text(t, one, half, F.col("flux"), F.col("err_pos"), F.col("err_neg")).alias("value")).repartition("burst").write.partitionBy("burst").text(flux)
    x.select("burst", text(t, one, half, F.col("gamma"), F.lit(0.1), F.lit(0.2)).alias("value")).repartition("burst").write.partitionBy("burst").text(index)
    return flux, index


XRT_SQL = """SELECT 'b' || substr(burst_id::VARCHAR, 1, 1) AS burst_id, round(t + burst_id / 10000, 6) AS time, 0.5::DOUBLE AS terr_n, 1e0 AS terr_p,
  round(flux * k, 4) AS "Fd", round(err_neg * k, 4) AS "Fd_n", round(err_pos * k, 4) AS "Fd_p" FROM (SELECT *, pow(10e0, gamma - 1) * pow(1e0, 1 - gamma) AS k FROM xrt)"""


@query("paired_flux_index_scan_and_conversion", "xrt", XRT_SQL)
def _(spark, d):
    flux, index = xrt_files(spark, d)
    c = K.converted_flux(S.paired_flux_and_index(spark, flux, index), 1.0)
    return c.select("burst_id", r6("time").alias("time"), "terr_n", "terr_p", *[r6(n, 4).alias(n) for n in ("Fd", "Fd_n", "Fd_p")])


@query("converted_flux_sink", "xrt", "SELECT count(*) AS n, 6 AS n_columns FROM xrt")
def _(spark, d):
    flux, index = xrt_files(spark, d)
    out = scratch(spark)
    K.save_converted(S.paired_flux_and_index(spark, flux, index), 1.0, out)
    back = spark.read.csv(out, sep=" ", header=True)
    return back.agg(F.count(F.lit(1)).alias("n"), F.lit(len(back.columns)).alias("n_columns"))


@query("light_curve_columns", "", """
SELECT event_id, value::FLOAT::DOUBLE AS rate, round(sqrt(abs(value::FLOAT::DOUBLE)), 6) AS rate_err FROM events""")
def _(spark, d):
    e = V.table(spark, d, "events").select("event_id", F.unix_micros(F.col("ts").cast("timestamp")).cast("double").alias("Time"), F.col("value").alias("rAtE"))
    return S.light_curve_columns(e, keys=["event_id"]).select("event_id", "rate", r6("rate_err").alias("rate_err"))


@query("spectrum_columns", "spectra", """
SELECT burst_id, energy, counts, coalesce(energy - lag(energy) OVER (PARTITION BY burst_id ORDER BY energy), 0) AS energy_err FROM spectra""")
def _(spark, d):
    s = V.spectra(spark, d).select("burst_id", F.col("energy").alias("Energy"), F.col("counts").alias("COUNTS"))
    return S.spectrum_columns(s, ["burst_id"])


@query("column_projection", "", "SELECT l_orderkey, l_quantity FROM lineitem")
def _(spark, d):
    return S.project(V.table(spark, d, "lineitem"), ["L_ORDERKEY", "l_Quantity", "missing"])[0]


V.DUCK_VIEWS["headers"] = ((), """
    SELECT o_orderkey AS file, 1 AS hdu, 'RA_OBJ' AS keyword, CASE WHEN o_orderkey % 4 <> 0 THEN ((o_orderkey % 360) / 1)::BIGINT::VARCHAR END AS value FROM orders
    UNION ALL SELECT o_orderkey, 1, 'Dec_Obj', (o_orderkey % 90)::VARCHAR FROM orders
    UNION ALL SELECT o_orderkey, 1, 'CIRCLE_R', (o_orderkey % 3)::VARCHAR FROM orders
    UNION ALL SELECT o_orderkey, 2, 'TELESCOP', o_orderpriority FROM orders
    UNION ALL SELECT o_orderkey, 0, 'TELESCOP', CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus END FROM orders""")


def headers(spark, d):
    k = F.col("o_orderkey")
    s = lambda c: c.cast("string")
    rows = F.array(*[F.struct(F.lit(h).alias("hdu"), F.lit(n).alias("keyword"), v.alias("value")) for h, n, v in (
        (1, "RA_OBJ", F.when(k % 4 != 0, s(k % 360))), (1, "Dec_Obj", s(k % 90)), (1, "CIRCLE_R", s(k % 3)), (2, "TELESCOP", F.col("o_orderpriority")),
        (0, "TELESCOP", F.when(k % 2 == 0, F.col("o_orderstatus"))))])
    return V.table(spark, d, "orders").select(k.alias("file"), F.inline(rows))


@query("header_positions", "headers", """
SELECT file, max(value::DOUBLE) FILTER (WHERE upper(keyword) = 'RA_OBJ') AS ra, max(value::DOUBLE) FILTER (WHERE upper(keyword) = 'DEC_OBJ') AS dec,
  coalesce(nullif(max(value::DOUBLE) FILTER (WHERE upper(keyword) = 'CIRCLE_R'), 0), 10) AS error_radius
FROM headers WHERE keyword <> 'TELESCOP' GROUP BY 1 HAVING max(value::DOUBLE) FILTER (WHERE upper(keyword) = 'RA_OBJ') IS NOT NULL""")
def _(spark, d):
    return S.header_positions(headers(spark, d), "file")


@query("header_value_first_unit", "headers", """
SELECT file, arg_min(value, hdu) AS value FROM headers WHERE keyword = 'TELESCOP' AND value IS NOT NULL GROUP BY 1""")
def _(spark, d):
    return S.header_value(headers(spark, d), "file", "telescop")


@query("header_keyword", "headers", "SELECT file, value FROM headers WHERE keyword = 'Dec_Obj' AND hdu = 1")
def _(spark, d):
    return S.header_value(headers(spark, d), "file", "DEC_OBJ", 1)


@query("header_fields_with_defaults", "headers", """
SELECT file, coalesce(max(value) FILTER (WHERE keyword = 'TELESCOP'), '') AS telescop, '' AS instrume FROM headers GROUP BY 1""")
def _(spark, d):
    return S.header_struct(headers(spark, d), "file").select("file", "telescop", "instrume")


# Product file names: one per item line
V.DUCK_VIEWS["product_files"] = ((), """
    SELECT 'glg_' || CASE l_linenumber % 3 WHEN 0 THEN 'tte' WHEN 1 THEN 'cspec' ELSE 'trigdat' END || '_n' || (l_suppkey % 10) || '_bn' ||
      lpad((l_orderkey % 1000000000)::VARCHAR, 9, '0') || '_v0' || l_linenumber || '.fit' AS name, l_orderkey AS event FROM lineitem""")


def product_files(spark, d):
    kind = F.when(F.col("l_linenumber") % 3 == 0, "tte").when(F.col("l_linenumber") % 3 == 1, "cspec").otherwise("trigdat")
    det = F.concat(F.lit("n"), (F.col("l_suppkey") % 10).cast("string"))
    name = F.concat(F.lit("glg_"), kind, F.lit("_"), det, F.lit("_bn"), F.lpad(F.col("l_orderkey").cast("string"), 9, "0"), F.lit("_v0"),
                    F.col("l_linenumber").cast("string"), F.lit(".fit"))
    return V.table(spark, d, "lineitem").select(name.alias("name"), name.alias("path"), F.col("l_orderkey").alias("event"), kind.alias("kind"), det.alias("det"))


@query("trigger_metadata", "product_files bursts", """
SELECT name AS path, nullif(regexp_extract(name, 'bn(\\d{9})', 1), '') AS trigger_id, ra FROM
  (SELECT name, any_value(event) AS event FROM product_files GROUP BY 1) LEFT JOIN (SELECT burst_id, round(ra, 9) AS ra FROM bursts) b ON b.burst_id = event""")
def _(spark, d):
    files = product_files(spark, d).select("path", F.col("event").alias("burst_id")).distinct()
    pos = files.join(V.bursts(spark, d).select("burst_id", r6("ra", 9).alias("ra")), "burst_id").select("path", "ra")
    return S.trigger_info(files, pos).select("path", "trigger_id", "ra")


@query("file_filter", "product_files", "SELECT name FROM product_files WHERE name LIKE '%tte%' AND contains(name, '_n3_')")
def _(spark, d):
    return S.find_files(product_files(spark, d), "tte", "n3").select("name")


@query("file_accept_patterns", "product_files", "SELECT name FROM product_files WHERE name LIKE 'glg!_cspec!_%!_bn000000042!_%.fit%' ESCAPE '!'")
def _(spark, d):
    return S.accept_files(product_files(spark, d), "cspec", "bn000000042").select("name")


@query("first_file_per_detector", "product_files", """
SELECT event, regexp_extract(name, 'glg_([a-z]+)_', 1) AS kind, regexp_extract(name, '_(n\\d)_', 1) AS det, min(name) AS path FROM product_files GROUP BY 1, 2, 3""")
def _(spark, d):
    return S.file_of_detector(product_files(spark, d), "event")


@query("events_without_data_files", "product_files", """
SELECT event FROM product_files GROUP BY 1 HAVING NOT bool_or(name LIKE '%tte%' OR name LIKE '%cspec%')""")
def _(spark, d):
    return S.files_without_data(product_files(spark, d), "event")


@query("file_discovery")
def _(spark, d):
    path = scratch(spark)
    f = product_files(spark, d).select("name", "kind", "det").groupBy("kind", "det").agg(F.min("name").alias("file"), F.count(F.lit(1)).alias("n"))
    f.select(F.concat("kind", F.lit("_"), "det", F.lit("_bn")).alias("product"), F.col("n").cast("string").alias("value")).write.partitionBy("product").text(path)
    found = S.discover_files(spark, path)
    return found.select(F.regexp_extract("path", r"product=([a-z0-9_]+)", 1).alias("product"), "length").orderBy("product")


@query("log_catalog_scan", "bursts", "SELECT round(log10(t90), 8) AS log_t90, round(log10(hr_ratio), 8) AS log_hr FROM bursts")
def _(spark, d):
    path = scratch(spark)
    V.bursts(spark, d).select(r6(F.log10("t90"), 8).alias("log_t90"), r6(F.log10("hr_ratio"), 8).alias("log_hr")).write.csv(path, sep=" ", header=True)
    return S.log_catalog(spark, path)


@query("work_list_scan", "", "SELECT DISTINCT c_name AS burst_name FROM customer")
def _(spark, d):
    path = scratch(spark)
    V.table(spark, d, "customer").select(F.concat(F.lit("  "), "c_name", F.lit(" ")).alias("value")).unionByName(
        V.table(spark, d, "customer").select(F.lit("   ").alias("value"))).write.text(path)
    return S.work_list(spark, path)


@query("result_json", "bursts", "SELECT burst_id, burst_name AS name, redshift AS z FROM bursts")
def _(spark, d):
    b = V.bursts(spark, d).select("burst_id", F.struct(F.col("burst_name").alias("name"), F.col("redshift").alias("z")).alias("result"))
    path = scratch(spark)
    K.save_json(K.result_json(b, "burst_id"), path)
    back = spark.read.schema("burst_id long, json string").json(path)
    r = F.from_json("json", "result struct<name:string,z:double>")
    return back.select("burst_id", r["result"]["name"].alias("name"), r["result"]["z"].alias("z"))


@query("catalog_table_duplicates", "", "SELECT 'Customer#' || o_custkey AS burst_name, count(*) AS n FROM orders GROUP BY 1 HAVING count(*) > 1")
def _(spark, d):
    names = V.table(spark, d, "orders").select(F.concat(F.lit("Customer#"), F.col("o_custkey").cast("string")).alias("burst_name"))
    return K.duplicate_keys(names, "bursts")


@query("catalog_append_and_export", "", """
WITH o AS (SELECT o_orderkey // 7 AS n, count(*) AS a, count(*) FILTER (WHERE o_orderkey % 2 = 0) AS e FROM orders GROUP BY 1)
SELECT n AS circular_number, 'circular ' || n::VARCHAR AS title, CASE WHEN e > 0 THEN a ELSE 0 END AS n_exists, CASE WHEN e > 0 THEN e - 1 ELSE a - 1 END AS n_repeated FROM o""")
def _(spark, d):
    """Two batches into the table of circulars, the table read back, and what was rejected for each number."""
    root, n = scratch(spark), F.floor(F.col("o_orderkey") / 7).cast("long")
    rows = V.table(spark, d, "orders").select("o_orderkey", n.alias("circular_number"), F.concat(F.lit("circular "), n.cast("string")).alias("title"))
    rejected = K.append_rows(rows.where("o_orderkey % 2 = 0"), root, "circulars").unionByName(K.append_rows(rows, root, "circulars"))
    count = lambda reason: F.count(F.when(F.col("reason") == reason, 1))
    why = rejected.groupBy("circular_number").agg(count("key exists").alias("n_exists"), count("repeated in batch").alias("n_repeated"))
    out = K.written_table(spark, root, "circulars").join(why, "circular_number", "left")
    return out.select("circular_number", "title", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("n_exists", "n_repeated")])


@query("circular_archive_scan", "archive", """
SELECT substr(event_code, 1, 4) || '01X' AS event_code, count(*) AS n, sum(length(text))::BIGINT AS n_chars FROM archive GROUP BY 1""")
def _(spark, d):
    from burstframe.plans.circular_queries import archive

    path = scratch(spark)
    a = archive(spark, d).select(F.concat(F.substring("event_code", 1, 4), F.lit("01X")).alias("event"), F.col("text").alias("value"))
    # whole files are compared by their length: a text plus the line end the writer adds
    a.repartition("event").write.partitionBy("event").text(path)
    got = S.circular_archive(spark, path)
    n = F.size(F.split("text", "TITLE: GCN CIRCULAR\nNUMBER: [0-9]+\nSUBJECT: GRB [0-9A-Z]+: detection")) - 1
    return got.select("event_code", n.cast("long").alias("n"), (F.length("text") - n).cast("long").alias("n_chars")).groupBy("event_code").agg(
        F.sum("n").alias("n"), F.sum("n_chars").alias("n_chars"))
