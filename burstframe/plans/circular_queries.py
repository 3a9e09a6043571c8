"""Queries over circular texts and parsed records."""

from __future__ import annotations

from pyspark.sql import functions as F

from burstframe.functions import text as X
from burstframe.operators import circulars as C
from burstframe.operators.reuse import spread
from burstframe.plans.registry import query, r6
from burstframe.sources import views as V

BAR = "=" * 24
SLASH = "/" * 24

# One archive text per order: two or three circulars in the forms the extractors know.
V.DUCK_VIEWS["archive"] = ((), f"""
    SELECT o_orderkey AS k, ev AS event_code,
      'TITLE: GCN CIRCULAR' || chr(10) || 'NUMBER: ' || (30000 + o_orderkey) || chr(10) || 'SUBJECT: GRB ' || ev || ': detection' || chr(10)
      || 'DATE: ' || strftime(o_orderdate, '%Y-%m-%d') || chr(10) || 'FROM: Observer ' || o_custkey || ' at MPE' || chr(10) || chr(10)
      || CASE o_orderkey % 5
         WHEN 0 THEN 'The Fermi GBM trigger ' || trig || ' / 769494427 was bright. T90 = ' || dur || ' s.'
         WHEN 1 THEN 'Swift/BAT trigger ' || (100000 + o_orderkey) || ' on this burst. T90 (50-300 keV) is ' || dur || ' +/- 1.2 s.'
         WHEN 2 THEN 'Trigger No: ' || trig || '. The duration is about ' || dur || ' s and the burst is a short one.'
         WHEN 3 THEN 'bn' || trig || ' was seen; INTEGRAL detected it. T90) of about ' || dur || ' s. A long GRB.'
         ELSE 'Konus-Wind saw it. T90 = ' || (o_orderkey % 900) || ' ms' END
      || chr(10) || CASE WHEN o_orderkey % 2 = 0 THEN '{BAR}' ELSE '{SLASH}' END || chr(10)
      || 'TITLE: GCN CIRCULAR' || chr(10) || 'NUMBER: ' || (60000 + o_orderkey) || chr(10) || 'SUBJECT: GRB ' || ev || ': follow-up' || chr(10)
      || CASE o_orderkey % 4
         WHEN 0 THEN 'RA = ' || (o_orderkey % 360) || '.25, Dec = -' || (o_orderkey % 90) || '.5 deg. A redshift of z = 1.' || (o_orderkey % 100) || '.'
         WHEN 1 THEN 'RA(J2000) = 08h 23m 12.3s, Dec(J2000) = -00d ' || (o_orderkey % 60) || ''' 34.5" with UVOT observing. We find z=0.' || (10 + o_orderkey % 90) || ' here'
         WHEN 2 THEN 'RA: ' || (o_orderkey % 360) || '.75 Dec: ' || (o_orderkey % 90) || '.125 LAT detected photons at redshift of 2.' || (o_orderkey % 10) || ' in the field'
         ELSE 'No counterpart. First z ~ 25.3 was rejected, then redshift 3.' || (o_orderkey % 10) || ' kept; XRT began late' END
      || CASE WHEN o_orderkey % 3 = 0 THEN chr(10) || '{BAR}' || chr(10) || 'short tail' ELSE '' END AS text
    FROM (SELECT *, strftime(o_orderdate, '%y%m%d') || chr(65 + (o_orderkey % 26)::INT) AS ev,
            strftime(o_orderdate, '%y%m%d') || lpad((o_orderkey % 1000)::VARCHAR, 3, '0') AS trig,
            (o_orderkey % 900) // 10 || '.' || (o_orderkey % 10) AS dur FROM orders)""")


def archive(spark, d):
    k, lit = F.col("o_orderkey"), F.lit
    num = lambda c: c.cast("string")
    cat = lambda *a: F.concat(*[lit(x) if isinstance(x, str) else x for x in a])
    o = spread(V.table(spark, d, "orders"))
    day = F.date_format("o_orderdate", "yyMMdd")
    ev = F.concat(day, F.char(k % 26 + 65))
    trig = F.concat(day, F.lpad(num(k % 1000), 3, "0"))
    dur = F.concat(num(F.floor((k % 900) / 10)), lit("."), num(k % 10))
    o = o.withColumns({"ev": ev, "trig": trig, "dur": dur})
    c = F.col
    first = (F.when(k % 5 == 0, cat("The Fermi GBM trigger ", c("trig"), " / 769494427 was bright. T90 = ", c("dur"), " s."))
             .when(k % 5 == 1, cat("Swift/BAT trigger ", num(k + 100000), " on this burst. T90 (50-300 keV) is ", c("dur"), " +/- 1.2 s."))
             .when(k % 5 == 2, cat("Trigger No: ", c("trig"), ". The duration is about ", c("dur"), " s and the burst is a short one."))
             .when(k % 5 == 3, cat("bn", c("trig"), " was seen; INTEGRAL detected it. T90) of about ", c("dur"), " s. A long GRB."))
             .otherwise(cat("Konus-Wind saw it. T90 = ", num(k % 900), " ms")))
    second = (
        F.when(k % 4 == 0, cat("RA = ", num(k % 360), ".25, Dec = -", num(k % 90), ".5 deg. A redshift of z = 1.", num(k % 100), "."))
        .when(k % 4 == 1, cat("RA(J2000) = 08h 23m 12.3s, Dec(J2000) = -00d ", num(k % 60),
                              "' 34.5\" with UVOT observing. We find z=0.", num(k % 90 + 10), " here"))
        .when(k % 4 == 2, cat("RA: ", num(k % 360), ".75 Dec: ", num(k % 90), ".125 LAT detected photons at redshift of 2.",
                              num(k % 10), " in the field"))
        .otherwise(cat("No counterpart. First z ~ 25.3 was rejected, then redshift 3.", num(k % 10), " kept; XRT began late")))
    head = lambda n, what: cat("TITLE: GCN CIRCULAR\nNUMBER: ", num(k + n), "\nSUBJECT: GRB ", c("ev"), f": {what}\n")
    text = F.concat(
        head(30000, "detection"), cat("DATE: ", F.date_format("o_orderdate", "yyyy-MM-dd"), "\nFROM: Observer ", num(c("o_custkey")),
                                      " at MPE\n\n"), first,
        lit("\n"), F.when(k % 2 == 0, BAR).otherwise(SLASH), lit("\n"), head(60000, "follow-up"), second,
        F.when(k % 3 == 0, f"\n{BAR}\nshort tail").otherwise(""))
    return o.select(k.alias("k"), c("ev").alias("event_code"), text.alias("text"))


def q(p: str) -> str:
    return p.replace("'", "''")


def s_first(patterns, text="text"):
    return "coalesce(" + ", ".join(f"nullif(regexp_extract({text}, '{q(p)}', 1), '')" for p in patterns) + ")"


@query("event_code_normalisation", "archive", """
SELECT k, event_code AS code FROM archive""")
def _(spark, d):
    a = archive(spark, d)
    k = F.col("k")
    name = F.when(k % 3 == 0, F.concat(F.lit("GRB "), "event_code")).when(k % 3 == 1, F.concat(F.lit(" grb"), "event_code", F.lit(" "))).otherwise(
        F.col("event_code"))
    return a.select("k", X.event_code(name).alias("code"))


@query("split_circulars", "archive", """
WITH s AS (SELECT k, event_code, unnest(regexp_split_to_array(text, '\\n[/=]{20,}\\n')) AS s FROM archive),
b AS (SELECT *, trim(s, chr(10) || chr(9) || ' ' || chr(13)) AS body FROM s)
SELECT event_code, coalesce(nullif(regexp_extract(body, 'NUMBER:\\s*(\\d+)', 1), '')::BIGINT, 0) AS number,
  trim(regexp_extract(body, 'SUBJECT:\\s*(.+?)(?:\\n|$)', 1)) AS subject, trim(regexp_extract(body, 'DATE:\\s*(.+?)(?:\\n|$)', 1)) AS date,
  trim(regexp_extract(body, 'FROM:\\s*(.+?)(?:\\n|$)', 1)) AS from_line, length(body) AS n_chars FROM b WHERE length(body) >= 50""")
def _(spark, d):
    return C.split_circulars(archive(spark, d)).select(
        "event_code", "number", "subject", "date", "from_line", F.length("body").cast("long").alias("n_chars"))


@query("trigger_ids_from_text", "archive", f"""
SELECT k, {s_first(X.FERMI_TRIGGER)} AS fermi_trigger_id, {s_first(X.SWIFT_TRIGGER)} AS swift_trigger_id FROM archive""")
def _(spark, d):
    m = X.Matches("text")
    return m.apply(archive(spark, d), "k", X.fermi_trigger(m).alias("fermi_trigger_id"), X.swift_trigger(m).alias("swift_trigger_id"))


def s_pos(i, p):
    return f"nullif(regexp_extract(text, '{q(p)}', {i}), '')"


DEG, SEX = X.POSITION_DEGREES, X.POSITION_SEXAGESIMAL
POS_SQL = f"""
WITH p AS (SELECT k, text, try_cast({s_pos(1, DEG)} AS DOUBLE) AS a, try_cast({s_pos(2, DEG)} AS DOUBLE) AS b, {s_pos(1, DEG)} AS sa, {s_pos(2, DEG)} AS sb,
  try_cast({s_pos(1, SEX)} AS DOUBLE) AS h, try_cast({s_pos(2, SEX)} AS DOUBLE) AS m, try_cast({s_pos(3, SEX)} AS DOUBLE) AS s,
  {s_pos(4, SEX)} AS ds, try_cast({s_pos(5, SEX)} AS DOUBLE) AS dm, try_cast({s_pos(6, SEX)} AS DOUBLE) AS dsec FROM archive)
SELECT k, round(CASE WHEN a IS NOT NULL AND b IS NOT NULL THEN a ELSE (h + m / 60 + s / 3600) * 15 END, 6) AS ra,
  round(CASE WHEN a IS NOT NULL AND b IS NOT NULL THEN b ELSE (CASE WHEN starts_with(ds, '-') THEN -1 ELSE 1 END)
        * (abs(ds::DOUBLE) + dm / 60 + dsec / 3600) END, 6) AS dec,
  CASE WHEN a IS NOT NULL AND b IS NOT NULL THEN sa ELSE printf('%02dh%02dm%.1fs', h::INT, m::INT, s) END AS ra_str,
  CASE WHEN a IS NOT NULL AND b IS NOT NULL THEN sb ELSE ds || printf('d%02d''%.1f"', dm::INT, dsec) END AS dec_str FROM p"""


@query("position_from_text", "archive", POS_SQL)
def _(spark, d):
    m = X.Matches("text")
    pos = X.position(m)
    p = m.apply(archive(spark, d), "k", pos.alias("p"))
    return p.select("k", r6("p.ra").alias("ra"), r6("p.dec").alias("dec"), "p.ra_str", "p.dec_str")


def s_z(e):
    return f"CASE WHEN try_cast({e} AS DOUBLE) > 0 AND try_cast({e} AS DOUBLE) < 20 THEN try_cast({e} AS DOUBLE) END"


RE_Z1 = r"(?i)(?:^|[^a-zA-Z])z\s*[=~]\s*([\d.]+)"
Z_SQL = "coalesce(" + ", ".join(s_z(f"regexp_extract(text, '{q(p)}', 1)") for p in [RE_Z1, *X.REDSHIFT[1:]]) + ")"
T_SQL = ("coalesce(" + ", ".join(f"try_cast(regexp_extract(text, '{q(p)}', 1) AS DOUBLE)" for p in X.T90_SECONDS)
         + f", try_cast(regexp_extract(text, '{q(X.T90_MILLISECONDS)}', 1) AS DOUBLE) / 1000)")
W_SQL = ("CASE WHEN " + " OR ".join(f"regexp_matches(lower(text), '{p}')" for p in X.SHORT_WORDS) + " THEN 'short' WHEN "
         + " OR ".join(f"regexp_matches(lower(text), '{p}')" for p in X.LONG_WORDS) + " THEN 'long' END")
M_SQL = "concat_ws(', ', " + ", ".join(f"CASE WHEN regexp_matches(text, '{q(p)}') THEN '{n}' END" for n, p in X.MISSION_WORDS) + ")"


@query("redshift_and_duration_from_text", "archive", f"SELECT k, {Z_SQL} AS redshift, round({T_SQL}, 6) AS t90 FROM archive")
def _(spark, d):
    m = X.Matches("text")
    return m.apply(archive(spark, d), "k", X.redshift(m).alias("redshift"), r6(X.t90(m)).alias("t90"))


@query("class_words_and_missions", "archive", f"SELECT k, {W_SQL} AS classification, {M_SQL} AS missions FROM archive")
def _(spark, d):
    t = F.col("text")
    return archive(spark, d).select("k", X.duration_word(t).alias("classification"), F.array_join(X.missions(t), ", ").alias("missions"))


@query("document_class_words", "", f"""SELECT doc_id, {W_SQL} AS classification, {M_SQL} AS missions, {s_first(X.FERMI_TRIGGER)} AS trigger_id
FROM documents""")
def _(spark, d):
    t, m = F.col("text"), X.Matches("text")
    return m.apply(
        spread(V.table(spark, d, "documents")), "doc_id", X.duration_word(t).alias("classification"),
        F.array_join(X.missions(t), ", ").alias("missions"), X.fermi_trigger(m).alias("trigger_id"))


@query("burst_info", "archive", f"""
SELECT k, 'GRB' || event_code AS burst_name, 
  (SELECT count(*) FROM (SELECT unnest(regexp_split_to_array(text, '\\n[/=]{{20,}}\\n')) AS s) WHERE length(trim(s, chr(10) || ' ')) >= 50)
  AS num_circulars, {s_first(X.FERMI_TRIGGER)} AS fermi_trigger_id,
  'bn' || {s_first(X.FERMI_TRIGGER)} AS fermi_bn_id, {s_first(X.SWIFT_TRIGGER)} AS swift_trigger_id, {Z_SQL} AS redshift,
  round({T_SQL}, 6) AS t90, {W_SQL} AS classification, {M_SQL} AS missions FROM archive""")
def _(spark, d):
    a = archive(spark, d)
    info = C.burst_info(a.withColumn("event_code", F.concat("event_code", F.lit("#"), F.col("k"))))
    return info.select(
        F.split("event_code", "#")[1].cast("long").alias("k"), F.split("burst_name", "#")[0].alias("burst_name"), "num_circulars",
        "fermi_trigger_id", "fermi_bn_id", "swift_trigger_id", "redshift", r6("t90").alias("t90"), "classification",
        F.array_join("missions", ", ").alias("missions"))


# A catalog of triggers, one per line of the item table's ship dates.
V.DUCK_VIEWS["trigger_catalog"] = ((), """
    SELECT 'GRB' || strftime(l_shipdate, '%y%m%d') || lpad((l_orderkey % 1000)::VARCHAR, 3, '0') AS name,
           'bn' || strftime(l_shipdate, '%y%m%d') || lpad((l_orderkey % 1000)::VARCHAR, 3, '0') AS trigger_name FROM lineitem""")


def trigger_catalog(spark, d):
    t = F.concat(F.date_format("l_shipdate", "yyMMdd"), F.lpad((F.col("l_orderkey") % 1000).cast("string"), 3, "0"))
    return V.table(spark, d, "lineitem").select(F.concat(F.lit("GRB"), t).alias("name"), F.concat(F.lit("bn"), t).alias("trigger_name"))


@query("trigger_resolution", "archive trigger_catalog", f"""
WITH i AS (SELECT event_code, min({s_first(X.FERMI_TRIGGER)}) AS c FROM archive GROUP BY 1),
n AS (SELECT DISTINCT event_code FROM archive),
b AS (SELECT substr(name, 4, 6) AS dt, arg_min(trigger_name, name) AS tn FROM trigger_catalog GROUP BY 1)
SELECT 'GRB' || n.event_code AS burst_name, coalesce(c, nullif(regexp_extract(tn, '(\\d{{9}})', 1), '')) AS trigger_id,
       CASE WHEN c IS NOT NULL THEN 'circular' WHEN tn IS NOT NULL THEN 'catalog' END AS source
FROM n LEFT JOIN i USING (event_code) LEFT JOIN b ON b.dt = substr(n.event_code, 1, 6)""")
def _(spark, d):
    a = archive(spark, d)
    m = X.Matches("text")
    ids = m.apply(a, "event_code", X.fermi_trigger(m).alias("fermi_trigger_id"))
    info = ids.groupBy("event_code").agg(F.min("fermi_trigger_id").alias("fermi_trigger_id"))
    names = a.select(F.concat(F.lit("GRB"), "event_code").alias("burst_name")).distinct()
    return C.resolve_triggers(names, info, trigger_catalog(spark, d))


@query("trigger_by_date_prefix", "archive trigger_catalog", """
WITH n AS (SELECT DISTINCT 'GRB' || event_code AS burst_name FROM archive),
b AS (SELECT substr(name, 4, 6) AS dt, min(name) AS f FROM trigger_catalog GROUP BY 1)
SELECT burst_name, 'bn' || replace(f, 'GRB', '') AS trigger, CASE WHEN f IS NOT NULL THEN '20' || substr(burst_name, 4, 2) END AS year,
       f IS NULL AS missing FROM n LEFT JOIN b ON b.dt = substr(burst_name, 4, 6)""")
def _(spark, d):
    names = archive(spark, d).select(F.concat(F.lit("GRB"), "event_code").alias("burst_name")).distinct()
    return C.trigger_by_prefix(names, trigger_catalog(spark, d))


@query("archive_urls", "trigger_catalog", """
SELECT DISTINCT substr(name, 4) AS trigger_id, 'gbm/20' || substr(name, 4, 2) || '/bn' || substr(name, 4) || '/current/' AS gbm_url,
       'lat/triggers/20' || substr(name, 4, 2) || '/bn' || substr(name, 4) || '/' AS lat_url FROM trigger_catalog""")
def _(spark, d):
    t = trigger_catalog(spark, d).select(F.substring("name", 4, 9).alias("trigger_id")).distinct()
    return C.archive_urls(t)


def responses(spark, d):
    k, p = F.col("event_id"), F.col("props")
    fence = F.lit("```")
    text = (F.when(k % 6 == 0, p).when(k % 6 == 1, F.concat(F.lit("Here:\n"), fence, F.lit("json\n"), p, F.lit("\n"), fence, F.lit("\nend")))
            .when(k % 6 == 2, F.concat(F.lit("Answer "), p, F.lit(" done } end")))
            .when(k % 6 == 3, F.concat(F.lit("{\"k\": "), F.regexp_extract(p, r"(\d+)", 1), F.lit(",}")))
            .when(k % 6 == 4, F.concat(F.lit("List: ["), p, F.lit("]"))).otherwise(F.lit("nothing here")))
    return spread(V.table(spark, d, "events")).select("event_id", "event_type", text.alias("text"))


@query("json_recovery", "", """
SELECT event_id, CASE WHEN event_id % 6 < 5 THEN regexp_extract(props, '(\\d+)', 1)::BIGINT END AS k FROM events""")
def _(spark, d):
    r = C.parse_responses(responses(spark, d))
    return r.select("event_id", F.coalesce(F.try_variant_get("parsed", "$.k", "bigint"), F.try_variant_get("parsed", "$[0].k", "bigint")).alias("k"))


@query("json_batch_counts", "", """
SELECT event_type, count(*) FILTER (WHERE event_id % 6 < 5) AS n_parsed, count(*) FILTER (WHERE event_id % 6 = 5) AS n_failed FROM events GROUP BY 1""")
def _(spark, d):
    return C.parse_counts(C.parse_responses(responses(spark, d)), "event_type")


def parsed(spark, d):
    k = F.col("o_orderkey")
    flux = F.struct(
        (F.col("o_totalprice") / 100).alias("time_seconds_since_trigger"), F.col("o_totalprice").alias("flux_value"),
        (F.col("o_totalprice") * 0.1).alias("flux_error"), F.lit("mJy").alias("units"), F.col("o_orderpriority").alias("instrument"))
    return V.table(spark, d, "orders").select(
        F.col("o_custkey").alias("burst_id"), k.alias("seq"), F.when(k % 3 != 0, (k % 70) / 10.0).alias("redshift"),
        (k % 500).cast("double").alias("t90"), F.array("o_orderpriority", "o_orderstatus").alias("instruments"),
        F.array(F.concat(F.lit("finding "), (k % 7).cast("string"))).alias("key_findings"),
        F.when(k % 2 == 0, F.array(flux)).otherwise(F.array(flux, flux)).alias("flux_measurements"))


@query("merged_circulars", "", """
WITH f AS (SELECT o_custkey AS burst_id, arg_min(CASE WHEN o_orderkey % 3 <> 0 THEN (o_orderkey % 70) / 10e0 ELSE -1 END, o_orderkey) AS redshift,
   arg_min(o_orderkey % 500, o_orderkey)::DOUBLE AS t90, count(*) AS sources_count, sum(1 + o_orderkey % 2)::BIGINT AS n_flux,
   count(DISTINCT o_orderkey % 7) AS n_findings FROM orders GROUP BY 1),
i AS (SELECT o_custkey AS burst_id, string_agg(DISTINCT x, '|' ORDER BY x) AS instruments FROM
      (SELECT o_custkey, unnest([o_orderpriority, o_orderstatus]) AS x FROM orders) GROUP BY 1)
SELECT burst_id, nullif(redshift, -1) AS redshift, t90, instruments, sources_count, n_flux, n_findings FROM f JOIN i USING (burst_id)""")
def _(spark, d):
    return C.burst_summary(parsed(spark, d)).withColumn("instruments", F.array_join("instruments", "|"))


@query("merged_circular_lists", "", """
WITH o AS (SELECT *, o_custkey AS burst_id, o_orderkey AS k FROM orders),
h AS (SELECT burst_id, arg_min(k % 500, k)::DOUBLE AS t90, count(*) AS sources_count FROM o GROUP BY 1),
fl AS (SELECT burst_id, string_agg(o_orderpriority || ' ' || round(o_totalprice)::BIGINT::VARCHAR, '|' ORDER BY k, i) AS flux_measurements FROM o, range(2) r(i) WHERE i < 1 + k % 2 GROUP BY 1),
ins AS (SELECT burst_id, string_agg(DISTINCT x, '|' ORDER BY x) AS instruments FROM (SELECT burst_id, unnest([o_orderpriority, o_orderstatus]) AS x FROM o) GROUP BY 1),
kf AS (SELECT burst_id, string_agg(DISTINCT 'finding ' || (k % 7)::VARCHAR, '|' ORDER BY 'finding ' || (k % 7)::VARCHAR) AS key_findings FROM o GROUP BY 1)
SELECT burst_id, 0 AS part, t90, flux_measurements, instruments, key_findings, sources_count FROM h JOIN fl USING (burst_id) JOIN ins USING (burst_id) JOIN kf USING (burst_id)""")
def _(spark, d):
    """Merged records with flux rows, instruments and findings as lists (joined to text here, for the comparison)."""
    flux = F.transform("flux_measurements", lambda m: F.concat_ws(" ", m["instrument"], F.round(m["flux_value"]).cast("long").cast("string")))
    return C.burst_record(parsed(spark, d)).select(
        "burst_id", "part", "t90", F.array_join(flux, "|").alias("flux_measurements"), F.array_join("instruments", "|").alias("instruments"),
        F.array_join("key_findings", "|").alias("key_findings"), "sources_count")


def circular_json(spark, d):
    """Parsed circulars as JSON text with values that do not fit in some of them."""
    k = F.col("o_orderkey")
    value = F.when(k % 17 == 0, F.lit('"bright"')).when(k % 19 == 0, F.lit('"12.5"')).otherwise((k % 100).cast("string"))
    row = F.concat(F.lit('{"flux_value": '), value, F.lit(', "units": "mJy", "other": 1}'))
    flux = F.when(k % 13 == 0, row).otherwise(F.concat(F.lit('[{"units": null}, '), row, F.lit("]")))
    z = F.when(k % 11 == 0, F.lit('"unknown"')).otherwise(F.concat(F.lit('{"z": '), (k % 70).cast("string"), F.lit("}")))
    text = F.concat(F.lit('{"grb_name": "GRB'), k.cast("string"), F.lit('", "redshift": '), z, F.lit(', "flux_measurements": '), flux, F.lit(', "instruments": ["XRT", "BAT"]}'))
    return V.table(spark, d, "orders").select(k.alias("seq"), F.when(k % 23 == 0, F.lit("[1, 2]")).otherwise(text).alias("text"))


@query("typed_circulars", "", """
WITH o AS (SELECT o_orderkey AS k, o_orderkey % 23 = 0 AS bad FROM orders)
SELECT k AS seq, CASE WHEN NOT bad THEN 'GRB' || k::VARCHAR END AS grb_name, CASE WHEN NOT bad AND k % 11 <> 0 THEN (k % 70)::DOUBLE END AS z,
       CASE WHEN NOT bad AND k % 13 <> 0 THEN 2 ELSE 0 END AS n_flux,
       CASE WHEN NOT bad AND k % 13 <> 0 AND k % 17 <> 0 THEN CASE WHEN k % 19 = 0 THEN 12.5e0 ELSE (k % 100)::DOUBLE END END AS flux_value,
       CASE WHEN NOT bad THEN 'XRT BAT' END AS instruments, CASE WHEN bad THEN 1 ELSE 0 END
         + CASE WHEN NOT bad AND k % 11 = 0 THEN 1 ELSE 0 END + CASE WHEN NOT bad AND (k % 13 = 0 OR k % 17 = 0) THEN 1 ELSE 0 END AS n_problems,
       CASE WHEN bad THEN '' ELSE concat_ws(' ', CASE WHEN k % 11 = 0 THEN 'redshift' END,
         CASE WHEN k % 13 = 0 THEN 'flux_measurements' WHEN k % 17 = 0 THEN 'flux_measurements[1].flux_value' END) END AS problems
FROM o""")
def _(spark, d):
    """Recovered JSON taken apart by the nested schema of a parsed circular, with the paths that do not fit."""
    t = C.typed_circulars(C.parse_responses(circular_json(spark, d)))
    return t.select("seq", "grb_name", F.col("redshift.z").alias("z"), F.greatest(F.size("flux_measurements"), F.lit(0)).cast("long").alias("n_flux"),
                    F.try_element_at("flux_measurements", F.lit(2))["flux_value"].alias("flux_value"), F.array_join("instruments", " ").alias("instruments"),
                    F.size("problems").cast("long").alias("n_problems"), F.array_join("problems", " ").alias("problems"))


@query("flux_table", "", """
SELECT o_custkey AS burst_id, o_orderkey AS seq, o_totalprice / 100 AS time_seconds_since_trigger, o_totalprice AS flux_value,
       o_totalprice * 0.1::DOUBLE AS flux_error, 'mJy' AS units, o_orderpriority AS instrument
FROM orders, range(2) r(i) WHERE i < 1 + o_orderkey % 2""")
def _(spark, d):
    return C.flux_table(parsed(spark, d))


@query("circular_by_number", "archive", """
SELECT 30000 + k AS circular_number, 'GRB ' || event_code || ': detection' AS title FROM archive WHERE 30000 + k = 30077""")
def _(spark, d):
    from burstframe.operators.catalog import circular_by_number

    parts = C.split_circulars(archive(spark, d)).withColumnsRenamed({"number": "circular_number", "subject": "title"})
    return circular_by_number(parts, 30077).select("circular_number", "title")
