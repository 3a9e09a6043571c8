"""Operators over alert circulars and their parsed records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from burstframe.functions import text as X
from burstframe.operators.series import attach, with_position
from burstframe.schemas import PARSED_CIRCULAR


def split_circulars(archive: DataFrame, event: str = "event_code", text: str = "text") -> DataFrame:
    """One row per circular of an archive text; fragments under 50 characters are dropped."""
    parts = archive.select(event, F.posexplode(F.split(F.col(text), X.DIVIDER)).alias("section", "_s"))
    body = F.regexp_replace("_s", r"^\s+|\s+$", "")
    b = F.col("body")
    field = lambda name: F.coalesce(F.trim(F.regexp_extract(b, name + r":\s*(.+?)(?:\n|$)", 1)), F.lit(""))
    return parts.withColumn("body", body).filter(F.length("body") >= X.MIN_SECTION).select(
        event, "section",
        F.coalesce(X.group(b, r"NUMBER:\s*(\d+)").try_cast("long"), F.lit(0)).alias("number"),
        field("SUBJECT").alias("subject"), field("DATE").alias("date"), field("FROM").alias("from_line"), "body")


def burst_info(archive: DataFrame, event: str = "event_code", text: str = "text") -> DataFrame:
    """Everything the extractors find in the whole archive text of an event (pattern order beats text order)."""
    t = F.col(text)
    sections = F.filter(F.split(t, X.DIVIDER), lambda s: F.length(F.regexp_replace(s, r"^\s+|\s+$", "")) >= X.MIN_SECTION)
    m = X.Matches(text)
    fermi = X.fermi_trigger(m)
    cols = [
        event, F.concat(F.lit("GRB"), X.event_code(F.col(event))).alias("burst_name"),
        F.size(sections).cast("long").alias("num_circulars"), fermi.alias("fermi_trigger_id"),
        X.swift_trigger(m).alias("swift_trigger_id"), X.position(m).alias("_p"), X.redshift(m).alias("redshift"), X.t90(m).alias("t90"),
        X.duration_word(t).alias("classification"), X.missions(t).alias("missions")]
    out = m.apply(archive, *cols)
    return out.select(
        event, "burst_name", "num_circulars", "fermi_trigger_id", F.concat(F.lit("bn"), "fermi_trigger_id").alias("fermi_bn_id"),
        "swift_trigger_id", "_p.ra", "_p.dec", "_p.ra_str", "_p.dec_str", "redshift", "t90", "classification", "missions")


def resolve_triggers(names: DataFrame, info: DataFrame, catalog: DataFrame, name: str = "burst_name") -> DataFrame:
    """Trigger id from the circulars, else the first catalog row of the same six-digit date.

    ``info``: event_code, fermi_trigger_id.  ``catalog``: name, trigger_name.
    """
    ev = names.withColumns({"event_code": X.event_code(F.col(name)),
                            "_date": X.group(X.event_code(F.col(name)), r"^(\d{6})")})
    by_date = catalog_by_date(catalog)
    known = info.select("event_code", F.col("fermi_trigger_id").alias("_circ"))
    out = ev.join(known, "event_code", "left").join(by_date, "_date", "left")
    return out.select(
        name, F.coalesce("_circ", X.group(F.col("_tn"), r"(\d{9})")).alias("trigger_id"),
        F.when(F.col("_circ").isNotNull(), "circular").when(F.col("_tn").isNotNull(), "catalog").alias("source"))


def catalog_by_date(catalog: DataFrame) -> DataFrame:
    """First catalog entry (by name) per six-digit date."""
    date = X.group(F.regexp_replace("name", r"^GRB\s*", ""), r"^(\d{6})")
    return catalog.withColumn("_date", date).filter("_date IS NOT NULL").groupBy("_date").agg(
        F.min_by("trigger_name", "name").alias("_tn"), F.min("name").alias("_first"))


def trigger_by_prefix(names: DataFrame, catalog: DataFrame, name: str = "burst_name") -> DataFrame:
    """'GRB240825A' -> 'bn240825662' and the year folder, by date prefix of the catalog names."""
    first = catalog_by_date(catalog).select("_date", "_first")
    out = names.withColumn("_date", F.substring(F.col(name), 4, 6)).join(first, "_date", "left")
    return out.select(
        name, F.concat(F.lit("bn"), F.replace(F.col("_first"), F.lit("GRB"), F.lit(""))).alias("trigger"),
        F.when(F.col("_first").isNotNull(), F.concat(F.lit("20"), F.substring("_date", 1, 2))).alias("year"),
        F.col("_first").isNull().alias("missing"))


def archive_urls(triggers: DataFrame, trigger: str = "trigger_id", gbm_root: str = "gbm", lat_root: str = "lat") -> DataFrame:
    """Folder names of an event in the two archives."""
    year = F.concat(F.lit("20"), F.substring(F.col(trigger), 1, 2))
    bn = F.concat(F.lit("bn"), F.col(trigger))
    return triggers.withColumns({
        "gbm_url": F.concat_ws("/", F.lit(gbm_root), year, bn, F.lit("current/")),
        "lat_url": F.concat_ws("/", F.lit(lat_root), F.lit("triggers"), year, F.concat(bn, F.lit("/")))})


def parse_responses(df: DataFrame, text: str = "text") -> DataFrame:
    """Adds the variant ``parsed``; NULL where no JSON can be recovered."""
    return df.withColumn("parsed", X.json_value(F.col(text)))


def _typed(value: Column, kind: T.DataType, path: Column) -> tuple[Column, Column]:
    """A variant as ``kind``, and the paths below it whose values do not fit (array of text)."""
    absent = value.isNull() | F.is_variant_null(value)
    none = F.array().cast("array<string>")

    def checked(found: Column, below: Column = none) -> Column:
        return F.when(absent, none).when(found.isNull(), F.array(path)).otherwise(below)

    if isinstance(kind, T.StructType):
        there = F.try_variant_get(value, "$", "map<string,variant>")
        parts = [(f.name, *_typed(F.try_variant_get(value, f"$.{f.name}", "variant"), f.dataType,
                                  F.when(path == "", F.lit(f.name)).otherwise(F.concat(path, F.lit(f".{f.name}"))))) for f in kind]
        return F.when(there.isNotNull(), F.struct(*[v.alias(n) for n, v, _ in parts])), checked(there, F.concat(*[p for *_, p in parts]))
    if isinstance(kind, T.ArrayType):
        items = F.try_variant_get(value, "$", "array<variant>")
        inner = lambda v, i: _typed(v, kind.elementType, F.concat(path, F.lit("["), i.cast("string"), F.lit("]")))
        return F.transform(items, lambda v, i: inner(v, i)[0]), checked(items, F.flatten(F.transform(items, lambda v, i: inner(v, i)[1])))
    found = F.try_variant_get(value, "$", kind.simpleString())
    return found, checked(found)


def typed_circulars(df: DataFrame, schema: T.StructType = PARSED_CIRCULAR, variant: str = "parsed") -> DataFrame:
    """Adds the fields of ``schema`` taken from the variant, and ``problems``: the paths whose values do not fit, as 'flux_measurements[2].flux_value'.

    Absent fields and JSON nulls are null and no problem; a value that cannot be cast is null and one; fields beyond the schema are left out.  A variant that is
    no object has all fields null and the path ''; a null variant has no problems.  Columns of ``df`` with the name of a field are replaced.
    """
    value, problems = _typed(F.col(variant), schema, F.lit(""))
    out = df.withColumn("__typed", value).withColumn("problems", problems)
    return out.withColumns({f.name: F.col(f"__typed.{f.name}") for f in schema}).drop("__typed")


def parsed_only(df: DataFrame) -> DataFrame:
    return df.filter("parsed IS NOT NULL")


def parse_counts(df: DataFrame, *keys: str) -> DataFrame:
    ok = F.col("parsed").isNotNull()
    return df.groupBy(*keys).agg(F.sum(ok.cast("long")).alias("n_parsed"), F.sum((~ok).cast("long")).alias("n_failed"))


def burst_summary(parsed: DataFrame, key: str = "burst_id", seq: str = "seq") -> DataFrame:
    """One record per burst: scalars of the first circular, merged instruments, counts of the rest.

    For the lists themselves see :func:`burst_record`, :func:`flux_table` and :func:`key_findings`.
    """
    head = ["coordinates", "redshift", "t90", "spectral_parameters"]
    first = parsed.groupBy(key).agg(
        F.min_by(F.struct(*[c for c in head if c in parsed.columns]), seq).alias("_f"), F.count(F.lit(1)).alias("sources_count"),
        F.sum(F.coalesce(F.size("flux_measurements"), F.lit(0))).alias("n_flux"))
    inst = parsed.select(key, F.explode("instruments").alias("_i")).groupBy(key).agg(
        F.array_sort(F.collect_set("_i")).alias("instruments"))
    found = key_findings(parsed, key).groupBy(key).agg(F.count(F.lit(1)).alias("n_findings"))
    out = attach(attach(first, inst, [key], "left"), found, [key], "left")
    return out.select(key, "_f.*", "instruments", "sources_count", "n_flux", F.coalesce("n_findings", F.lit(0)).alias("n_findings"))


#: Entries of a list in one row of the merged record.
PART = 10_000


def burst_record(parsed: DataFrame, key: str = "burst_id", seq: str = "seq", size: int = PART) -> DataFrame:
    """Merged record per burst with its lists: scalars of the first circular, all flux rows in the order of circulars, distinct sorted instruments and findings.

    A burst has one row for each ``size`` entries of its longest list (``part`` from 0); nearly always that is one row, while a burst
    with very many circulars does not have to fit one.  Scalars and ``sources_count`` stand in every part; a list that has ended is empty.  Null lists count as
    empty, null entries are left out; circulars with the same ``seq`` are ordered by their content, those without a burst take no part.
    """
    head = [c for c in ("grb_name", "trigger_time", "coordinates", "redshift", "t90", "spectral_parameters") if c in parsed.columns]
    content = F.xxhash64(*[c for c in ("grb_name", "redshift", "t90", "flux_measurements", "instruments", "key_findings") if c in parsed.columns])
    rows = parsed.withColumn("_c", content)
    first = rows.groupBy(key).agg(F.min_by(F.struct(F.lit(True).alias("_any"), *head), F.struct(seq, "_c")).alias("_f"), F.count(F.lit(1)).alias("sources_count"))

    def parts(entries: DataFrame, order: list[str], name: str) -> DataFrame:
        placed = with_position(entries, [key], order, "_pos").withColumn("part", F.floor(F.col("_pos") / F.lit(size)).cast("long"))
        return placed.groupBy(key, "part").agg(F.array_sort(F.collect_list(F.struct("_pos", "_e"))).alias("_l")).select(key, "part", F.col("_l._e").alias(name))

    flux = rows.select(key, F.col(seq).alias("_s"), "_c", F.posexplode("flux_measurements").alias("_i", "_e")).where("_e IS NOT NULL")
    lists = [parts(flux, ["_s", "_c", "_i"], "flux_measurements")]
    for name in ("instruments", "key_findings"):
        lists.append(parts(rows.select(key, F.explode(name).alias("_e")).where("_e IS NOT NULL").distinct(), ["_e"], name))
    out = first.select(key, F.lit(0).cast("long").alias("part"))
    for one in lists:
        out = out.join(one, [key, "part"], "full")
    empty = {n: F.coalesce(n, F.array().cast(out.schema[n].dataType)) for n in ("flux_measurements", "instruments", "key_findings")}
    return out.withColumns(empty).join(first, key).select(key, "part", *[f"_f.{c}" for c in head], *empty, "sources_count")


def key_findings(parsed: DataFrame, key: str = "burst_id") -> DataFrame:
    return parsed.select(key, F.explode("key_findings").alias("finding")).distinct()


FLUX_COLUMNS = ("time_seconds_since_trigger", "flux_value", "flux_error", "units", "instrument")


def flux_table(parsed: DataFrame, key: str = "burst_id", seq: str = "seq") -> DataFrame:
    """All flux measurements in time order; missing standard columns are NULL."""
    rows = parsed.select(key, seq, F.explode("flux_measurements").alias("_m"))
    present = rows.schema["_m"].dataType.names
    cols = [F.col(f"_m.{c}").alias(c) if c in present else F.lit(None).cast("double").alias(c) for c in FLUX_COLUMNS]
    return rows.select(key, seq, *cols).orderBy(key, "time_seconds_since_trigger", seq)
