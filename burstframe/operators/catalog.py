"""Catalog tables as keyed DataFrame operations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from burstframe.operators.series import attach


def insert_unique(table: DataFrame, new: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(table after the insert, rejected rows) by the rule of :func:`unique_rows`."""
    accepted, rejected = unique_rows(table, new, key)
    return table.unionByName(accepted), rejected


def unique_rows(table: DataFrame, new: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(rows of ``new`` that the table takes, rejected rows with their ``reason``).

    A new row is rejected when its key exists already, or repeats inside the batch: the first by content stays, all its other copies and the
    other contents are rejected.  Equal rows are counted, not moved, so a key with very many copies is one row.
    """
    cols = table.columns
    for c in cols:
        if c not in new.columns:
            new = new.withColumn(c, F.lit(None).cast(table.schema[c].dataType))
    rec = F.struct(*cols)
    counts = new.select(*cols).groupBy(*cols).agg(F.count(F.lit(1)).alias("_k")).select(F.col(key).alias("_key"), rec.alias("_r"), F.xxhash64(*cols).alias("_h"), "_k")
    old = table.select(F.col(key).alias("_old")).distinct()
    known = counts.join(old, F.col("_key") == F.col("_old"), "left_semi")
    fresh = counts.join(old, F.col("_key") == F.col("_old"), "left_anti")
    first = fresh.groupBy(F.col("_key").alias("_fk")).agg(F.min(F.struct("_h", "_r")).alias("_f"))
    accepted = first.select("_f._r.*")
    rest = fresh.join(first, F.col("_key").eqNullSafe(F.col("_fk"))).withColumn("_k", F.col("_k") - F.when(F.col("_r").eqNullSafe(F.col("_f._r")), 1).otherwise(0))

    def copies(rows: DataFrame, reason: str) -> DataFrame:
        many = rows.where("_k > 0").withColumn("_i", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_k"))))
        return many.select("_r.*", F.lit(reason).alias("reason"))

    return accepted, copies(known, "key exists").unionByName(copies(rest, "repeated in batch"))


def append(table: DataFrame, new: DataFrame) -> DataFrame:
    """Plain append; missing columns become NULL."""
    return table.unionByName(new, allowMissingColumns=True)


def lookup(table: DataFrame, key: str, value) -> DataFrame:
    return table.filter(F.col(key) == value)


def update_by_key(table: DataFrame, updates: DataFrame, key: str, stamp: str | None = "updated_at") -> DataFrame:
    """Rows with an update take its values (also its NULLs) and a new time stamp; others stay."""
    cols = [c for c in table.columns if c != key]
    upd = updates.select(key, F.lit(True).alias("_hit"), *[F.col(c).alias(f"_u_{c}") for c in updates.columns if c != key])
    out = attach(table, upd, [key], "left")
    hit = F.col("_hit").isNotNull()
    picked = []
    for c in cols:
        if c == stamp:
            picked.append(F.when(hit, F.current_timestamp()).otherwise(F.col(c)).alias(c))
        elif f"_u_{c}" in out.columns:
            picked.append(F.when(hit, F.col(f"_u_{c}")).otherwise(F.col(c)).alias(c))
        else:
            picked.append(F.col(c))
    return out.select(key, *picked)


def delete_by_key(tables: dict[str, DataFrame], parent: str, keys: DataFrame, key: str, cascade: bool = False) -> dict[str, DataFrame]:
    """Remove parent rows; children keep their rows unless ``cascade``."""
    gone = keys.select(key).distinct()
    return {n: t.join(gone, key, "left_anti") if n == parent or (cascade and key in t.columns) else t for n, t in tables.items()}


def fits_to_storage(fits: DataFrame) -> DataFrame:
    """Parameter and error maps as JSON text; a missing model is stored as Band."""
    return fits.withColumns({
        "model": F.coalesce("model", F.lit("Band")), "params": F.to_json("params"), "errors": F.to_json("errors")})


def fits_from_storage(stored: DataFrame) -> DataFrame:
    return stored.withColumns({c: F.from_json(c, "map<string,double>") for c in ("params", "errors")})


def lightcurve_summary(lc: DataFrame, keys: Sequence[str]) -> DataFrame:
    return lc.groupBy(*keys).agg(
        F.coalesce(F.min("t"), F.lit(0.0)).alias("time_start"), F.coalesce(F.max("t"), F.lit(0.0)).alias("time_end"),
        F.coalesce(F.avg("rate"), F.lit(0.0)).alias("rate"), F.coalesce(F.avg("rate_err"), F.lit(0.0)).alias("rate_err"),
        F.max("binsize").alias("binsize"))


def newest_first(table: DataFrame, order: str = "trigger_time") -> DataFrame:
    return table.orderBy(F.col(order).desc_nulls_last())


def by_class(table: DataFrame, name: str, column: str = "classification") -> DataFrame:
    return newest_first(table.filter(F.col(column) == name))


def with_redshift(table: DataFrame) -> DataFrame:
    return table.filter("redshift IS NOT NULL").orderBy(F.col("redshift").desc())


def t90_between(table: DataFrame, lo: float, hi: float) -> DataFrame:
    return table.filter(F.col("t90").between(lo, hi))


def listing(table: DataFrame, sort: str = "timestamp", limit: int = 50) -> DataFrame:
    """Top rows by time (newest first), name or type."""
    order = {"timestamp": F.col("trigger_time").desc_nulls_last(), "name": F.col("burst_name").asc(),
             "type": F.col("classification").asc_nulls_last()}[sort]
    return table.orderBy(order, "burst_name").limit(limit)


def normalise_enum(value: Column, names: Sequence[tuple[str, str]], default: str) -> Column:
    """Exact value, else case-insensitive enum name, else the default."""
    out = F.when(value.isin([v for v, _ in names]), value)
    for v, n in names:
        out = out.when(F.upper(value) == n, F.lit(v))
    return out.otherwise(F.lit(default))


def completion_status(bursts: DataFrame, results: dict[str, DataFrame], key: str = "burst_id") -> DataFrame:
    """Map stage -> whether the burst has results in that stage's table."""
    out = bursts.select(key)
    for name, t in results.items():
        out = attach(out, t.select(key).distinct().withColumn(f"_has_{name}", F.lit(True)), [key], "left")
    flags = [F.coalesce(F.col(f"_has_{n}"), F.lit(False)) for n in results]
    return out.select(key, F.map_from_arrays(F.array(*[F.lit(n) for n in results]), F.array(*flags)).alias("stages"))


def missing_results(bursts: DataFrame, result: DataFrame, key: str = "burst_id") -> DataFrame:
    """Bursts that still need a stage."""
    return bursts.join(result.select(key).distinct(), key, "left_anti")


def unknown_names(requested: DataFrame, known: DataFrame, column: str) -> DataFrame:
    return requested.select(column).distinct().join(known.select(column).distinct(), column, "left_anti")


def circular_by_number(circulars: DataFrame, number: int) -> DataFrame:
    return circulars.filter(F.col("circular_number") == number)
