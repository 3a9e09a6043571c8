"""Sinks: text, JSON and the catalog tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from burstframe.functions.spectral_models import flux_density_factor
from burstframe.operators.catalog import unique_rows
from burstframe.operators.reuse import keep
from burstframe.schemas import TABLES, UNIQUE_KEYS


def converted_flux(xrt: DataFrame, target_energy: float) -> DataFrame:
    """Flux density and both errors at the target energy, with the photon index of each epoch."""
    k = flux_density_factor(F.col("reference_energy"), F.lit(float(target_energy)), F.col("photon_index"))
    out = xrt.withColumn("_k", k)
    return out.select(
        "burst_id", F.col("t").alias("time"), F.col("t_err_neg").alias("terr_n"), F.col("t_err_pos").alias("terr_p"),
        (F.col("flux_density") * F.col("_k")).alias("Fd"), (F.col("flux_density_err_neg") * F.col("_k")).alias("Fd_n"),
        (F.col("flux_density_err_pos") * F.col("_k")).alias("Fd_p"))


def save_converted(xrt: DataFrame, target_energy: float, path: str) -> None:
    """Space-separated text: time, negative and positive time errors, flux, negative and positive flux errors."""
    converted_flux(xrt, target_energy).drop("burst_id").write.csv(path, sep=" ", header=True)


def result_json(df: DataFrame, key: str) -> DataFrame:
    """One JSON text per row, nested structs kept."""
    return df.select(key, F.to_json(F.struct(*[c for c in df.columns if c != key])).alias("json"))


def save_json(df: DataFrame, path: str) -> None:
    df.write.json(path)


def create_tables(spark: SparkSession, root: str, buckets: int = 16) -> None:
    """The catalog tables, empty, as Parquet bucketed on the burst name so that joins need no exchange."""
    for name, schema in TABLES.items():
        w = spark.createDataFrame([], schema).write.format("parquet").option("path", f"{root}/{name}")
        if "burst_name" in schema.names:
            w = w.bucketBy(buckets, "burst_name").sortBy("burst_name")
        w.mode("ignore").saveAsTable(name)


def written_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A catalog table written below ``root``; empty before its first rows, other names are refused."""
    if name not in TABLES:
        raise ValueError(f"unknown table {name}; known: {sorted(TABLES)}")
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{name}")
    there = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)
    return spark.read.schema(TABLES[name]).parquet(f"{root}/{name}") if there else spark.createDataFrame([], TABLES[name])


def append_rows(new: DataFrame, root: str, name: str) -> DataFrame:
    """Append to a catalog table below ``root`` and return the rejected rows with their ``reason``.

    Missing columns become null, columns that the table lacks are left out.  A table with a unique key takes the first row of a key that it does not hold yet; null
    counts as a key inside a batch only.  Both sides are settled before anything is written, so a retry of a failed job sees the old table.  One writer at a time.
    """
    spark = new.sparkSession
    table = written_table(spark, root, name)
    have = set(new.columns)
    batch = new.select(*[(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in TABLES[name]])
    if name not in UNIQUE_KEYS:
        batch.write.mode("append").parquet(f"{root}/{name}")
        return batch.limit(0).withColumn("reason", F.lit(""))
    batch = keep(batch)
    accepted, rejected = (keep(x) for x in unique_rows(table, batch, UNIQUE_KEYS[name][0]))
    accepted.write.mode("append").parquet(f"{root}/{name}")
    return rejected


def duplicate_keys(df: DataFrame, name: str) -> DataFrame:
    """Keys that occur more than once in a table with a unique key."""
    key = UNIQUE_KEYS.get(name)
    if key is None:
        return df.limit(0)
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def export_table(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table by name; other names are refused."""
    if name not in TABLES:
        raise ValueError(f"unknown table {name}; known: {sorted(TABLES)}")
    return spark.table(name)
