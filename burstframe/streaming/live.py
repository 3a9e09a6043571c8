"""Live variants: windowed light curves and circular extraction on streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from burstframe.operators.circulars import split_circulars
from burstframe.functions import text as X


def live_light_curve(photons: DataFrame, binsize: str = "1 day", late: str = "2 days", ts: str = "ts", keys=("burst_id", "band")) -> DataFrame:
    """Counts per time window and series; photons later than the watermark are dropped."""
    return (
        photons.withWatermark(ts, late)
        .groupBy(F.window(ts, binsize).alias("w"), *keys)
        .agg(F.count(F.lit(1)).alias("counts"))
        .select(F.col("w.start").alias("t_start"), F.col("w.end").alias("t_end"), *keys, "counts",
                F.sqrt(F.col("counts").cast("double")).alias("counts_err"))
    )


def live_circulars(archive: DataFrame, ts: str = "ts", late: str = "30 days") -> DataFrame:
    """Circulars of arriving archive texts, each number once, with the extracted fields."""
    parts = split_circulars(archive.withColumn("event_code", F.struct("event_code", F.col(ts).alias("ts"))))
    m = X.Matches("body")
    rows = m.apply(
        parts, F.col("event_code.ts").alias("ts"), F.col("event_code.event_code").alias("event_code"), F.col("number").alias("circular_number"),
        "subject", X.fermi_trigger(m).alias("fermi_trigger_id"), X.swift_trigger(m).alias("swift_trigger_id"),
        X.redshift(m).alias("redshift"), X.t90(m).alias("t90"))
    return rows.withWatermark("ts", late).dropDuplicatesWithinWatermark(["circular_number"])


def drain(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Run a stream over all available input into Parquet (append) and stop."""
    q = (stream.writeStream.format("parquet").outputMode("append").option("path", path).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()


def file_stream(spark: SparkSession, path: str, schema: T.StructType, files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.schema(schema)
    if files_per_trigger:
        r = r.option("maxFilesPerTrigger", files_per_trigger)
    return r.parquet(path)
