"""Materialise frames that one job reads more than once.

``keep`` writes the frame as a Parquet table under the cluster's checkpoint folder and reads it
back: later readers prune columns, see true sizes, start from a short lineage, and the
data outlives any executor.  Shuffle files of the write go once the table stands.  ``drop`` removes single
tables, ``discard`` all tables of this application.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from burstframe.session import ensure_checkpoint_dir


#: Spark then deletes the shuffle files of a statement at its end; a later run of the same plan would write them again.
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _root(spark: SparkSession) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/burstframe-{spark.sparkContext.applicationId}"


@contextmanager
def _shuffles_removed(spark: SparkSession) -> Iterator[None]:
    before = spark.conf.get(CLEAN_UP)
    spark.conf.set(CLEAN_UP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEAN_UP, before)


def keep(df: DataFrame, *partition_by: str) -> DataFrame:
    """The frame written and read back; with ``partition_by`` a filter on these columns reads its own files only."""
    spark = df.sparkSession
    path = f"{_root(spark)}/{uuid.uuid4().hex}"
    with _shuffles_removed(spark):
        df.write.parquet(path, partitionBy=list(partition_by) or None)
    kept = spark.read.schema(df.schema).parquet(path)
    kept.kept_at = path
    return kept


def _delete(spark: SparkSession, path: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def drop(*kept: DataFrame) -> None:
    """Delete the tables behind frames that ``keep`` returned; neither they nor frames built on them must be used again."""
    for df in kept:
        _delete(df.sparkSession, df.kept_at)


def discard(spark: SparkSession) -> None:
    """Delete every kept table of this application; frames built on them must not be used again."""
    _delete(spark, _root(spark))


#: Rows of a spread scan that one task works on, on average.
SPREAD_ROWS = 20_000


def spread(scan: DataFrame) -> DataFrame:
    """Give a scan one partition per core at least, and no more than ``SPREAD_ROWS`` rows to a task; scans cut that fine stay as they are.

    For row-heavy work only, where the bytes of a split say nothing of its time; ``scan`` must be a plain file scan, so that
    counting its partitions runs no job and counting its rows reads no columns.
    """
    parts = max(scan.sparkSession.sparkContext.defaultParallelism, -(-scan.count() // SPREAD_ROWS))
    return scan.repartition(parts) if scan.rdd.getNumPartitions() < parts else scan
