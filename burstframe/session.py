"""Session settings used by every job."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile

from pyspark.sql import SparkSession

# Runtime SQL settings: safe to apply to a session somebody else created.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot series even when the split costs one more exchange above the join
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # rows may carry arrays of many thousand values: batches for Python are bounded by bytes, too
    "spark.sql.execution.arrow.maxBytesPerBatch": str(64 << 20),
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the operators rely on."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def build_session(app_name: str = "burstframe", master: str | None = None, **conf: str) -> SparkSession:
    """Build a session; cluster-level sizing stays with spark-submit unless given here."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    return tune(builder.getOrCreate())


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Shared checkpoint folder of the cluster; a local one only where none is configured."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if configured:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(configured)
        return configured
    current = spark.sparkContext.getCheckpointDir()
    if current is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        current = fallback or tempfile.mkdtemp(prefix="burstframe-ckpt-", dir=os.environ.get("TMPDIR"))
        if not fallback:
            atexit.register(shutil.rmtree, current, ignore_errors=True)
        spark.sparkContext.setCheckpointDir(current)
    return current
