from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from burstframe import build_session

    s = build_session("tests", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def series(spark):
    """Two series of 41 and 23 bins with ties, flat tops and zero stretches."""
    import numpy as np

    rng = np.random.default_rng(3)
    rows = []
    for burst, n in (("a", 41), ("b", 23)):
        rate = rng.integers(0, 6, n).astype(float)
        for i in range(n):
            rows.append((burst, "x", i, i + 0.5, float(rate[i]), float(np.sqrt(rate[i])), int(rate[i]), 1.0))
    df = spark.createDataFrame(rows, "burst_id string, band string, bin_idx long, t double, rate double, rate_err double, counts long, binsize double")
    return df.cache()
