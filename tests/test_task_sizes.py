"""Work is cut so that neither one task nor one broadcast holds a share that grows with the tables."""

from __future__ import annotations

import re
from datetime import datetime, timedelta
from pathlib import Path

import numpy as np

from burstframe.operators import population as P
from burstframe.operators import reuse
from burstframe.plans import source_queries as Q


def apart(a, b):
    """Degrees between (ra, dec) and (ra, dec)."""
    (r1, d1), (r2, d2) = np.radians(a), np.radians(b)
    return np.degrees(np.arccos(np.clip(np.sin(d1) * np.sin(d2) + np.cos(d1) * np.cos(d2) * np.cos(r1 - r2), -1, 1)))


def test_cross_match_broadcasts_no_exploded_bursts(spark, tmp_path):
    rng = np.random.default_rng(3)
    sky = lambda n: [(i, float(t), float(r), float(d)) for i, t, r, d in zip(range(n), rng.uniform(0, 60, n), rng.uniform(0, 360, n), rng.uniform(-90, 90, n))]
    b, a = sky(80), sky(300)
    frames = []
    for name, rows, key in (("bursts", b, "burst_id"), ("alerts", a, "alert_id")):
        spark.createDataFrame(rows, f"{key} long, t double, ra double, dec double").write.parquet(str(tmp_path / name))
        frames.append(spark.read.parquet(str(tmp_path / name)))
    out = P.cross_match(*frames, 5.0, 30.0)
    before = out._jdf.queryExecution().executedPlan().toString()  # by the sizes of the files, as a large job is planned
    assert not re.search(r"BroadcastExchange[^\n]*\n[^\n]*(Filter|Generate)", before), before
    want = {(x[0], y[0]) for x in b for y in a if abs(x[1] - y[1]) <= 5 and apart(x[2:], y[2:]) <= 30}
    assert {(r["burst_id"], r["alert_id"]) for r in out.collect() if r["alert_id"] is not None} == want and want
    assert {r["burst_id"] for r in out.collect()} == {x[0] for x in b}


def test_files_of_bursts_are_written_by_several_tasks(spark, tmp_path):
    start = datetime(2024, 1, 10)
    rows = [(i, start + timedelta(hours=7 * i % 500), i % 40, "view", float(i % 500)) for i in range(800)]
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double").write.parquet(str(tmp_path / "events.parquet"))
    path = Path(Q.quad_files(spark, str(tmp_path), "_lc").removeprefix("file:"))
    files = list(path.rglob("part-*.txt"))
    assert len(files) == 40 and len({f.name.split("-")[1] for f in files}) > 1


def test_spread_bounds_the_rows_of_a_task(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(reuse, "SPREAD_ROWS", 100)
    spark.range(5000).coalesce(1).write.parquet(str(tmp_path / "t"))
    out = reuse.spread(spark.read.parquet(str(tmp_path / "t")))
    sizes = out.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()
    assert sum(sizes) == 5000 and max(sizes) <= 200 and out.distinct().count() == 5000
