"""Catalog behaviour, rejected rows, stages, streams and a burst that holds most of the rows."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from burstframe.operators import catalog as C
from burstframe.operators import lightcurve as L
from burstframe.operators import temporal as T
from burstframe.plans import stages as G
from burstframe.sources import scans, sinks


def test_insert_keeps_one_row_per_key(spark):
    table = spark.createDataFrame([("a", 1.0)], "name string, v double")
    new = spark.createDataFrame([("a", 9.0), ("b", 2.0), ("b", 3.0), ("c", None)], "name string, v double")
    after, rejected = C.insert_unique(table, new, "name")
    assert sorted(r["name"] for r in after.collect()) == ["a", "b", "c"]
    assert sorted((r["name"], r["reason"]) for r in rejected.collect()) == [("a", "key exists"), ("b", "repeated in batch")]


def test_update_takes_nulls_and_stamps(spark):
    table = spark.sql("SELECT 'a' AS name, 1.0D AS v, timestamp'2020-01-01' AS updated_at UNION ALL SELECT 'b', 2.0D, timestamp'2020-01-01'")
    upd = spark.createDataFrame([("a", None)], "name string, v double")
    got = {r["name"]: r for r in C.update_by_key(table, upd, "name").collect()}
    assert got["a"]["v"] is None and got["a"]["updated_at"].year > 2020
    assert got["b"]["v"] == 2.0 and got["b"]["updated_at"].year == 2020


def test_append_keeps_keys_unique(spark, tmp_path):
    root = str(tmp_path / "written")
    assert sinks.written_table(spark, root, "bursts").count() == 0
    rows = spark.createDataFrame([("a", 1.0, "x"), ("a", 1.0, "x"), ("b", None, "x")], "burst_name string, redshift double, beyond string")
    assert [(r["burst_name"], r["reason"]) for r in sinks.append_rows(rows, root, "bursts").collect()] == [("a", "repeated in batch")]
    again = spark.createDataFrame([("a", 2.0), ("c", 3.0)], "burst_name string, redshift double")
    assert [(r["redshift"], r["reason"]) for r in sinks.append_rows(again, root, "bursts").collect()] == [(2.0, "key exists")]
    got = sorted((r["burst_name"], r["redshift"]) for r in sinks.written_table(spark, root, "bursts").collect())
    assert got == [("a", 1.0), ("b", None), ("c", 3.0)]
    for _ in range(2):
        assert sinks.append_rows(rows, root, "observations").count() == 0
    assert sinks.written_table(spark, root, "observations").count() == 6
    with pytest.raises(ValueError):
        sinks.append_rows(rows, root, "secrets")


def test_tables_and_export(spark, tmp_path):
    sinks.create_tables(spark, str(tmp_path / "tables"), buckets=2)
    assert sinks.export_table(spark, "bursts").count() == 0
    with pytest.raises(ValueError):
        sinks.export_table(spark, "secrets; drop")
    for t in sinks.TABLES:
        spark.sql(f"DROP TABLE {t}")


def test_scans_reject_bad_lines(spark, tmp_path):
    (tmp_path / "GRB010101A_64ms_x.txt").write_text("1 1 1 2 2 3 3 4 4\n2 1 1\n\n# note\n3 1 1 2 2 3 3 4 4\n")
    rows, bad = scans.four_band_light_curves(spark, str(tmp_path))
    assert rows.count() == 8 and bad.count() == 1
    assert rows.select("burst_name", "binsize").distinct().collect()[0].asDict() == {"burst_name": "GRB010101A", "binsize": 0.064}
    with pytest.raises(ValueError):
        scans.light_curve_columns(spark.range(1).toDF("time"))
    empty = tmp_path / "names.txt"
    empty.write_text("  \n\n")
    with pytest.raises(ValueError):
        scans.work_list(spark, str(empty))


def test_binning_edges(spark):
    ph = spark.createDataFrame([("a", "x", t, 1.0) for t in (0.0, 0.5, 1.0, 2.0)] + [("b", "x", 5.0, 1.0)] + [("c", "x", -0.25, 1.0), ("c", "x", 0.75, 1.0)],
                               "burst_id string, band string, t double, energy double")
    got = {}
    for r in L.bin_events(ph).collect():
        got.setdefault(r["burst_id"], {})[r["bin_idx"]] = r["counts"]
    # the last bin takes its right edge; one single whole-second photon spans nothing and gives no bin
    assert got == {"a": {0: 2, 1: 2}, "c": {0: 1, 1: 1}}
    odd = {(r["burst_id"], r["bin_idx"]): r["counts"] for r in L.bin_events(ph, binsize=0.3).collect()}
    edges = np.arange(0, 2 + 0.3, 0.3)
    want, _ = np.histogram([0.0, 0.5, 1.0, 2.0], edges)
    assert [odd[("a", i)] for i in range(len(want))] == want.tolist()


def test_one_burst_with_most_rows(spark):
    """A series much longer than a chunk gives what plain numpy gives."""
    n = 30000
    df = spark.range(n).select(
        F.lit("hot").alias("burst_id"), F.lit("x").alias("band"), F.col("id").alias("bin_idx"), (F.col("id") + 0.5).alias("t"),
        F.pmod(F.xxhash64("id"), F.lit(50)).cast("double").alias("rate"), F.lit(1.0).alias("binsize"), F.lit(1.0).alias("rate_err"))
    few = spark.range(10).select(F.lit("cold").alias("burst_id"), *[F.lit("x").alias("band"), F.col("id").alias("bin_idx"), (F.col("id") + 0.5).alias("t"),
                                 F.lit(2.0).alias("rate"), F.lit(1.0).alias("binsize"), F.lit(1.0).alias("rate_err")])
    got = {r["burst_id"]: r for r in T.duration(df.unionByName(few)).collect()}
    rate = np.array([r[0] for r in df.orderBy("bin_idx").select("rate").collect()])
    c = np.cumsum(rate) / rate.sum()
    t = np.arange(n) + 0.5
    assert got["hot"]["duration"] == pytest.approx(np.interp(0.95, c, t) - np.interp(0.05, c, t))
    acf = {r["lag"]: r["acf"] for r in T.autocorrelation(df, max_lag=50).collect()}
    x = rate - rate.mean()
    assert len(acf) == 50 and acf[17] == pytest.approx((x[:-17] * x[17:]).sum() / (x * x).sum())


def test_stage_selection(spark):
    bursts = spark.createDataFrame([(1, 0.5), (2, 30.0)], "burst_id long, t90 double")
    tables, status = G.run(spark, {"bursts": bursts}, skip=["summary"])
    got = {r["stage"]: r["status"] for r in status.collect()}
    assert got == {"acquisition": "completed", "temporal": "skipped", "spectral": "skipped", "afterglow": "skipped",
                   "classification": "completed", "summary": "skipped"}
    assert {r["burst_id"]: r["duration_class"] for r in tables["classification"].collect()} == {1: "Short", 2: "Long"}
    with pytest.raises(ValueError):
        G.run(spark, {"bursts": bursts}, ["no such stage"])


def test_failed_stage_is_reported(spark):
    bad = spark.createDataFrame([(1,)], "burst_id long")
    _, status = G.run(spark, {"bursts": bad, "photons": bad})
    got = {r["stage"]: r["status"] for r in status.collect()}
    assert got["temporal"] == "failed" and got["acquisition"] == "completed"


def test_insert_keeps_every_rejected_copy(spark):
    from burstframe.operators.catalog import insert_unique

    table = spark.createDataFrame([("a", 1.0)], "name string, t90 double")
    new = spark.createDataFrame([("a", 2.0), ("a", 2.0), ("b", 3.0), ("b", 3.0), ("b", 3.0), ("b", 4.0), ("c", 5.0)], "name string, t90 double")
    after, rejected = insert_unique(table, new, "name")
    assert sorted(r["name"] for r in after.collect()) == ["a", "b", "c"]
    reasons = sorted((r["name"], r["reason"]) for r in rejected.collect())
    assert reasons == [("a", "key exists")] * 2 + [("b", "repeated in batch")] * 3
