"""Packed fits: the same results as the distributed rounds, and no row or table per grid point or step."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from burstframe.operators import afterglow as A
from burstframe.operators import fit as fits
from burstframe.operators import local_fit


def decays(spark):
    rng = np.random.default_rng(5)
    rows = []
    for k in range(6):
        t = np.logspace(0, 2, 12 + k)
        f = (3 + k) * t ** -(0.8 + 0.3 * k) * np.exp(0.05 * rng.standard_normal(len(t)))
        rows += [(f"b{k}", float(x), float(y), float(0.1 * y)) for x, y in zip(t, f)]
    rows += [("b0", 5.0, None, None), ("lost", 3.0, None, None), (None, 1.0, 2.0, 0.2)]
    return spark.createDataFrame(rows, "burst_id string, t double, flux double, flux_err double")


def test_packed_fits_equal_rounds(spark, monkeypatch):
    points = decays(spark)
    packed = {r["burst_id"]: r for r in A.power_law_decay(points).collect()}
    monkeypatch.setattr(local_fit, "POINTS", 0)
    rounds = {r["burst_id"]: r for r in A.power_law_decay(points).collect()}
    assert set(packed) == set(rounds) == {"lost", *(f"b{k}" for k in range(6))}
    for k, r in rounds.items():
        assert (packed[k]["n_points"], packed[k]["fit_success"]) == (r["n_points"], r["fit_success"])
        for c in ("decay_index", "norm", "chi_sq"):
            assert packed[k][c] == (None if r[c] is None else pytest.approx(r[c], rel=1e-5))
    assert not packed["lost"]["fit_success"]


def test_short_series_are_written_once(spark, monkeypatch):
    written = []
    monkeypatch.setattr(fits, "keep", lambda df: written.append(df) or df)
    monkeypatch.setattr(fits, "descend", lambda *a: pytest.fail("rounds for short series"))
    out = A.power_law_decay(decays(spark).where(F.col("burst_id") != "lost"))
    assert out.where("fit_success").count() == 6 and len(written) == 1


def test_packed_windows_equal_running_sums(spark, monkeypatch):
    rng = np.random.default_rng(7)
    rows = []
    for k, n in enumerate((9, 10, 37, 64)):
        t = np.arange(1.0, n + 1)
        f = 5 * t**-0.4 * np.exp(0.2 * rng.standard_normal(n))
        rows += [(f"b{k}", float(x), None if k == 3 and i % 7 == 0 else float(y), None if k == 3 and i % 7 == 0 else float(0.1 * y)) for i, (x, y) in enumerate(zip(t, f))]
    rows = A.numbered(spark.createDataFrame(rows, "burst_id string, t double, flux double, flux_err double"))
    base = rows.filter("n >= 10").withColumn("_w", F.greatest(F.lit(3), F.floor(F.col("n") / 10)).cast("long"))
    key = ("burst_id", "_s", "_w")
    packed = {tuple(r[c] for c in key): r["_alpha"] for r in A._packed_indices(base, ["burst_id"], 99).collect()}
    sums = {tuple(r[c] for c in key): r["_alpha"] for r in A._window_indices(base, ["burst_id"], 99).collect()}
    assert len(packed) == 7 + 34 + 58 and packed == pytest.approx(sums)
    whole = {r["burst_id"]: r.asDict() for r in A.detect_plateau(rows).collect()}
    monkeypatch.setattr(A, "POINTS", 0)
    for r in A.detect_plateau(rows).collect():
        assert whole[r["burst_id"]] == {k: v if v is None or isinstance(v, (str, bool)) else pytest.approx(v) for k, v in r.asDict().items()}


def test_multi_band_grid_is_not_shuffled(spark):
    points = spark.createDataFrame([("a", b, float(t), 9.0 * t**-1.5, 0.1) for b in "xy" for t in range(1, 12)], "burst_id string, band string, t double, flux double, flux_err double")
    plan = A.multi_band_fit(points)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(burst_id" in plan
    assert not [line for line in plan.splitlines() if "Exchange hashpartitioning" in line and ("_tb" in line or "_side" in line)]


def test_epeak_of_empty_energy(spark, tmp_path):
    from datetime import datetime

    from burstframe.plans import QUERIES

    rows = [(1, "view", datetime(2024, 1, 16), 0.0), (2, "view", datetime(2024, 1, 16), 3.0), (2, "view", datetime(2024, 1, 16), 1.0)]
    spark.createDataFrame(rows, "user_id long, event_type string, ts timestamp_ntz, value double").write.parquet(str(tmp_path / "events.parquet"))
    out = {r["burst_id"]: r for r in QUERIES["epeak_evolution_series"](spark, str(tmp_path)).collect()}
    assert np.isnan(out[1]["epeak"]) and out[1]["n"] == 1 and out[2]["epeak"] == 2.5


BANDS = "burst_id string, band string, t double, flux double, flux_err double"


def band_points(seed=3):
    """Bursts with repeated rows, missing values, one band, one time, early times and a missing key."""
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(40):
        for _ in range(int(rng.integers(2, 18))):
            rows.append((f"b{i}", "xyz"[int(rng.integers(0, 3))], float(rng.integers(1, 60)), float(rng.uniform(0.5, 40)), float(rng.uniform(0.1, 2))))
    rows += rows[:30]
    rows += [("b1", "x", None, 3.0, 0.3), ("b2", "y", 4.0, None, None), ("b3", "q", 5.0, None, 0.5), ("b4", "r", None, 2.0, 0.2), ("one", "x", 1.0, 2.0, 0.1), ("one", "x", 2.0, 2.0, 0.1),
             ("same", "x", 3.0, 2.0, 0.1), ("same", "y", 3.0, 2.0, 0.1), ("early", "x", 0.0, 2.0, 0.1), ("early", "y", 3.0, 2.0, 0.1), (None, "x", 1.0, 2.0, 0.1), (None, "y", 4.0, 1.0, 0.1),
             ("lost", "x", 1.0, None, None), ("lost", "y", 9.0, None, None)]
    return rows


def least_chi(points, n_tb=20, n_alpha=10):
    """Least chi2 of complete points by plain loops."""
    t = [p[2] for p in points]
    best = np.inf
    for k in range(n_tb):
        tb = np.exp(np.log(min(t)) + (np.log(max(t)) - np.log(min(t))) * (k + 1) / (n_tb + 1.0))
        chi = 0.0
        for name in sorted({p[1] for p in points}):
            x, f, w = (np.array([v(p) for p in points if p[1] == name]) for v in (lambda p: p[2] / tb, lambda p: p[3], lambda p: 1 / p[4] ** 2))
            found = []
            for a in range(n_alpha):
                for b in range(n_alpha):
                    m = np.where(x >= 1, x ** -(0.5 + 4.5 * b / (n_alpha - 1)), x ** -(0.1 + 2.9 * a / (n_alpha - 1)))
                    norm = max(0.01, min(100.0, (f * m * w).sum() / (m * m * w).sum()))
                    found.append((w * (f - norm * m) ** 2).sum())
            chi += min(found)
        best = min(best, chi)
    return best


def plain(df):
    return {r["burst_id"]: (r["t_break"], r["chi_sq"], r["dof"], r["fit_success"],
                            r["bands"] and {k: tuple(v) for k, v in r["bands"].items()}) for r in df.collect()}


def test_multi_band_blocks_equal_loops_and_the_way_of_long_bursts(spark, monkeypatch):
    rows = band_points()
    points = spark.createDataFrame(rows, BANDS)
    got = plain(A.multi_band_fit(points))
    assert len(got) == 45 and [got[k][3] for k in ("one", "same", None, "lost", "early")] == [False, False, False, False, True]
    assert got["early"] == (None, 0.0, -7, True, {"x": (0.1, 0.5, 100.0), "y": (0.1, 0.5, 100.0)})
    for i in range(5, 40):
        own = [r for r in rows if r[0] == f"b{i}"]
        if len({r[1] for r in own}) > 1 and len({r[2] for r in own}) > 1:
            chi = least_chi(own)
            assert got[f"b{i}"][1] == pytest.approx(chi, abs=1e-7, rel=1e-9) and got[f"b{i}"][2] == len(own) - 1 - 3 * len({r[1] for r in own})
    for most in (9, 0):  # some bursts the one way, some the other, then all the other way
        monkeypatch.setattr(A, "POINTS", most)
        assert plain(A.multi_band_fit(points)) == got


def test_multi_band_blocks_do_not_depend_on_batches(spark):
    """Bursts that go over the borders of batches, and blocks of one burst, give the same fits."""
    points = spark.createDataFrame(band_points(4), BANDS).coalesce(1)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    got = plain(A.multi_band_fit(points))
    try:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
        assert plain(A.multi_band_fit(points)) == got
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_multi_band_pairs_are_no_rows(spark):
    """A point is a row for each break, with the powers of its side as columns; neither indices nor pairs of them become rows."""
    points = spark.createDataFrame(band_points(), BANDS)
    plan = A.multi_band_fit(points)._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "_side" not in plan and "_s0" not in plan
