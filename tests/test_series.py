"""Chunked ordered operators against plain numpy, with chunks far smaller than the series."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from burstframe.operators import lags, series as S
from burstframe.operators import temporal as T

K = ["burst_id", "band"]


def arrays(df, *cols):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["burst_id"], r["bin_idx"])):
        out.setdefault(r["burst_id"], []).append([r[c] for c in cols])
    return {k: np.array(v, dtype=float) for k, v in out.items()}


@pytest.mark.parametrize("size", [1, 4, 7, 4096])
def test_running_sums(series, size):
    got = arrays(S.running_sums(series, K, "bin_idx", {"c": F.col("rate")}, size), "rate", "c")
    for a in got.values():
        assert np.allclose(np.cumsum(a[:, 0]), a[:, 1])


@pytest.mark.parametrize("size", [3, 4, 4096])
def test_sliding(series, size):
    out = S.sliding(series, K, "bin_idx", 3, lambda w: {"p": F.lag("rate", 3).over(w), "n": F.lead("rate", 2).over(w)}, size)
    assert out.count() == series.count()
    for a in arrays(out, "rate", "p", "n").values():
        r = a[:, 0]
        assert np.array_equal(a[3:, 1], r[:-3]) and np.isnan(a[:3, 1]).all()
        assert np.array_equal(a[:-2, 2], r[2:]) and np.isnan(a[-2:, 2]).all()


@pytest.mark.parametrize("spacing", ["log", "uniform", "same"])
def test_with_position(spark, spacing):
    n = 500
    t = {"log": np.logspace(-6, 6, n), "uniform": np.arange(n) * 0.1, "same": np.zeros(n)}[spacing]
    order = np.random.default_rng(0).permutation(n)
    df = spark.createDataFrame([("a", float(t[i]), int(i)) for i in order], "k string, t double, i long")
    got = {r["i"]: r["pos"] for r in S.with_position(df, ["k"], ["t", "i"], "pos").collect()}
    assert got == {i: i for i in range(n)}


@pytest.mark.parametrize("kind", ["equal", "outliers", "log"])
def test_ranges_are_even_for_ties_and_clusters(spark, kind):
    n = 200_000
    v = {"equal": F.lit(1.0), "outliers": F.when(F.col("id") == 0, -1e9).when(F.col("id") == 1, 1e9).otherwise(F.col("id") % 7 * 1e-6),
         "log": F.pow(F.lit(10.0), F.col("id") * 12.0 / n - 6)}[kind]
    df = spark.range(n, numPartitions=8).select(F.lit("a").alias("k"), v.cast("double").alias("v"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # else Spark puts these few rows together
    try:
        sizes = [r["count"] for r in S.ranged(df, ["k"], ["v"]).groupBy("_part").count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert max(sizes) < 2 * n / 8
    got = S.with_position(df, ["k"], ["v"], "pos", "n").agg(F.min("pos"), F.max("pos"), F.countDistinct("pos"), F.max("n")).first()
    assert tuple(got) == (0, n - 1, n, n)
    values = np.array([r["v"] for r in df.collect()])
    assert S.median_by_position(df, ["k"], "v", "m").first()["m"] == np.median(values)


def test_dense_grid_crosses_chunks(spark):
    df = spark.createDataFrame([("a", 10), ("b", 1), ("c", 0)], "k string, n long")
    got = sorted((r["k"], r["i"]) for r in S.dense_grid(df, F.col("n"), "i", size=4).collect())
    assert got == [("a", i) for i in range(10)] + [("b", 0)]


@pytest.mark.parametrize("block", [4, 5, 4096])
def test_lag_products(series, block):
    n = series.groupBy(*K).agg(F.count(F.lit(1)).alias("n"))
    rows = series.join(n, K).withColumn("y", F.col("rate") * F.col("t"))
    got = {(r["burst_id"], r["lag"]): r["sxy"] for r in
           lags.lag_products(rows, K, "bin_idx", "rate", "y", -F.col("n"), F.col("n"), "n", block).collect()}
    for b, a in arrays(rows, "rate", "y").items():
        m = len(a)
        for lag in range(-m + 1, m):
            x = a[max(0, -lag): m - max(0, lag), 0]
            y = a[max(0, lag): m - max(0, -lag), 1]
            assert got[(b, lag)] == pytest.approx(float((x * y).sum()))


@pytest.mark.parametrize("block", [5, 4096])
def test_autocorrelation(series, block):
    got = {(r["burst_id"], r["lag"]): r["acf"] for r in T.autocorrelation(series, block=block).collect()}
    for b, a in arrays(series, "rate").items():
        x = a[:, 0] - a[:, 0].mean()
        full = np.correlate(x, x, "full")[len(x) - 1:]
        want = full / full[0]
        assert len([k for k in got if k[0] == b]) == len(x) // 4
        for k in range(len(x) // 4):
            assert got[(b, k)] == pytest.approx(want[k])


@pytest.mark.parametrize("block", [3, 4, 4096])
def test_pulses(series, block):
    got = {}
    for r in T.detect_pulses(series, K, block=block).collect():
        got.setdefault(r["burst_id"], []).append((r["peak_time"], r["peak_rate"], r["start_time"], r["end_time"]))
    for b, a in arrays(series, "rate", "t").items():
        rate, t, n = a[:, 0], a[:, 1], len(a)
        want, i = [], 1
        while i < n - 1:
            j = i
            while j < n - 1 and rate[j + 1] == rate[i]:
                j += 1
            if j < n - 1 and rate[i - 1] < rate[i] > rate[j + 1] and rate[i] >= rate.mean():
                p, half = (i + j) // 2, rate[i] / 2
                lo = p
                while lo > 0 and rate[lo - 1] < half:
                    lo -= 1
                hi = p
                while hi < n - 1 and rate[hi + 1] < half:
                    hi += 1
                want.append((t[p], rate[p], t[lo], t[hi]))
            i = j + 1
        assert sorted(got[b]) == sorted(want)


def test_correlation_errors_do_not_depend_on_blocks(spark):
    rng = np.random.default_rng(1)
    n = 12
    x, y = rng.normal(size=n), rng.normal(size=n)
    pair = spark.createDataFrame(
        [("a", i, float(i), n, 1.0, 2.0, 3.0, 0.5, 0.4, float(x[i]), float(y[i])) for i in range(n)],
        "burst_id string, pos long, t double, n long, dt double, low double, high double, low_err double, high_err double, x double, y double")
    one = {r["lag"]: r["ccf_err"] for r in T.cross_correlation_errors(pair, 3000).collect()}
    many = {r["lag"]: r["ccf_err"] for r in T.cross_correlation_errors(pair, 3000, block=5).collect()}
    # noise is drawn per block, so the two runs are independent simulations of the same thing
    for lag in range(-n + 3, n - 2):
        assert many[lag] == pytest.approx(one[lag], rel=0.15)
    assert one[n] == many[-n] == 0.0


def test_bootstrap_error_matches_resampling(spark, series):
    got = {r["burst_id"]: r["t90_err"] for r in T.t90_bootstrap_error(series, 2000).collect()}
    rng = np.random.default_rng(0)
    for b, a in arrays(series, "rate", "t").items():
        d = []
        for _ in range(2000):
            idx = np.sort(rng.integers(0, len(a), len(a)))
            c = np.cumsum(a[idx, 0])
            if c[-1] > 0:
                d.append(np.interp(0.95, c / c[-1], a[idx, 1]) - np.interp(0.05, c / c[-1], a[idx, 1]))
        assert got[b] == pytest.approx(np.std(d), rel=0.1)


@pytest.mark.parametrize("size,values", [(4, 1 << 18), (8, 24), (16, 1)])
def test_lag_products_of_many_blocks(spark, size, values, monkeypatch):
    """Long, short and one-bin series; few and single frequencies in a group; all lags against direct sums."""
    monkeypatch.setattr(lags, "GROUP_VALUES", values)
    rng = np.random.default_rng(size)
    data = {name: rng.normal(size=(n, 2)) for name, n in (("a", 131), ("b", 64), ("c", 9), ("d", 1), ("e", 33))}
    rows = [(name, i, float(v[i, 0]), float(v[i, 1]), len(v)) for name, v in data.items() for i in range(len(v))]
    df = spark.createDataFrame(rows, "k string, pos long, x double, y double, n long").repartition(4)
    got = {(r["k"], r["lag"]): r["sxy"] for r in lags.lag_products(df, ["k"], "pos", "x", "y", -F.col("n"), F.col("n"), "n", size).collect()}
    for name, v in data.items():
        n = len(v)
        for lag, want in zip(range(1 - n, n), np.correlate(v[:, 1], v[:, 0], "full")):
            assert got.pop((name, lag)) == pytest.approx(want, abs=1e-9)
    assert not got
    some = {r["lag"] for r in lags.lag_products(df.where("k = 'a'"), ["k"], "pos", "x", "y", F.lit(0), F.lit(5), "n", size).collect()}
    assert some == set(range(6))


def test_bootstrap_in_draw_order_equals_a_loop(spark, series):
    import hashlib

    zero = spark.createDataFrame([("z", "x", i, i + 0.5, 0.0, 0.0, 0, 1.0) for i in range(4)], series.schema)
    rows = series.unionAll(zero)
    got = {r["burst_id"]: r for r in T.t90_bootstrap_draw_order(rows, 30, seed=4).collect()}
    by = {}
    for r in rows.orderBy("burst_id", "bin_idx").collect():
        by.setdefault(r["burst_id"], []).append((r["t"], r["rate"] * r["binsize"]))
    assert set(got) == set(by)
    for burst, bins in by.items():
        t, c = map(np.array, zip(*bins))
        out = []
        for s in range(30):
            draw = [int(int(hashlib.md5(f"4|{burst}|x|{s}|{i}".encode()).hexdigest()[:13], 16) / 2**52 * len(t)) for i in range(len(t))]
            cum = np.cumsum(c[draw])
            if cum[-1] > 0:
                f, x = cum / cum[-1], t[draw]
                p = np.interp([(1 - 0.9) / 2, 1 - (1 - 0.9) / 2], f, x)
                out.append(p[1] - p[0])
        assert got[burst]["n_valid"] == len(out)
        assert got[burst]["t90_err"] == pytest.approx(np.std(out) if out else 0.0, abs=1e-9)


def test_interpolation_of_clustered_times_in_even_ranges(spark, monkeypatch):
    """Times that differ by powers of ten, many ties, few ranges of rows: as numpy, one row a target."""
    from burstframe.operators.lightcurve import regrid_linear

    rng = np.random.default_rng(8)
    src, tgt = [], []
    for k in ("a", "b", "c"):
        x = np.unique(np.concatenate([10 ** rng.uniform(-6, 6, 200), [0.0, 1.0, 2.0]]))
        y = rng.normal(size=len(x))
        at = np.concatenate([10 ** rng.uniform(-7, 7, 300), x[:20], [1.0] * 5, [-3.0]])
        if k != "c":
            src += [(k, float(a), float(b)) for a, b in zip(x, y)]
        tgt += [(k, i, float(a), float(np.interp(a, x, y, left=0, right=0)) if k != "c" else 0.0) for i, a in enumerate(at)]
    src.append(("a", None, 5.0))
    tgt.append(("a", 999, None, 0.0))
    source = spark.createDataFrame(src, "k string, t double, rate double")
    target = spark.createDataFrame(tgt, "k string, i int, t double, want double")
    got = regrid_linear(source, target, ["k"], ["rate"]).collect()
    assert len(got) == len(tgt)
    for r in got:
        assert r["rate"] == pytest.approx(r["want"], rel=1e-9, abs=1e-9)
    near = {(r["k"], r["i"]): r for r in S.asof_merge(source, target, ["k"], "t", ["rate"]).collect()}
    assert near[("c", 0)]["_left"] is None and near[("c", 0)]["_right"] is None
    parts = S.ranged(source.where("t IS NOT NULL"), ["k"], ["t"]).groupBy("_part").count().collect()
    assert max(p["count"] for p in parts) <= 3 * len(src) / len(parts)
    assert regrid_linear(source.limit(0), target, ["k"], ["rate"]).where("rate <> 0").count() == 0
