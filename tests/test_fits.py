"""Fits recover noiseless inputs; grids and windows agree with direct evaluation."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from burstframe.operators import afterglow as A
from burstframe.operators import blocks as B
from burstframe.operators import intervals as I
from burstframe.operators import population as P
from burstframe.operators import spectra as S
from burstframe.operators import temporal as T


def points(spark, t, f):
    rows = [("a", float(x), float(y), float(0.1 * y)) for x, y in zip(t, f)]
    return spark.createDataFrame(rows, "burst_id string, t double, flux double, flux_err double")


def test_power_law_decay(spark):
    t = np.logspace(0, 3, 40)
    r = A.power_law_decay(points(spark, t, 7 * t**-1.234), errors=True).first()
    assert r["decay_index"] == pytest.approx(1.234, abs=1e-3) and r["norm"] == pytest.approx(7, rel=5e-3)
    assert r["decay_index_err"] > 0 and r["decay_index_err"] == pytest.approx(r["decay_index_err_compat"] * 2**0.5)


def test_broken_power_law(spark):
    # the model is scaled by the first flux itself, so the first point must lie where its shape is one
    x0 = 0.6
    for _ in range(100):  # x^1.4 + x^4.2 = 1
        x0 = (1 - x0**4.2) ** (1 / 1.4) * 0.5 + x0 * 0.5
    t = np.logspace(0, 2, 60)
    x = t * x0
    f = 10 * (x**1.4 + x**4.2) ** -0.5
    fit = A.broken_power_law(A.numbered(points(spark, t, f))).first()
    assert fit["fit_success"] and fit["chi_sq"] < 1e-3 and fit["dof"] == 56


def test_jet_break_and_plateau(spark):
    t = np.linspace(0.05, 2, 60)
    f = np.where(t < 1, t**-0.3, t**-2.5)
    rows = A.numbered(points(spark, t, f))
    j = A.detect_jet_break(rows).first()
    assert j["has_jet_break"] and j["steepening"] > 1
    p = A.detect_plateau(rows).first()
    assert p["has_plateau"] and p["end_time"] < 1.2 and p["mean_alpha"] == pytest.approx(0.3, abs=0.05)


@pytest.mark.parametrize("n", [35, 47, 230])
def test_plateau_windows_agree_with_direct_fits(spark, n):
    rng = np.random.default_rng(n)
    t = np.sort(rng.uniform(1, 500, n))
    f = t**-0.5 * rng.uniform(0.7, 1.3, n)
    got = A.detect_plateau(A.numbered(points(spark, t, f))).first()
    w, grid, mids, indices = max(3, n // 10), np.linspace(0.1, 5.0, 99), [], []
    for s in range(n - w):
        x, y = t[s : s + w], f[s : s + w]
        m = x[None, :] ** -grid[:, None]
        wt = 1 / (0.1 * y) ** 2
        norm = np.clip((m * y * wt).sum(1) / (m * m * wt).sum(1), 0.5 * y.min(), 2 * y.max())
        alpha = grid[np.argmin(((y - norm[:, None] * m) ** 2 * wt).sum(1))]
        if abs(alpha) < 0.5:
            mids.append(t[s + w // 2])
            indices.append(alpha)
    assert got["has_plateau"] == bool(mids)
    if mids:
        assert (got["start_time"], got["end_time"]) == (min(mids), max(mids)) and got["mean_alpha"] == pytest.approx(np.mean(indices))


def test_spectral_fit_recovers_a_power_law(spark):
    e = np.linspace(10, 500, 50)
    n = 3000 * (e / 100) ** -1.5
    df = spark.createDataFrame([("a", float(x), float(y), 100.0, 1.0) for x, y in zip(e, n)],
                               "burst_id string, energy double, counts double, exposure double, area double")
    r = S.fit_model(df, "PL", errors=True).first()
    assert r["params"]["index"] == pytest.approx(-1.5, abs=1e-3) and r["params"]["norm"] == pytest.approx(30, rel=1e-2)
    assert 0 < r["errors"]["index"] < 0.1
    with pytest.raises(ValueError):
        S.fit_spectra(df, ["PL", "nonsense"])
    best = S.choose_model(S.fit_spectra(df, ["PL", "BB"])).first()
    assert best["model"] == "PL"


def test_fred_pulse(spark):
    t = np.arange(0, 60, 0.5) + 0.25
    dt = np.maximum(t - 5, 1e-9)
    rate = np.where(t > 5, 80 * np.exp(-3 / dt - dt / 8), 0)
    df = spark.createDataFrame([("a", "x", i, float(x), float(y), 1.0, 0.5) for i, (x, y) in enumerate(zip(t, rate))],
                               "burst_id string, band string, bin_idx long, t double, rate double, rate_err double, binsize double")
    r = T.fit_fred_pulse(df).first()
    assert r["fit_success"] and r["chi_sq"] < 1e-3


def test_lag_fit_sees_the_shift(spark):
    n = 80
    g = np.exp(-0.5 * ((np.arange(n) - 30) / 4.0) ** 2) * 50
    h = np.roll(g, 6)
    rows = [("a", b, i, i + 0.5, float(v[i]), 1.0, 1.0) for b, v in (("lo", g), ("hi", h)) for i in range(n)]
    lc = spark.createDataFrame(rows, "burst_id string, band string, bin_idx long, t double, rate double, rate_err double, binsize double")
    assert T.simple_lag(lc, "lo", "hi").first()["lag"] == 6.0
    pair = T.prepare_lag_pair(lc, "lo", "hi", 0.0, 80.0)
    fit = T.spectral_lag(pair, n_ccf_sims=100, n_lag_sims=20).first()
    assert fit["lag"] == pytest.approx(6, abs=1.0) and fit["lag_err"] < 3


def test_polynomial_background(spark):
    t = np.arange(-50, 50, 0.5)
    rate = 5 + 0.03 * t + 0.002 * t**2
    rows = [("a", "x", i, float(x), float(y), 0.5) for i, (x, y) in enumerate(zip(t, rate))]
    lc = spark.createDataFrame(rows, "burst_id string, band string, bin_idx long, t double, rate double, rate_err double")
    iv = spark.createDataFrame([("a", "x", 0.0, 5.0)], "burst_id string, band string, tstart double, tstop double")
    r = I.polynomial_background(lc, iv).first()
    assert r["poly_order"] == 2 and r["coefficients"] == pytest.approx([0.002, 0.03, 5], rel=1e-6)
    assert (r["pre_interval"]["lo"], r["post_interval"]["hi"]) == (-50.0, 49.5)


@pytest.mark.parametrize("fitness", ["events", "measures"])
def test_change_points_are_optimal(fitness):
    rng = np.random.default_rng(5)
    n = 10
    edges = np.arange(n + 1.0)
    a = rng.integers(1, 9, n).astype(float)
    b = None if fitness == "events" else a * rng.normal(3, 2, n)
    prior = 4.0 - np.log(73.53 * 0.01 * n**-0.478)

    def fit(i, j):
        s = a[i:j].sum()
        return s * np.log(s / (edges[j] - edges[i])) if fitness == "events" else b[i:j].sum() ** 2 / (2 * s)

    def score(starts):
        ends = [*starts[1:], n]
        return sum(fit(i, j) - prior for i, j in zip(starts, ends))

    every = [[0, *[i + 1 for i in range(n - 1) if m >> i & 1]] for m in range(2 ** (n - 1))]
    got = B.change_points(edges, fitness, 0.01, a, b).tolist()
    assert score(got) == pytest.approx(max(score(s) for s in every))


def test_orthogonal_fits(spark):
    rng = np.random.default_rng(2)
    x = rng.uniform(1, 3, 400)
    y = 0.6 * x + 1
    df = spark.createDataFrame([(float(10**u), float(10**v)) for u, v in zip(x, y)], "x double, y double")
    for method in ("odr", "odr_plain", "ols"):
        r = P.sample_fit(df, "x", "y", method).first()
        assert r["slope"] == pytest.approx(0.6, abs=1e-6) and r["intercept"] == pytest.approx(1, abs=1e-5) and r["n_points"] == 400


def test_weighted_orthogonal_fit_with_equal_errors_is_the_plain_one(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(0, 1, 300)
    y = 1.5 * x + rng.normal(0, 0.5, 300)
    df = spark.createDataFrame([(float(u), float(v), 0.1, 0.1) for u, v in zip(x, y)], "lx double, ly double, sx double, sy double")
    a, b = P.orthogonal_weighted(df).first(), P.orthogonal_unweighted(df).first()
    assert a["slope"] == pytest.approx(b["slope"], rel=1e-5) and a["intercept"] == pytest.approx(b["intercept"], abs=1e-5)


def test_mixture_weights_and_labels(spark):
    from burstframe.operators import mixture as X

    rng = np.random.default_rng(6)
    pts = np.vstack([rng.normal((-0.5, 0.3), 0.2, (150, 2)), rng.normal((1.4, -0.1), 0.3, (350, 2))])
    df = spark.createDataFrame([(float(a), float(b)) for a, b in pts], "log_t90 double, log_hr double")
    for kind in X.TYPES:
        comps = X.fit_mixture(df, covariance_type=kind, max_iter=40)
        assert sum(c[0] for c in comps) == pytest.approx(1.0)
        short = comps[X.short_index(comps)]
        assert short[0] == pytest.approx(0.3, abs=0.05) and short[1][0] == pytest.approx(-0.5, abs=0.1)
    with pytest.raises(ValueError):
        X.fit_mixture(df, covariance_type="odd")
    with pytest.raises(ValueError):
        X.predict(df, [])


def test_registered_lag_errors_use_all_simulations(spark, monkeypatch):
    """The registered queries leave the numbers of simulations to the operators."""
    from burstframe.operators import temporal as T
    from burstframe.plans import QUERIES, temporal_queries

    seen = []
    monkeypatch.setattr(temporal_queries, "lag_pair", lambda spark, d: None)
    monkeypatch.setattr(T, "spectral_lag", lambda pair, n_ccf_sims=10000, n_lag_sims=1000: seen.append((n_ccf_sims, n_lag_sims)))
    monkeypatch.setattr(T, "cross_correlation_errors", lambda pair, n_sims=10000: seen.append(n_sims))
    for name in ("spectral_lag_with_errors", "cross_correlation_errors"):
        QUERIES[name](spark, "")
    assert seen == [(10000, 1000), 10000]
