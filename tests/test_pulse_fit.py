"""Joint fits of several pulses recover known pulses and agree with a dense solver."""

from __future__ import annotations

import numpy as np
import pytest

from burstframe.operators import pulse_fit as P

SCHEMA = "burst_id string, band string, t double, rate double, rate_err double"


def fred(t, amplitude, rise, decay, start):
    dt = np.where(t > start, t - start, np.inf)
    return amplitude * np.exp(-rise / dt - np.where(np.isfinite(dt), dt, 0) / decay) * (t > start)


TWO = [(90.0, 2.0, 5.0, 1.0), (400.0, 20.0, 3.0, 8.0)]


@pytest.fixture(scope="module")
def curves(spark):
    rng = np.random.default_rng(5)
    t = np.arange(0, 60, 0.1)
    rows = []
    for name, parts in (("one", TWO[:1]), ("two", TWO)):
        clean = sum(fred(t, *p) for p in parts)
        for x, y in zip(t, clean + rng.normal(0, 0.5, len(t))):
            rows.append((name, "x", float(x), float(y), 0.5))
    rows += [("flat", "x", 1.0, 3.0, 1.0), ("flat", "x", 1.0, 3.0, 1.0), ("few", "x", 0.0, 1.0, 1.0), ("few", "x", 1.0, 2.0, 1.0), ("zero", "x", None, 1.0, 1.0),
             ("one", "x", 5.0, float("nan"), 1.0), ("one", "x", None, 5.0, 1.0)]
    return spark.createDataFrame(rows, SCHEMA).cache()


def test_derivatives_are_those_of_the_model():
    t, q = np.linspace(0.05, 20, 50), np.array([3.0, 6.0, np.log(2.0), np.log(4.0), 1.5, 9.0, np.log(0.7), np.log(1.2)])
    jac = P.pulses(t, q)[1]
    for i in range(len(q)):
        h = np.zeros(len(q))
        h[i] = 1e-6
        assert np.allclose((P.pulses(t, q + h)[0] - P.pulses(t, q - h)[0]) / 2e-6, jac[:, i], atol=1e-6)


def test_number_and_parameters_of_pulses(curves, monkeypatch):
    monkeypatch.setattr(P, "SLICE", 100)  # several slices a series
    got = {r["burst_id"]: r for r in P.fit_fred_pulses(curves).collect()}
    assert set(got) == {"one", "two", "flat", "few", "zero"}
    assert all(not got[x]["fit_success"] and got[x]["pulses"] is None for x in ("flat", "few", "zero"))
    for name, parts in (("one", TWO[:1]), ("two", TWO)):
        r = got[name]
        assert r["fit_success"] and r["n_pulses"] == len(parts) and r["dof"] == 600 - 4 * len(parts)
        assert r["aic"] == pytest.approx(r["chi_sq"] + 8 * len(parts)) and r["bic"] == pytest.approx(r["chi_sq"] + 4 * len(parts) * np.log(600)) and 0.8 < r["chi_sq"] / r["dof"] < 1.2
        t = np.arange(0, 60, 0.1)
        for p, want in zip(r["pulses"], parts):
            fitted = fred(t, p["amplitude"], p["tau_rise"], p["tau_decay"], p["t_start"])
            assert np.abs(fitted - fred(t, *want)).max() < 0.06 * fred(t, *want).max() + 0.5
            for field, value in zip(("amplitude", "tau_rise", "tau_decay", "t_start"), want):
                assert abs(p[field] - value) < 5 * p[f"{field}_err"]


def test_given_number_and_empty(curves, spark):
    r = {x["burst_id"]: x for x in P.fit_fred_pulses(curves.where("burst_id = 'two'"), n_pulses=1).collect()}["two"]
    assert r["n_pulses"] == 1 and len(r["pulses"]) == 1 and r["chi_sq"] > 1.5 * r["dof"]  # two pulses leave about one
    assert P.fit_fred_pulses(spark.createDataFrame([], SCHEMA)).count() == 0
