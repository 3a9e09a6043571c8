"""Several pulses in one light curve: joint least squares, number of pulses by information criterion.

A pulse is A exp(-tau_rise/dt - dt/tau_decay), dt = t - t_start > 0.  Inside the fit it stands as (height, peak time, ln tau_rise, ln tau_decay), whose
parts hardly depend on each other.  Pulses are added one at a time, each where the residual of the fit so far is most significant, and then all pulses of the
series move together.  A series leaves when one more pulse does not lower its criterion, so every series has its own number of parameters.

Bins are packed once into slices of bounded length, one row each.  A step joins the few numbers of a series to its slices; a slice gives the partial sums of
statistic, gradient and curvature for several trial steps at once, and these sums meet map-side.  No task holds a series.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from burstframe.operators.lightcurve import KEYS
from burstframe.operators.reuse import keep
from burstframe.operators.series import attach

#: Bins in a slice; cells of the residual that a new pulse is looked for in.
SLICE, CELLS = 16_384, 64
#: Widths of a new pulse as shares of the time span, and dampings of the trial steps around the last good one.
WIDTHS = (0.004, 0.015, 0.04, 0.1, 0.25)
DAMPS = (1e-3, 1e-1, 1.0, 10.0, 1e3)
#: Converged: a step gains less than GAIN of the statistic, or no damping up to MOST gains; others are not converged after STEPS.
GAIN, MOST, STEPS = 1e-5, 1e9, 60
PULSE = "amplitude double, tau_rise double, tau_decay double, t_start double, amplitude_err double, tau_rise_err double, tau_decay_err double, t_start_err double"


def pulses(t: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Model at ``t`` and its derivatives (4 per pulse) for parameters ``q`` (pulses by 4)."""
    value, slopes = np.zeros(len(t)), []
    for h, peak, a, b in q.reshape(-1, 4):
        rise, decay = np.exp(a), np.exp(b)
        s, mu = np.sqrt(rise * decay), np.sqrt(rise / decay)
        dt = t - peak + s
        on = dt > 0
        d = np.where(on, dt, 1.0)
        bell = np.where(on, np.exp(np.minimum(2 * mu - rise / d - d / decay, 0.0)), 0.0)
        by_dt = rise / d**2 - 1 / decay
        f = h * bell
        with np.errstate(invalid="ignore", over="ignore"):
            slopes += [bell, np.where(bell > 0, -f * by_dt, 0.0), np.where(bell > 0, f * (mu - rise / d + by_dt * s / 2), 0.0),
                       np.where(bell > 0, f * (d / decay - mu + by_dt * s / 2), 0.0)]
        value += f
    return value, np.stack(slopes, axis=1)


def _limits(k: int, t0: float, span: float, top: float) -> tuple[np.ndarray, np.ndarray]:
    low = [0.0, t0, np.log(1e-4 * span), np.log(1e-4 * span)]
    high = [10 * top, t0 + span, np.log(10 * span), np.log(10 * span)]
    return np.tile(low, k), np.tile(high, k)


def _packed(lc: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Slices of the series as arrays t, y, w; the order inside a slice does not matter."""
    sizes = lc.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    w = F.when(F.col("rate_err") > 0, F.lit(1.0) / (F.col("rate_err") * F.col("rate_err"))).otherwise(F.lit(1.0))
    rows = attach(lc.select(*keys, F.col("t").cast("double"), F.col("rate").cast("double").alias("y"), w.alias("w")), sizes, keys)
    rows = rows.withColumn("_slice", F.pmod(F.xxhash64("t", "y"), F.ceil(F.col("_n") / F.lit(float(SLICE)))))
    return keep(rows.groupBy(*keys, "_slice").agg(F.collect_list(F.struct("t", "y", "w")).alias("_r")).select(*keys, "_r.t", "_r.y", "_r.w"))


def _summed(slices: DataFrame, state: DataFrame, keys: Sequence[str], each: Callable[[dict], np.ndarray]) -> DataFrame:
    """keys, ``sums``: the arrays that ``each`` makes of a slice and the state of its series, added up per series.

    Sums combine map-side by place; the list that is collected at the end has as many entries as ``each`` returns, whatever the length of the series.
    """
    names = list(keys)
    schema = ", ".join(f"{k} {slices.schema[k].dataType.simpleString()}" for k in names) + ", sums array<double>"

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = f.to_dict("records")
            yield pd.DataFrame({**{k: f[k] for k in names}, "sums": [each(r) for r in rows]})

    parts = slices.join(state, names).mapInPandas(run, schema)
    flat = parts.select(*names, F.posexplode("sums").alias("_i", "_v")).groupBy(*names, "_i").agg(F.sum("_v").alias("_v"))
    one = flat.groupBy(*names).agg(F.array_sort(F.collect_list(F.struct("_i", "_v"))).alias("_s"))
    return one.select(*names, F.col("_s._v").alias("sums"))


def _normal(r: dict) -> np.ndarray:
    """Statistic, gradient and curvature of a slice for each trial of its series, in one row."""
    t, y, w = (np.asarray(r[c], float) for c in ("t", "y", "w"))
    out = []
    for q in np.asarray(r["trials"], float).reshape(-1, 4 * int(r["k"])):
        value, jac = pulses(t, q)
        res, weighted = y - value, jac * w[:, None]
        out += [[res @ (w * res)], weighted.T @ res, (weighted.T @ jac).ravel()]
    return np.concatenate(out)


def _residual(r: dict) -> np.ndarray:
    """Per cell of the time span: weighted residual, weight, weighted time."""
    t, y, w = (np.asarray(r[c], float) for c in ("t", "y", "w"))
    best = np.asarray(r["best"], float)
    res = y - pulses(t, best)[0] if len(best) else y
    cell = np.clip(((t - r["t0"]) / r["span"] * CELLS).astype(np.int64), 0, CELLS - 1)
    return np.concatenate([np.bincount(cell, v, CELLS) for v in (w * res, w, w * t)])


def _mapped(df: DataFrame, schema: str, each: Callable[[dict], dict]) -> DataFrame:
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            if len(f):
                yield pd.DataFrame([each(r) for r in f.to_dict("records")])

    return df.mapInPandas(run, schema)


def _with_new_pulse(r: dict) -> dict:
    """Trials with a pulse more, one for each width, at the most significant cell of the residual."""
    up, weight, place = np.asarray(r.pop("sums"), float).reshape(3, CELLS)
    safe = np.maximum(weight, 1e-300)
    at = int(np.argmax(np.where(weight > 0, up / np.sqrt(safe), -np.inf)))
    height = max(up[at] / safe[at], 1e-3 * r["top"])
    k = int(r["k"]) + 1
    low, high = _limits(k, r["t0"], r["span"], r["top"])
    trials = [np.clip([*r["best"], height, place[at] / safe[at], np.log(s * r["span"]), np.log(s * r["span"])], low, high) for s in WIDTHS]
    return {**r, "k": k, "trials": np.concatenate(trials), "best": trials[0], "grad": np.zeros(0), "curve": np.zeros(0), "chi": np.inf, "damp": 1e-2,
            "done": False, "converged": False}


def _move(r: dict) -> dict:
    """Take the best trial if it is better than what stands, and set out the next trials."""
    k = int(r["k"])
    n = 4 * k
    low, high = _limits(k, r["t0"], r["span"], r["top"])
    trials = np.asarray(r["trials"], float).reshape(-1, n)
    sums = np.asarray(r.pop("sums"), float).reshape(len(trials), 1 + n + n * n)
    chi = np.where(np.isfinite(sums).all(axis=1), sums[:, 0], np.inf)
    i = int(np.argmin(chi))
    first, damp = len(r["grad"]) == 0, float(r["damp"])
    if chi[i] < r["chi"]:
        gain = r["chi"] - chi[i]
        done = bool(not first and gain <= GAIN * max(chi[i], 1.0))
        damp = damp if first else min(max(damp * DAMPS[min(i, len(DAMPS) - 1)], 1e-9), MOST)
        r.update(best=trials[i], chi=float(chi[i]), grad=sums[i, 1 : 1 + n], curve=sums[i, 1 + n :], done=done, converged=done)
    else:
        damp *= 1e3
        r.update(done=bool(first or damp > MOST), converged=bool(not first))
        r["converged"] = r["converged"] and r["done"]
    r["damp"] = damp
    if not r["done"]:
        q, grad, curve = (np.asarray(r[c], float) for c in ("best", "grad", "curve"))
        curve = curve.reshape(n, n)
        free = np.flatnonzero(~((q <= low) & (grad < 0) | (q >= high) & (grad > 0)))  # others are held at their limits
        diag = np.maximum(np.diag(curve), 1e-12 * max(np.diag(curve).max(), 1e-300))
        steps = []
        for d in DAMPS:
            step = np.zeros(n)
            if len(free):
                step[free] = np.linalg.lstsq(curve[np.ix_(free, free)] + damp * d * np.diag(diag[free]), grad[free], rcond=None)[0]
            steps.append(np.clip(q + step, low, high))
        r["trials"] = np.concatenate(steps)
    return r


def _described(r: dict) -> dict:
    """Parameters and errors of the pulses of a finished series, in the order of their peaks."""
    k, q = int(r["k"]), np.asarray(r["best"], float).reshape(-1, 4)
    rise, decay = np.exp(q[:, 2]), np.exp(q[:, 3])
    mu, s = np.sqrt(rise / decay), np.sqrt(rise * decay)
    scale = np.exp(2 * mu)
    turn = np.zeros((4 * k, 4 * k))  # derivatives of the reported values by those of the fit
    for i in range(k):
        turn[4 * i : 4 * i + 4, 4 * i : 4 * i + 4] = [[scale[i], 0, scale[i] * q[i, 0] * mu[i], -scale[i] * q[i, 0] * mu[i]], [0, 0, rise[i], 0], [0, 0, 0, decay[i]],
                                                      [0, 1, -s[i] / 2, -s[i] / 2]]
    dof = int(r["n"]) - 4 * k
    errs = np.full(4 * k, np.nan)
    curve = np.asarray(r["curve"], float)
    if dof > 0 and len(curve):
        with np.errstate(all="ignore"):
            cov = turn @ np.linalg.pinv(curve.reshape(4 * k, 4 * k), hermitian=True) @ turn.T * (r["chi"] / dof)
            errs = np.sqrt(np.diag(cov))
    values = np.stack([q[:, 0] * scale, rise, decay, q[:, 1] - s], axis=1)
    names = [f.split()[0] for f in PULSE.split(", ")]
    rows = [dict(zip(names, [*map(float, values[i]), *[float(e) if np.isfinite(e) else None for e in errs[4 * i : 4 * i + 4]]])) for i in np.argsort(q[:, 1], kind="stable")]
    return {c: r[c] for c in r["_keys"]} | {"n_pulses": k, "chi_sq": float(r["chi"]), "dof": dof, "aic": float(r["chi"] + 8 * k),
                                            "bic": float(r["chi"] + 4 * k * np.log(r["n"])), "converged": bool(r["converged"]), "pulses": rows}


def fit_fred_pulses(lc: DataFrame, n_pulses: int | None = None, max_pulses: int = 3, criterion: str = "bic", keys: Sequence[str] = KEYS) -> DataFrame:
    """(keys, n_pulses, chi_sq, dof, aic, bic, converged, pulses, fit_success): ``n_pulses`` pulses for each series, or up to ``max_pulses`` while the criterion falls.

    ``criterion`` is 'bic' or 'aic'.  A new pulse is looked for along the whole series, so by AIC a single high bin of noise often counts as a pulse.

    ``pulses`` is an array in the order of the peaks; errors come from the covariance, scaled by chi_sq / dof.  Bins without an error count with unit weight;
    bins whose time or rate is null, NaN or infinite take no part.  A series whose bins are not more than 4 for each pulse, all at one time, or without a
    positive rate has no fit (nulls, ``fit_success`` false).
    """
    keys = list(keys)
    finite = lambda c: F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double")) & (F.abs(F.col(c).cast("double")) < float("inf"))
    good = lc.where(finite("t") & finite("rate"))
    slices = _packed(good, keys)
    extent = good.groupBy(*keys).agg(F.min("t").cast("double").alias("t0"), (F.max("t") - F.min("t")).cast("double").alias("span"), F.max("rate").cast("double").alias("top"),
                                     F.count(F.lit(1)).alias("n"))
    extent = keep(extent.where("span > 0 AND top > 0"))
    kinds = ", ".join(f"{k} {extent.schema[k].dataType.simpleString()}" for k in keys)
    schema = (f"{kinds}, t0 double, span double, top double, n long, k int, best array<double>, trials array<double>, grad array<double>, curve array<double>, chi double, "
              "damp double, done boolean, converged boolean")
    none = F.array().cast("array<double>")
    active = extent.withColumns({"k": F.lit(0), "best": none})
    cost = F.col("chi") + 4 * F.col("k") * (F.lit(2.0) if criterion == "aic" else F.ln("n"))
    finished = None
    for k in range(1, (n_pulses or max_pulses) + 1):
        active = active.where(F.col("n") > 4 * k).select(*keys, "t0", "span", "top", "n", "k", "best")
        state = keep(_mapped(active.join(_summed(slices, active, keys, _residual), keys), schema, _with_new_pulse))
        ended = None
        for _ in range(STEPS):
            state = keep(_mapped(state.join(_summed(slices, state.select(*keys, "k", "trials"), keys, _normal), keys), schema, _move))
            part = state.where("done")
            ended = part if ended is None else ended.unionByName(part)
            state = state.where(~F.col("done"))
            if state.isEmpty():
                break
        ended = keep(ended.unionByName(state))
        if finished is None or n_pulses is not None:
            finished, active = ended, ended
        else:
            before = finished.groupBy(*keys).agg(F.min(cost).alias("_cost"))
            better = keep(ended.join(before, keys).where(cost < F.col("_cost")).drop("_cost"))
            finished, active = finished.unionByName(better), better
        if active.isEmpty():
            break
    best = finished.withColumn("_cost", cost).where("chi < double('inf')")
    if n_pulses is not None:
        best = best.where(F.col("k") == n_pulses)
    best = best.groupBy(*keys).agg(F.min_by(F.struct(*[c for c in finished.columns if c not in keys]), F.struct("_cost", "k")).alias("_w")).select(*keys, "_w.*")
    out = _mapped(best, f"{kinds}, n_pulses int, chi_sq double, dof long, aic double, bic double, converged boolean, pulses array<struct<{PULSE.replace(' double', ': double')}>>",
                  lambda r: _described({**r, "_keys": keys}))
    every = lc.select(*keys).distinct()
    return attach(every, out, keys, "left").withColumn("fit_success", F.coalesce("converged", F.lit(False)))
