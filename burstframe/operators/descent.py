"""Levenberg-Marquardt steps for all series of a fit at once.

One iteration is one aggregate: at every point the model and its derivatives by the shape parameters are columns, and a few sums per series
give statistic, gradient and curvature, with the norm (and offset) eliminated.  The small systems are solved in batches
of one row per series.  A series leaves the loop when it has converged, so late iterations touch only the rest.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from burstframe.functions.arithmetic import SPARK
from burstframe.operators.reuse import keep

#: A series has converged when a step that is hardly damped gains less than GAIN of the statistic (or GAIN at all), or no damping finds a gain.
#: After LIMIT steps what is left is reported as not converged.
GAIN, FREE, DAMPED, LIMIT = 1e-6, 1.0, 1e6, 40
TINY = 1e-300


def _sums(axes, model, stat: str, y: str, err: str | None, trial: list[Column]) -> tuple[list[Column], list[Column]]:
    """(row columns, aggregate columns): derivatives by central differences in the scaled parameters."""
    steps = [F.col(f"_hi{i}") - F.col(f"_lo{i}") for i in range(len(axes))]

    def at(i: int | None, sign: float) -> Column:
        p = {a.name: a.unscale(t + (steps[j] * F.lit(sign * 1e-5) if i == j else F.lit(0.0))) for j, (a, t) in enumerate(zip(axes, trial))}
        return model(p, SPARK)

    rows = [at(None, 0.0).alias("_m")]
    rows += [F.try_divide(at(i, 1.0) - at(i, -1.0), F.lit(2e-5) * steps[i]).alias(f"_d{i}") for i in range(len(axes))]
    m, v, n = F.col("_m"), F.col(y), len(axes)
    d = [F.coalesce(F.col(f"_d{i}"), F.lit(0.0)) for i in range(n)]
    if stat == "cash":
        x = F.col("exposure") * F.col("area")
        e = F.greatest(m * x, F.lit(TINY))
        safe = F.greatest(m, F.lit(TINY))
        out = [F.sum(v).alias("s_n"), F.sum(e).alias("s_e"), F.sum(v * F.ln(e)).alias("s_l")]
        out += [F.sum(x * d[i]).alias(f"b_{i}") for i in range(n)] + [F.sum(v * d[i] / safe).alias(f"c_{i}") for i in range(n)]
        out += [F.sum(x * d[i] * d[j] / safe).alias(f"a_{i}_{j}") for i in range(n) for j in range(i, n)]
        return rows, out
    w = F.lit(1.0) if err is None else F.lit(1.0) / (F.col(err) * F.col(err))
    out = [F.sum(w * q).alias(k) for k, q in (("s_ym", v * m), ("s_mm", m * m), ("s_yy", v * v), ("s_1", F.lit(1.0)), ("s_m", m), ("s_y", v))]
    out += [F.sum(w * d[i] * q).alias(f"{k}_{i}") for i in range(n) for k, q in (("b", m), ("c", v), ("e", F.lit(1.0)))]
    out += [F.sum(w * d[i] * d[j]).alias(f"a_{i}_{j}") for i in range(n) for j in range(i, n)]
    return rows, out


def local_shape(f: Mapping[str, np.ndarray], stat: str, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Statistic, norm, offset, gradient and curvature per series from the sums."""
    col = lambda c: np.asarray(f[c], np.float64)
    a = np.zeros((len(f["_nlo"]), n, n))
    for i in range(n):
        for j in range(i, n):
            a[:, i, j] = a[:, j, i] = col(f"a_{i}_{j}")
    b, c = (np.stack([col(f"{k}_{i}") for i in range(n)], 1) for k in "bc")
    lo, hi = col("_nlo"), col("_nhi")
    zero = np.zeros(len(lo))
    with np.errstate(all="ignore"):
        if stat == "cash":
            norm = np.clip(col("s_n") / col("s_e"), lo, hi)
            value = 2 * (norm * col("s_e") - col("s_l") - col("s_n") * np.log(np.maximum(norm, TINY)))
            free = (norm > lo) & (norm < hi)
            grad = 2 * (norm[:, None] * b - c)
            curve = 2 * norm[:, None, None] * (a - np.where(free, 1 / col("s_e"), 0)[:, None, None] * b[:, :, None] * b[:, None, :])
            return value, norm, zero, grad, curve
        s = {k: col(k) for k in ("s_ym", "s_mm", "s_yy", "s_1", "s_m", "s_y")}
        if stat == "chi2":
            norm, shift = np.clip(s["s_ym"] / s["s_mm"], lo, hi), zero
            free = (norm > lo) & (norm < hi)
            outer = np.where(free, 1 / s["s_mm"], 0)[:, None, None] * b[:, :, None] * b[:, None, :]
            e = np.zeros_like(b)
        else:
            det = s["s_1"] * s["s_mm"] - s["s_m"] ** 2
            norm = np.clip((s["s_1"] * s["s_ym"] - s["s_m"] * s["s_y"]) / det, lo, hi)
            shift = np.clip((s["s_y"] - norm * s["s_m"]) / s["s_1"], col("_olo"), col("_ohi"))
            e = np.stack([col(f"e_{i}") for i in range(n)], 1)
            ef, nf = (shift > col("_olo")) & (shift < col("_ohi")), (norm > lo) & (norm < hi)
            ee = e[:, :, None] * e[:, None, :] / s["s_1"][:, None, None]
            z = b - e * (s["s_m"] / s["s_1"])[:, None]
            zz = z[:, :, None] * z[:, None, :] * (s["s_1"] / det)[:, None, None]
            bb = b[:, :, None] * b[:, None, :] / s["s_mm"][:, None, None]
            pick = lambda x: x[:, None, None]
            outer = np.where(pick(ef & nf), ee + zz, np.where(pick(nf), bb, np.where(pick(ef), ee, 0)))
        value = (s["s_yy"] + norm**2 * s["s_mm"] + shift**2 * s["s_1"] - 2 * norm * s["s_ym"] - 2 * shift * s["s_y"] + 2 * norm * shift * s["s_m"])
        grad = -2 * norm[:, None] * (c - norm[:, None] * b - shift[:, None] * e)
        return value, norm, shift, grad, 2 * norm[:, None, None] ** 2 * (a - outer)


def fresh(trial: np.ndarray) -> dict[str, np.ndarray]:
    """State of descents that have not begun; ``trial`` has a row for each."""
    r, n = trial.shape
    return {"trial": trial.copy(), "best": np.full((r, n), np.nan), "grad": np.zeros((r, n)), "curve": np.zeros((r, n, n)), "norm": np.zeros(r), "shift": np.zeros(r),
            "stat": np.full(r, np.inf), "damp": np.full(r, 1e-3), "first": np.ones(r, bool), "done": np.zeros(r, bool), "converged": np.zeros(r, bool)}


def advance(old: Mapping[str, np.ndarray], shape: tuple, ok: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> dict[str, np.ndarray]:
    """States after the trial of each row was evaluated: better trials are taken, and the next trial is a damped step from the best point."""
    value, norm, shift, grad, curve = shape
    r, n = old["trial"].shape
    first = old["first"]
    ok = ok & np.isfinite(value) & np.isfinite(grad).all(1) & np.isfinite(curve).all((1, 2))
    better = ok & (first | (value < old["stat"]))
    lost = first & ~better  # nothing to go on
    with np.errstate(all="ignore"):
        pick = lambda new, none, was: np.where(_wide(better, new), new, np.where(_wide(lost, new), none, was))
        best = np.where((better | lost)[:, None], old["trial"], old["best"])
        g, h = pick(grad, 0.0, old["grad"]), pick(curve, np.eye(n), old["curve"])
        s, a, k = pick(value, np.inf, old["stat"]), pick(norm, 0.0, old["norm"]), pick(shift, 0.0, old["shift"])
        damp = np.where(better, np.maximum(old["damp"] / 8, 1e-9), np.where(lost, old["damp"], old["damp"] * 8))
        gain = np.where(first, np.inf, old["stat"] - value)
        good = np.where(better, (gain <= GAIN * np.maximum(1.0, np.abs(s))) & (damp <= FREE), ~lost & (damp > DAMPED))
        done = good | lost
        width = np.maximum(hi - lo, TINY)
        free = ~(((best <= lo) & (g > 0)) | ((best >= hi) & (g < 0)))  # others are held at their limits
        both = free[:, :, None] & free[:, None, :]
        hh = np.where(both, h * width[:, :, None] * width[:, None, :], 0.0)
        diag = np.where(free, np.einsum("rii->ri", hh), 0.0)
        diag = np.maximum(diag, 1e-12 * np.maximum(1e-300, np.abs(diag).max(1, initial=0))[:, None] + 1e-30)
        system = hh + np.where(np.eye(n, dtype=bool) & both, (damp[:, None] * diag)[:, :, None], 0.0)
        slope = np.where(free, g * width, 0.0)
        solvable = ~done & free.any(1) & np.isfinite(system).all((1, 2)) & np.isfinite(slope).all(1)
        step = np.zeros((r, n))
        if solvable.any():
            inverse = np.linalg.pinv(system[solvable], rtol=n * np.finfo(float).eps, hermitian=True)
            step[solvable] = -np.einsum("rij,rj->ri", inverse, slope[solvable]) * width[solvable]
        to = np.clip(best + step, lo, hi)
        still = ~done & (np.abs(to - best).max(1) <= 1e-12 * width.max(1))
    return {"trial": to, "best": best, "grad": g, "curve": h, "norm": a, "shift": k, "stat": s, "damp": damp, "first": np.zeros(r, bool), "done": done | still,
            "converged": good | still}


def _wide(mark: np.ndarray, like: np.ndarray) -> np.ndarray:
    return mark.reshape(-1, *[1] * (like.ndim - 1))


def descend(points: DataFrame, keys: Sequence[str], start: DataFrame, axes, model: Callable, stat: str, y: str, err: str | None, norm_bounds, offset_bounds,
            allowed: Callable | None) -> DataFrame:
    """Local minima from starts: keys, axis values, ``norm``, ``offset``, ``stat``, ``converged``.

    ``start`` has the keys (and more key columns that tell the starts of a series apart) and the axes' values; limits come from the axes and may be
    columns of the points that are constant per series.
    """
    n, names = len(axes), [a.name for a in axes]
    ids = [c for c in start.columns if c not in names]

    def bound(b, default: float) -> Column:
        return F.lit(default) if b is None else F.col(b).cast("double") if isinstance(b, str) else F.lit(float(b))

    limits = [c for i, a in enumerate(axes) for c in (a.limit("lo").alias(f"_lo{i}"), a.limit("hi").alias(f"_hi{i}"))]
    nb, ob = norm_bounds or (None, None), offset_bounds or (None, None)
    limits += [bound(nb[0], -1e300).alias("_nlo"), bound(nb[1], 1e300).alias("_nhi"), bound(ob[0], -1e300).alias("_olo"), bound(ob[1], 1e300).alias("_ohi")]
    kept = [f"_{k}{i}" for i in range(n) for k in ("lo", "hi")] + ["_nlo", "_nhi", "_olo", "_ohi"]
    rows = points.withColumns(dict(zip(kept, limits)))
    schema = ", ".join([f"{f.name} {f.dataType.simpleString()}" for f in start.schema.fields if f.name in ids]
                       + ["trial array<double>", "best array<double>", "grad array<double>", "curve array<double>", "norm double", "shift double", "stat double", "damp double",
                          "done boolean", "converged boolean"])
    scaled = F.array(*[F.ln(a.name) if a.log else F.col(a.name).cast("double") for a in axes])
    none = F.lit(None).cast("array<double>")
    state = start.select(*ids, scaled.alias("trial"), none.alias("best"), none.alias("grad"), none.alias("curve"), F.lit(0.0).alias("norm"), F.lit(0.0).alias("shift"),
                         F.lit(float("inf")).alias("stat"), F.lit(1e-3).alias("damp"), F.lit(False).alias("done"), F.lit(False).alias("converged"))

    def move(batches):
        for f in batches:
            if not len(f):
                continue
            first = f["old_best"].isna().to_numpy()
            old = {k: f[f"old_{k}"].to_numpy(np.float64) for k in ("norm", "shift", "stat", "damp")}
            old |= {k: np.stack([np.zeros(z) if v is None else np.asarray(v) for v in f[f"old_{k}"]]) for k, z in (("best", n), ("grad", n), ("curve", n * n))}
            old |= {"trial": np.stack(f["trial"].to_numpy()), "first": first, "curve": old["curve"].reshape(-1, n, n)}
            lo, hi = (np.stack([f[f"_{k}{i}"].to_numpy(np.float64) for i in range(n)], 1) for k in ("lo", "hi"))
            new = advance(old, local_shape(f, stat, n), f["_ok"].fillna(False).to_numpy(bool), lo, hi)
            new["curve"] = new["curve"].reshape(len(f), n * n)
            out = f[ids].copy()
            for k in ("trial", "best", "grad", "curve", "norm", "shift", "stat", "damp", "done", "converged"):
                out[k] = list(new[k]) if new[k].ndim > 1 else new[k]
            yield out

    finished, state = None, keep(state)
    for _ in range(LIMIT):
        mine = state.select(*ids, "trial", *[F.col(c).alias(f"old_{c}") for c in ("best", "grad", "curve", "norm", "shift", "stat", "damp")])
        g = rows.join(mine, list(keys))
        trial = [F.col("trial")[i] for i in range(n)]
        row_cols, aggs = _sums(axes, model, stat, y, err, trial)
        ok = F.lit(True) if allowed is None else allowed({a.name: a.unscale(t) for a, t in zip(axes, trial)})
        g = g.select("*", *row_cols)
        firsts = ["trial", *[f"old_{c}" for c in ("best", "grad", "curve", "norm", "shift", "stat", "damp")], *kept]
        sums = g.groupBy(*ids).agg(*aggs, *[F.first(c).alias(c) for c in firsts], F.first(ok).alias("_ok"))
        state = keep(sums.mapInPandas(move, schema))
        part = state.where("done")
        finished = part if finished is None else finished.unionByName(part)
        state = state.where(~F.col("done"))
        if state.isEmpty():
            break
    finished = finished.unionByName(state)
    values = [a.unscale(F.col("best")[i]).alias(a.name) for i, a in enumerate(axes)]
    return finished.select(*ids, *values, "norm", F.col("shift").alias("offset"), "stat", "converged")
