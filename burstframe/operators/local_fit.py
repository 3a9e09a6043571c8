"""Grid and descent of a whole fit for series that fit a row, many series in one numpy block.

Series of at most ``POINTS`` points are packed into rows, dealt over all tasks once, and fitted where they are: neither a grid point nor a step of the descent
becomes a row, a shuffle or a table.  Longer series take the distributed way of ``fit.py`` and ``descent.py``, whose arithmetic this module follows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from burstframe.functions.arithmetic import Arrays
from burstframe.operators.descent import LIMIT, TINY, advance, fresh, local_shape

#: Most points of a series that is fitted in a row.
POINTS = 4096
#: Values (points times grid points) that are evaluated at once, and points that descend together.
CELLS, TOGETHER = 1 << 18, 1 << 16


def packed_points(points: DataFrame, keys: Sequence[str], columns: Sequence[str], how: str = "double") -> DataFrame:
    """One row per series with the columns as arrays, dealt over all tasks; the count is explicit, as fits are far more work than their input shows."""
    n = int(points.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = points.select(*keys, *[F.col(c).cast(how).alias(c) for c in columns]).repartition(n, *keys)
    one = rows.groupBy(*keys).agg(F.collect_list(F.struct(*columns)).alias("_r"))
    return one.select(*keys, *[F.col("_r")[c].alias(c) for c in columns])


def flat(batch: pa.RecordBatch, columns: Sequence[str]) -> tuple[np.ndarray, dict[str, np.ndarray], dict[str, np.ndarray]]:
    """(points of each row, values, marks of nulls) of the packed columns of a batch; columns without nulls have no marks."""
    values, nulls, size = {}, {}, None
    for c in columns:
        lists = batch.column(batch.schema.get_field_index(c))
        v = lists.flatten()
        size = np.diff(lists.offsets.to_numpy()) if size is None else size
        if v.null_count:
            nulls[c] = v.is_null().to_numpy(zero_copy_only=False)
        values[c] = v.to_numpy(zero_copy_only=False).astype(float)
    return size.astype(np.int64), values, nulls


def blocks(size: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows with at most ``most`` points (one row is the least)."""
    a, total = 0, 0
    for i, k in enumerate(size.tolist()):
        if i > a and total + k > most:
            yield a, i
            a, total = i, 0
        total += k
    if a < len(size):
        yield a, len(size)


class _Fit:
    """One fit on the flat points of a batch of series."""

    def __init__(self, axes, model, stat, y, err, norm_bounds, offset_bounds, allowed, starts, refine):
        self.axes, self.model, self.stat, self.y, self.err, self.allowed = axes, model, stat, y, err, allowed
        self.norm_bounds, self.offset_bounds, self.starts, self.refine = norm_bounds, offset_bounds, starts, refine
        sizes = [a.n for a in axes]
        self.n_grid = int(np.prod(sizes))
        index = np.unravel_index(np.arange(self.n_grid), sizes)
        self.frac = [i / float(max(a.n - 1, 1)) for a, i in zip(axes, index)]

    def load(self, size, values, nulls):
        self.size, self.values, self.nulls = size, values, nulls
        self.first = np.cumsum(size) - size
        self.lo, self.hi = (np.stack([self._limit(a, w) for a in self.axes], 1) for w in ("lo", "hi"))
        self.nlo, self.nhi = (self._bound(self.norm_bounds, i) for i in (0, 1))
        self.olo, self.ohi = (self._bound(self.offset_bounds, i) for i in (0, 1))

    def _limit(self, a, which):
        v = getattr(a, which)
        c = self.values[v][self.first] if isinstance(v, str) else np.full(len(self.size), float(v))
        with np.errstate(all="ignore"):
            return np.where(c > 0, np.log(c), np.nan) if a.log else c

    def _bound(self, bounds, i):
        b = None if bounds is None else bounds[i]
        return None if b is None else self.values[b][self.first] if isinstance(b, str) else np.full(len(self.size), float(b))

    def _part(self, at, deep: bool):
        cols = {c: v[at][:, None] if deep else v[at] for c, v in self.values.items()}
        nulls = {c: v[at][:, None] if deep else v[at] for c, v in self.nulls.items()}
        return cols, nulls

    def _named(self, scaled):
        return {a.name: np.exp(s) if a.log else s for a, s in zip(self.axes, scaled)}

    def _weights(self, cols, nulls):
        """Values and weights with zeros for nulls, and marks where either is null."""
        none = np.False_
        v0 = nulls.get(self.y, none)
        v = np.where(v0, 0.0, cols[self.y]) if self.y in nulls else cols[self.y]
        if self.stat == "cash":
            return v, cols["exposure"] * cols["area"], v0, none
        w0 = nulls.get("_w", none)
        return v, np.where(w0, 0.0, cols["_w"]) if "_w" in nulls else cols["_w"], v0, w0

    def grid(self, a: int, b: int):
        """The best starts of series a to b: (series, number of the start, scaled axes, norm, offset, stat)."""
        p0, p1 = self.first[a], self.first[b - 1] + self.size[b - 1]
        at, offs = slice(p0, p1), self.first[a:b] - p0
        cols, nulls = self._part(at, True)
        owner = np.repeat(np.arange(b - a), self.size[a:b])
        v, w, v0, w0 = self._weights(cols, nulls)
        add = lambda q: np.add.reduceat(np.broadcast_to(q, (p1 - p0, q.shape[1])), offs, axis=0)
        full = lambda lim: (lim if np.ptp(lim) else lim[:1]) if np.isfinite(lim).all() else lim
        pieces = []
        step = max(1, CELLS // (p1 - p0))
        for g in range(0, self.n_grid, step):
            scaled = []
            for i in range(len(self.axes)):
                lo, hi = full(self.lo[a:b, i]), full(self.hi[a:b, i])
                lo, hi = np.broadcast_arrays(lo, hi)
                scaled.append(lo[:, None] + (hi - lo)[:, None] * self.frac[i][None, g : g + step])
            params = self._named(scaled)
            spread = {k: q[owner] if len(q) > 1 else q for k, q in params.items()}
            x = Arrays(cols, nulls)
            m = self.model(spread, x)
            lost = x.null
            for q in spread.values():
                if np.isnan(q).any():
                    lost = lost | np.isnan(q)
            some_null = np.any(lost)
            wide = (p1 - p0, min(step, self.n_grid - g))
            m = np.broadcast_to(m, wide)
            if self.stat == "cash":
                e = np.maximum(m * w, TINY)
                if some_null:
                    e = np.where(lost, TINY, e)
                sums = [np.broadcast_to(add(v), (b - a, wide[1])), add(e), add(np.where(v0, 0.0, v * np.log(e)) if np.any(v0) else v * np.log(e))]
                seen = np.broadcast_to(add(np.broadcast_to(~v0, v.shape).astype(float)) > 0, (b - a, wide[1]))
            else:
                if some_null:
                    m = np.where(lost, 0.0, m)
                wm = w * m
                sums = [add(v * wm), add(m * wm), np.broadcast_to(add(v * v * w), (b - a, wide[1]))]
                usable = ~(v0 | w0 | lost) if np.any(v0) or np.any(w0) or some_null else None
                seen = np.ones((b - a, wide[1]), bool) if usable is None else np.broadcast_to(add(np.broadcast_to(usable, wide).astype(float)) > 0, (b - a, wide[1]))
                if self.stat == "chi2_offset":
                    sums += [np.broadcast_to(add(np.where(w0, 0.0, w)), (b - a, wide[1])), add(wm), np.broadcast_to(add(v * w), (b - a, wide[1]))]
            if self.allowed is not None:
                seen = seen & np.broadcast_to(self.allowed(params), (b - a, wide[1]))
            pieces.append((*[np.broadcast_to(q, (b - a, wide[1])) for q in scaled], seen, *sums))
        scaled, (seen, *sums) = [np.concatenate(c, 1) for c in zip(*[p[: len(self.axes)] for p in pieces])], [
            np.concatenate(c, 1) for c in zip(*[p[len(self.axes) :] for p in pieces])]
        norm, value, offset = self._score(sums, a, b)
        seen = seen & ~np.isnan(value)
        rank = np.argsort(np.where(seen, value, np.inf), axis=1, kind="stable")[:, : self.starts if self.refine else 1]
        r = np.arange(b - a)[:, None]
        keep = seen[r, rank]
        series, s = np.nonzero(keep)
        g = rank[series, s]
        take = lambda q: q[series, g]
        return series + a, s, np.stack([take(q) for q in scaled], 1), take(norm), take(offset) if offset is not None else np.zeros(len(g)), take(value)

    def _score(self, sums, a, b):
        def clamp(c, lo, hi):
            if lo is None:
                return c
            return np.fmax(lo[a:b, None], np.fmin(hi[a:b, None], c))

        def ratio(p, q):
            return np.where(q == 0, np.nan, p / q)

        if self.stat == "cash":
            sn, se, snl = sums
            n = clamp(ratio(sn, se), self.nlo, self.nhi)
            return n, 2.0 * (n * se - snl - sn * np.log(np.maximum(n, TINY))), None
        if self.stat == "chi2":
            sym, smm, syy = sums
            n = clamp(ratio(sym, smm), self.nlo, self.nhi)
            return n, syy - 2.0 * n * sym + n * n * smm, None
        sym, smm, syy, s1, sm, sy = sums
        n = clamp(ratio(s1 * sym - sm * sy, s1 * smm - sm * sm), self.nlo, self.nhi)
        k = clamp(ratio(sy - n * sm, s1), self.olo, self.ohi)
        return n, syy - 2.0 * k * sy - 2.0 * n * sym + k * k * s1 + 2.0 * n * k * sm + n * n * smm, k

    def sums(self, series: np.ndarray, trial: np.ndarray) -> dict[str, np.ndarray]:
        """The sums of :func:`descent._sums` for every (series, trial)."""
        size, n = self.size[series], len(self.axes)
        offs = np.cumsum(size) - size
        at = np.repeat(self.first[series] - offs, size) + np.arange(int(size.sum()))
        owner = np.repeat(np.arange(len(series)), size)
        cols, nulls = self._part(at, False)
        width = self.hi[series] - self.lo[series]
        add = lambda q: np.add.reduceat(q, offs)

        def at_step(i, sign):
            scaled = [(trial[:, j] + (width[:, j] * (sign * 1e-5) if i == j else 0.0)) for j in range(n)]
            x = Arrays(cols, nulls)
            m = np.broadcast_to(self.model({k: q[owner] for k, q in self._named(scaled).items()}, x), at.shape)
            return m, np.broadcast_to(x.null, at.shape) if np.any(x.null) else None

        m, lost = at_step(None, 0.0)
        d = []
        for i in range(n):
            (up, un), (down, dn) = at_step(i, 1.0), at_step(i, -1.0)
            steps = (2e-5 * width[:, i])[owner]
            q = np.where(steps == 0, 0.0, (up - down) / steps)
            for gone in (un, dn):
                if gone is not None:
                    q = np.where(gone, 0.0, q)
            d.append(q)
        v, w, v0, w0 = self._weights(cols, nulls)
        out = {}
        if self.stat == "cash":
            e, safe = np.maximum(m * w, TINY), np.maximum(m, TINY)
            if lost is not None:
                e, safe = np.where(lost, TINY, e), np.where(lost, TINY, safe)
            out.update(s_n=add(v), s_e=add(e), s_l=add(np.where(v0, 0.0, v * np.log(e)) if np.any(v0) else v * np.log(e)))
            for i in range(n):
                out[f"b_{i}"], out[f"c_{i}"] = add(w * d[i]), add(v * d[i] / safe)
                for j in range(i, n):
                    out[f"a_{i}_{j}"] = add(w * d[i] * d[j] / safe)
            return out
        if lost is not None:
            m = np.where(lost, 0.0, m)
        one = np.ones(len(m))
        for k, q in (("s_ym", v * m), ("s_mm", m * m), ("s_yy", v * v), ("s_1", one), ("s_m", m), ("s_y", v)):
            out[k] = add(w * q)
        for i in range(n):
            for k, q in (("b", m), ("c", v), ("e", one)):
                out[f"{k}_{i}"] = add(w * d[i] * q)
            for j in range(i, n):
                out[f"a_{i}_{j}"] = add(w * d[i] * d[j])
        return out

    def descend(self, series: np.ndarray, trial: np.ndarray):
        """Local minima of all starts: best scaled axes, norm, shift, stat, converged."""
        n = len(self.axes)
        state = fresh(trial)
        live = np.arange(len(series))
        bound = lambda b, default: np.full(len(series), default) if b is None else b[series]
        limits = {"_nlo": bound(self.nlo, -1e300), "_nhi": bound(self.nhi, 1e300), "_olo": bound(self.olo, -1e300), "_ohi": bound(self.ohi, 1e300)}
        for _ in range(LIMIT):
            if not len(live):
                break
            now = {k: v[live] for k, v in state.items()}
            s = series[live]
            sums = {**self.sums(s, now["trial"]), **{k: v[live] for k, v in limits.items()}}
            ok = np.ones(len(live), bool)
            if self.allowed is not None:
                ok = np.broadcast_to(self.allowed(self._named(list(now["trial"].T))), ok.shape)
            moved = advance(now, local_shape(sums, self.stat, n), ok, self.lo[s], self.hi[s])
            for k, v in moved.items():
                state[k][live] = v
            live = live[~moved["done"]]
        return state

    def run(self):
        """Per series: axes, norm, offset, stat, converged (NaN where there is no fit)."""
        n = len(self.size)
        out = np.full((n, len(self.axes) + 3), np.nan)
        converged = np.zeros(n, bool)
        for a, b in blocks(self.size, TOGETHER):
            found = []
            for c, e in blocks(self.size[a:b], max(1, CELLS // self.n_grid)):
                found.append(self.grid(a + c, a + e))
            series, s, scaled, norm, offset, value = (np.concatenate(q) for q in zip(*found))
            if not len(series):
                continue
            good = np.ones(len(series), bool)
            if self.refine:
                named = self._named(list(scaled.T))
                trial = np.stack([np.log(named[x.name]) if x.log else named[x.name] for x in self.axes], 1)
                state = self.descend(series, trial)
                scaled, norm, offset, value, good = state["best"], state["norm"], state["shift"], state["stat"], state["converged"]
            order = np.lexsort((s, value, series))
            series = series[order]
            lead = np.r_[True, series[1:] != series[:-1]]
            at, series = order[lead], series[lead]
            if self.refine:
                at, series = at[value[at] < np.inf], series[value[at] < np.inf]
            named = self._named(list(scaled[at].T))
            out[series] = np.stack([*[named[x.name] for x in self.axes], norm[at], offset[at], value[at]], 1)
            converged[series] = good[at]
        return out, converged


def fit_packed(points: DataFrame, keys: Sequence[str], axes, model: Callable, stat: str, y: str, err: str | None, norm_bounds, offset_bounds, allowed, starts: int,
               refine: bool, per_key: Sequence[str]) -> DataFrame:
    """Keys, axis values, ``norm``, ``offset``, ``stat``, ``converged`` and ``_np`` of series of at most ``POINTS`` points; no fit leaves nulls."""
    fit = _Fit(axes, model, stat, y, err, norm_bounds, offset_bounds, allowed, starts, refine)
    names = [*[a.name for a in axes], "norm", "offset", "stat"]
    skip = {*keys, "_w", *([err] if err else [])}
    used = [f.name for f in points.schema.fields if f.name not in skip and f.dataType.typeName() not in ("string", "array", "struct", "map", "boolean", "timestamp",
                                                                                                       "timestamp_ntz", "date", "binary")]
    asked = _asked(model, axes, used) | {y, *per_key} | ({"exposure", "area"} if stat == "cash" else set())
    columns = [c for c in used if c in asked]
    if stat != "cash":
        columns.append("_w")
        points = points.withColumn("_w", F.lit(1.0) if err is None else F.lit(1.0) / (F.col(err) * F.col(err)))
    rows = packed_points(points, keys, columns)
    kinds = ", ".join(f"`{k}` {points.schema[k].dataType.simpleString()}" for k in keys)
    keys = list(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            size, values, nulls = flat(batch, columns)
            with np.errstate(all="ignore"):
                fit.load(size, values, nulls)
                out, converged = fit.run()
            none = np.isnan(out[:, -1])
            arrays = [batch.column(batch.schema.get_field_index(k)) for k in keys]
            arrays += [pa.array(out[:, i], mask=none) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(converged, mask=none), pa.array(size)], names=[*keys, *names, "converged", "_np"])

    return rows.mapInArrow(run, f"{kinds}, {', '.join(f'`{c}` double' for c in names)}, converged boolean, _np bigint")


def _asked(model: Callable, axes, columns: Sequence[str]) -> set[str]:
    """Names of the columns that a model reads."""
    names: set[str] = set()

    class Listed(Arrays):
        def col(self, c: str) -> np.ndarray:
            names.add(c)
            return np.ones(1)

    with np.errstate(all="ignore"):
        model({a.name: np.ones(1) for a in axes}, Listed({}, {}))
    return names
