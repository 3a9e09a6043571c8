"""Afterglow decay operators, all on the shared grid-profile fit."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from burstframe.operators.fit import Axis, curvature_errors, profile_fit
from burstframe.operators.local_fit import POINTS, TOGETHER, blocks, flat, packed_points
from burstframe.operators.reuse import keep
from burstframe.operators.series import attach, running_sums, with_position

KEYS = ("burst_id",)


def _decay(p: dict, x) -> Column:
    return x.pow(x.col("t"), -p["decay_index"])


def _with_norm_range(points: DataFrame, keys: Sequence[str]) -> DataFrame:
    r = points.groupBy(*keys).agg((F.min("flux") * 0.5).alias("_f_lo"), (F.max("flux") * 2.0).alias("_f_hi"))
    return attach(points, r, keys)


def power_law_decay(
    points: DataFrame, keys: Sequence[str] = KEYS, refine: bool = True, t0: float = 0.0, n: int = 99, errors: bool = False
) -> DataFrame:
    """flux = F0 (t - t0)^-a, a in [0.1, 5], F0 between half the lowest and twice the highest flux."""
    src = points.withColumn("t", F.col("t") - F.lit(t0)) if t0 else points
    src = _with_norm_range(src, keys)
    fit = profile_fit(src, keys, [Axis("decay_index", 0.1, 5.0, n)], _decay, refine=refine, norm_bounds=("_f_lo", "_f_hi"))
    fit = fit.withColumn("dof", F.col("n_points") - 2)
    if errors:
        fit = attach(fit, curvature_errors(src, keys, fit, ["decay_index"], _decay), keys, "left")
    return fit.withColumnRenamed("stat", "chi_sq")


def numbered(points: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Rows with 0-based ``pos`` in time order and the series length ``n``."""
    return keep(with_position(points, keys, ["t"], "pos", "n"))


def _anchors(rows: DataFrame, keys: Sequence[str], wanted: dict[str, Column]) -> DataFrame:
    """Per-series values at given positions: name -> (condition column, value column) as max of when."""
    return attach(rows, rows.groupBy(*keys).agg(*[F.max(c).alias(k) for k, c in wanted.items()]), keys)


def _at(pos: Column, value: str) -> Column:
    return F.when(F.col("pos") == pos, F.col(value))


def broken_power_law(rows: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """f0 [(t/tb)^(a1 s) + (t/tb)^(a2 s)]^(-1/s) with f0 the first flux; needs numbered rows."""
    pts = _anchors(rows.filter("n >= 4"), keys, {
        "_f0": _at(F.lit(0), "flux"), "_tlo": _at(F.lit(1), "t"), "_thi": _at(F.col("n") - 2, "t")})

    def model(p, x):
        u = x.ln(x.col("t") / p["t_break"]) * p["smoothness"]
        return x.col("_f0") * x.pow(x.exp(u * p["alpha1"]) + x.exp(u * p["alpha2"]), -1.0 / p["smoothness"])

    axes = [Axis("alpha1", 0.1, 3.0, 5), Axis("alpha2", 1.0, 5.0, 5), Axis("t_break", "_tlo", "_thi", 6, True),
            Axis("smoothness", 0.5, 5.0, 3, True)]
    fit = profile_fit(pts, keys, axes, model, norm_bounds=(1.0, 1.0), min_points=4)
    return fit.withColumn("dof", F.col("n_points") - 4).withColumnRenamed("stat", "chi_sq")


def double_broken_power_law(rows: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Three power laws through the first flux at the first break."""
    pts = _anchors(rows.filter("n >= 6"), keys, {
        "_f0": _at(F.lit(0), "flux"), "_t1": _at(F.lit(1), "t"), "_t2": _at(F.lit(2), "t"),
        "_t3": _at(F.col("n") - 3, "t"), "_t4": _at(F.col("n") - 2, "t")})

    def model(p, x):
        t = x.col("t")
        knee = x.pow(p["t_break2"] / p["t_break1"], -p["alpha2"])
        late = x.when(t < p["t_break2"], x.pow(t / p["t_break1"], -p["alpha2"]), knee * x.pow(t / p["t_break2"], -p["alpha3"]))
        return x.col("_f0") * x.when(t < p["t_break1"], x.pow(t / p["t_break1"], -p["alpha1"]), late)

    axes = [Axis("alpha1", 0.1, 3.0, 4), Axis("alpha2", 0.5, 3.0, 4), Axis("alpha3", 1.0, 5.0, 4),
            Axis("t_break1", "_t1", "_t3", 4, True), Axis("t_break2", "_t2", "_t4", 4, True)]
    fit = profile_fit(pts, keys, axes, model, norm_bounds=(1.0, 1.0), min_points=6)
    return fit.withColumn("dof", F.col("n_points") - 5).withColumnRenamed("stat", "chi_sq")


def detect_plateau(rows: DataFrame, keys: Sequence[str] = KEYS, n_grid: int = 99) -> DataFrame:
    """Sliding-window decay fits; plateau where the index is under 0.5.

    A window holds max(3, n // 10) points, so it grows with the series.  Series of at most ``POINTS`` points are fitted where they are packed
    (:func:`_packed_indices`); of longer ones a window's sums are two running sums added (:func:`_window_indices`), so they are never multiplied by their window.
    """
    keys = list(keys)
    w = F.greatest(F.lit(3), F.floor(F.col("n") / 10)).cast("long")
    base = keep(rows.filter("n >= 10").select(*keys, "pos", "n", "t", "flux", "flux_err").withColumn("_w", w))
    best = _packed_indices(base.where(F.col("n") <= POINTS), keys, n_grid)
    if not base.where(F.col("n") > POINTS).isEmpty():
        best = best.unionByName(_window_indices(base.where(F.col("n") > POINTS), keys, n_grid))
    low = best.filter("abs(_alpha) < 0.5").select(*keys, (F.col("_s") + F.floor(F.col("_w") / 2)).alias("pos"), "_alpha")
    mid = low.join(base.select(*keys, "pos", "t"), [*keys, "pos"])
    span = keep(mid.groupBy(*keys).agg(F.min("t").alias("start_time"), F.max("t").alias("end_time"), F.avg("_alpha").alias("mean_alpha")))
    level = attach(base, span, keys).filter(F.col("t").between(F.col("start_time"), F.col("end_time"))).groupBy(*keys).agg(
        F.avg("flux").alias("plateau_level"))
    every = rows.select(*keys).distinct()
    return attach(attach(every, span, keys, "left"), level, keys, "left").withColumn(
        "has_plateau", F.col("start_time").isNotNull())


def _packed_indices(base: DataFrame, keys: list[str], n_grid: int) -> DataFrame:
    """Best index per window (``_s``, ``_w``, ``_alpha``) of packed series; a part of a window on one side of a block border without any usable point leaves index 0 of the grid."""
    a = 0.1 + 4.9 * np.arange(n_grid) / (n_grid - 1.0)
    columns = ["pos", "_w", "t", "flux", "_wt"]
    rows = packed_points(base.withColumn("_wt", F.lit(1.0) / (F.col("flux_err") * F.col("flux_err"))), keys, columns)
    kinds = ", ".join(f"`{k}` {base.schema[k].dataType.simpleString()}" for k in keys)

    def best(size: np.ndarray, v: dict[str, np.ndarray], nulls: dict[str, np.ndarray]) -> tuple[np.ndarray, ...]:
        """(series, first position, window, index) of all windows of a block of series, whose points are in order."""
        first = np.cumsum(size) - size
        w = v["_w"][first].astype(np.int64)
        none = np.zeros(len(v["pos"]), bool)
        lost = nulls.get("flux", none) | nulls.get("_wt", none)
        flux, wt = np.where(lost, 0.0, v["flux"]), np.where(lost, 0.0, v["_wt"])
        late = nulls.get("t", none)
        m = np.power(np.where(late, 1.0, v["t"])[:, None], -a)
        m = np.where(late[:, None], 0.0, m)
        terms = ((flux * wt)[:, None] * m, wt[:, None] * m * m, (flux * flux * wt)[:, None])
        seen = np.concatenate([[0], np.cumsum(~(lost | late))])
        low, high = np.where(lost, np.inf, flux), np.where(lost, -np.inf, flux)
        out = []
        for k in np.unique(w):
            of = np.flatnonzero((w == k) & (size > k))
            n = size[of] - k
            owner = np.repeat(of, n)
            start = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
            at = first[owner] + start
            fm, mm, ff = (sum(q[at + j] for j in range(k)) for q in terms)
            lo, hi = low[at], high[at]
            for j in range(1, k):
                lo, hi = np.minimum(lo, low[at + j]), np.maximum(hi, high[at + j])
            norm = np.maximum(lo[:, None] * 0.5, np.fmin(hi[:, None] * 2.0, np.where(mm == 0, np.nan, fm / mm)))
            chi = ff - 2.0 * norm * fm + norm * norm * mm
            border = np.where(start % k == 0, at + k, at + k - start % k)
            usable = (seen[border] > seen[at]) & ((border == at + k) | (seen[at + k] > seen[border]))
            g = np.argmin(np.where(np.isnan(chi) | ~usable[:, None], np.inf, chi), axis=1)
            out.append((owner, start, np.full(len(at), k), a[g]))
        return tuple(np.concatenate(c) for c in zip(*out))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            size, values, nulls = flat(batch, columns)
            order = np.lexsort((values["pos"], np.repeat(np.arange(len(size)), size)))
            values, nulls = {c: x[order] for c, x in values.items()}, {c: x[order] for c, x in nulls.items()}
            end = np.cumsum(size)
            for i, j in blocks(size, TOGETHER // 8):
                part = slice(end[i] - size[i], end[j - 1])
                with np.errstate(all="ignore"):
                    owner, start, w, index = best(size[i:j], {c: x[part] for c, x in values.items()}, {c: x[part] for c, x in nulls.items()})
                at = pa.array(owner + i)
                yield pa.RecordBatch.from_arrays([*[batch.column(batch.schema.get_field_index(k)).take(at) for k in keys], pa.array(start), pa.array(w), pa.array(index)],
                                                 names=[*keys, "_s", "_w", "_alpha"])

    return rows.mapInArrow(run, f"{kinds}, _s bigint, _w bigint, _alpha double")


def _window_indices(base: DataFrame, keys: list[str], n_grid: int) -> DataFrame:
    """Best index per window from running sums.

    The series is cut into blocks of one window length; a window is the tail of one block plus the head of the next, so
    its sums are a backward plus a forward running sum and nothing is subtracted.
    """
    grid = base.withColumn("_g", F.explode(F.sequence(F.lit(0), F.lit(n_grid - 1)))).withColumn(
        "_a", F.lit(0.1) + F.lit(4.9) * F.col("_g") / F.lit(n_grid - 1.0))
    m, wt = F.pow(F.col("t"), -F.col("_a")), F.lit(1.0) / (F.col("flux_err") * F.col("flux_err"))
    grid = keep(grid.select(
        *keys, "_g", "_a", "_w", "n", "pos", F.floor(F.col("pos") / F.col("_w")).cast("long").alias("_blk"),
        (F.col("flux") * m * wt).alias("_vfm"), (m * m * wt).alias("_vmm"), (F.col("flux") * F.col("flux") * wt).alias("_vff")))
    names = ("_fm", "_mm", "_ff")
    sums = {c: F.col(f"_v{c[1:]}") for c in names}
    part = [*keys, "_g", "_blk"]
    head = running_sums(grid, part, "pos", sums).select(
        *keys, "_g", "_a", "_w", "n", (F.col("pos") - F.col("_w") + 1).alias("_s"), *names)
    tail = running_sums(grid.withColumn("_back", (F.col("_blk") + 1) * F.col("_w") - 1 - F.col("pos")), part, "_back", sums).select(
        *keys, "_g", F.col("pos").alias("_s"), *[F.col(c).alias(f"{c}0") for c in names])
    win = head.filter((F.col("_s") >= 0) & (F.col("_s") < F.col("n") - F.col("_w"))).join(tail, [*keys, "_g", "_s"])
    whole = F.col("_s") % F.col("_w") == 0
    win = win.select(*keys, "_g", "_a", "_w", "_s", *[
        F.when(whole, F.col(c)).otherwise(F.col(c) + F.col(f"{c}0")).alias(c) for c in names])
    scored = win.join(_window_extremes(base, keys), [*keys, "_s"])
    norm = F.greatest(F.col("_fmin") * 0.5, F.least(F.col("_fmax") * 2.0, F.try_divide("_fm", "_mm")))
    scored = scored.withColumn("_nrm", norm).withColumn(
        "_chi", F.col("_ff") - F.lit(2.0) * F.col("_nrm") * F.col("_fm") + F.col("_nrm") * F.col("_nrm") * F.col("_mm"))
    return scored.groupBy(*keys, "_s", "_w").agg(F.min_by("_a", F.struct("_chi", "_g")).alias("_alpha"))


def _window_extremes(base: DataFrame, keys: list[str]) -> DataFrame:
    """Lowest and highest flux of each window, from two overlapping power-of-two blocks (sparse table).

    Level j holds the extremes of 2^j rows from each position; every level is one self-join on position.
    Windows are short unless a series is long, and only series that need a level take part in it.
    """
    level = base.select(*keys, "pos", "n", "_w", F.col("flux").alias("_lo"), F.col("flux").alias("_hi"))
    start = F.col("pos").alias("_s")
    top = F.floor(F.log2(F.col("_w").cast("double")) + F.lit(1e-9)).cast("int")
    done = []
    widest = base.agg(F.max("_w")).first()[0] or 1
    j = 0
    while (1 << j) <= widest:
        half = 1 << j
        take = level.filter(top == j)
        right = take.select(*keys, (F.col("pos") - F.col("_w") + half).alias("pos"), F.col("_lo").alias("_lo2"),
                            F.col("_hi").alias("_hi2"))
        done.append(take.join(right, [*keys, "pos"]).select(
            *keys, start, F.least("_lo", "_lo2").alias("_fmin"), F.greatest("_hi", "_hi2").alias("_fmax")))
        j += 1
        if (1 << j) > widest:
            break
        more = level.filter(top >= j)
        nxt = more.select(*keys, (F.col("pos") - half).alias("pos"), F.col("_lo").alias("_lo2"), F.col("_hi").alias("_hi2"))
        level = keep(more.join(nxt, [*keys, "pos"]).select(
            *keys, "pos", "n", "_w", F.least("_lo", "_lo2").alias("_lo"), F.greatest("_hi", "_hi2").alias("_hi")))
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out


def detect_jet_break(rows: DataFrame, keys: Sequence[str] = KEYS, refine: bool = True, n_grid: int = 99) -> DataFrame:
    """Decay index of both halves; break at the first time of the second half when they differ by > 0.5."""
    keys = list(keys)
    split = F.floor(F.col("n") / 2)
    halves = rows.filter("n >= 20").withColumn("_half", F.when(F.col("pos") < split, 0).otherwise(1))
    fits = power_law_decay(halves, [*keys, "_half"], refine=refine, n=n_grid)
    wide = fits.groupBy(*keys).agg(
        F.max(F.when(F.col("_half") == 0, F.col("decay_index"))).alias("alpha_before"),
        F.max(F.when(F.col("_half") == 1, F.col("decay_index"))).alias("alpha_after"))
    at = halves.filter(F.col("pos") == split).select(*keys, F.col("t").alias("_tb"))
    every = rows.select(*keys).distinct()
    out = attach(attach(every, wide, keys, "left"), at, keys, "left")
    diff = F.col("alpha_after") - F.col("alpha_before")
    has = F.coalesce(F.abs(diff) > 0.5, F.lit(False))
    return out.select(
        *keys, has.alias("has_jet_break"), F.when(has, F.col("_tb")).alias("break_time"),
        F.when(has, F.col("alpha_before")).alias("alpha_before"), F.when(has, F.col("alpha_after")).alias("alpha_after"),
        F.when(has, diff).alias("steepening"))


def reverse_shock(rows: DataFrame, keys: Sequence[str] = KEYS, refine: bool = True, n_grid: int = 99) -> DataFrame:
    """Steep (> 2) decay of the first quarter of the points."""
    early = rows.filter((F.col("n") >= 10) & (F.floor(F.col("n") / 4) >= 3) & (F.col("pos") < F.floor(F.col("n") / 4)))
    fit = power_law_decay(early, keys, refine=refine, n=n_grid).filter("decay_index > 2").select(*keys, "decay_index")
    return attach(rows.select(*keys).distinct(), fit, keys, "left").withColumn(
        "has_reverse_shock", F.col("decay_index").isNotNull())


def energy_injection(rows: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Index alpha0 - 0.5 before and alpha0 after the end of injection, continuous there."""
    pts = _with_norm_range(_anchors(rows.filter("n >= 4"), keys, {
        "_tlo": _at(F.lit(1), "t"), "_thi": _at(F.col("n") - 2, "t")}), keys)

    def model(p, x):
        t, a, te = x.col("t"), p["alpha0"], p["injection_end"]
        return x.when(t < te, x.pow(t, 0.5 - a), x.pow(te, 0.5 - a) * x.pow(t / te, -a))

    fit = profile_fit(pts, keys, [Axis("alpha0", 0.5, 5.0, 19), Axis("injection_end", "_tlo", "_thi", 12, True)], model,
                      norm_bounds=("_f_lo", "_f_hi"), min_points=4)
    # the second index of the published form is unused by its model and keeps its start value
    return fit.withColumns({"alpha1": F.when(F.col("fit_success"), F.lit(1.5)),
                            "injection_rate": F.col("alpha0") - F.lit(1.5) - F.lit(0.5)}).withColumnRenamed("stat", "chi_sq")


def multi_band_fit(
    points: DataFrame, burst: str = "burst_id", band: str = "band", n_tb: int = 20, n_alpha: int = 10
) -> DataFrame:
    """Shared break time; two indices and a norm per band.

    For a fixed break the bands decouple, and inside a band the points before and after the break meet only in
    the norm.  So each point is summed for its own side's indices only; pairs of indices are formed from those
    sums, per (burst, break, band), and chi2 adds up over bands.  Norms stay in [0.01, 100].  Points are dealt by burst once and packed; a point then
    meets every break as a row with its powers (:func:`_powers`), and sums and pairs of whole bursts are numpy blocks (:func:`_best_breaks`).  Bursts of more than
    ``POINTS`` points keep one aggregate per grid point (:func:`_long_bands`).
    """
    ends = points.groupBy(burst).agg((F.min(band) < F.max(band)).alias("_two"), F.min("t").alias("_a"), F.max("t").alias("_z"), F.count(F.lit(1)).alias("_n"))
    span = keep(ends.withColumn("_some", F.col("_two") & (F.col("_z") > F.col("_a"))))
    points = points.repartition(int(points.sparkSession.conf.get("spark.sql.shuffle.partitions")), burst).withColumn("_o", F.monotonically_increasing_id())
    good = span.filter("_some").select(burst, "_a", "_z", "_n")
    rows = attach(points, good.filter(F.col("_n") <= POINTS), [burst])
    out = _best_breaks(_powers(rows, burst, band, n_tb, n_alpha), points, burst, band, n_tb, n_alpha)
    long = good.filter(F.col("_n") > POINTS)
    if not long.isEmpty():
        out = out.unionByName(_long_bands(attach(points, long, [burst]), long, burst, band, n_tb, n_alpha))
    return attach(span.select(burst), out, [burst], "left").withColumn("fit_success", F.col("chi_sq").isNotNull())


def _break(k: Column | int, n_tb: int) -> Column:
    return F.exp(F.ln("_a") + (F.ln("_z") - F.ln("_a")) * (F.lit(k) + 1) / F.lit(n_tb + 1.0))


def _indices(n_alpha: int) -> tuple[np.ndarray, np.ndarray]:
    """Grids of the index before and after the break."""
    g = np.arange(n_alpha)
    return 0.1 + 2.9 * g / (n_alpha - 1.0), 0.5 + 4.5 * g / (n_alpha - 1.0)


def _powers(rows: DataFrame, burst: str, band: str, n_tb: int, n_alpha: int) -> DataFrame:
    """A row for every (burst, point, break), in this order, with the powers of the time for the indices of its side; what belongs to a point stands at its first break.

    Points keep the order in which they were dealt (``_o``), so sums do not depend on how a group was collected.
    """
    w = F.lit(1.0) / (F.col("flux_err") * F.col("flux_err"))
    one = rows.groupBy(burst).agg(F.first("_a").alias("_a"), F.first("_z").alias("_z"), F.collect_list(
        F.struct("_o", F.col(band).alias("b"), F.col("t").cast("double").alias("t"), F.col("flux").cast("double").alias("f"), w.alias("w"))).alias("_r"))
    one = one.select(burst, F.monotonically_increasing_id().alias("_row"), F.array(*[_break(k, n_tb) for k in range(n_tb)]).alias("_tbs"), F.sort_array("_r").alias("_r"))
    grid = one.select(burst, "_row", "_tbs", F.explode("_r").alias("_p")).select(burst, "_row", "_p", F.posexplode("_tbs").alias("_k", "_tb"))
    grid = grid.withColumn("_x", F.col("_p.t") / F.col("_tb"))
    side = F.col("_x") >= 1
    first = lambda c: F.when(F.col("_k") == 0, c)
    return grid.select("_row", first(F.col(burst)).alias("burst"), first(F.col("_p.b")).alias("band"), first(F.col("_p.f")).alias("flux"), first(F.col("_p.w")).alias("w"), "_tb", "_x",
                       *[F.pow("_x", F.when(side, F.lit(-float(late))).otherwise(F.lit(-float(early)))).alias(f"_m{i}")
                         for i, (early, late) in enumerate(zip(*_indices(n_alpha)))])


def _best_breaks(rows: DataFrame, points: DataFrame, burst: str, band: str, n_tb: int, n_alpha: int) -> DataFrame:
    """The best break of every burst of :func:`_powers`, whose rows come burst by burst."""
    early, late = _indices(n_alpha)
    powers = [f"_m{i}" for i in range(n_alpha)]

    def fit(rows: pa.Table) -> pa.RecordBatch:
        """Whole bursts; sums go over the points in the order of the rows, over bands in their own order, and a sum over nothing but nulls is null."""
        point = rows.select(["_row", "burst", "band", "flux", "w"]).take(pa.array(np.arange(0, len(rows), n_tb)))
        number = point["_row"].to_numpy()
        names = point["band"].combine_chunks().dictionary_encode()
        place = np.empty(len(names.dictionary) + 1, np.int64)
        place[pc.array_sort_indices(names.dictionary).to_numpy()] = np.arange(1, len(place))
        place[-1] = 0  # a null band comes first
        code = place[names.indices.fill_null(len(place) - 1).to_numpy(zero_copy_only=False)]
        order = np.lexsort((code, number))
        number, code = number[order], code[order]
        start = np.flatnonzero(np.r_[True, (number[1:] != number[:-1]) | (code[1:] != code[:-1])])  # of each band of a burst
        of_burst = np.flatnonzero(np.r_[True, number[start][1:] != number[start][:-1]])
        flux, w = (point[c].to_numpy()[order] for c in ("flux", "w"))
        usable, weighted = ~_nulls(point, "flux", "w")[order], ~_nulls(point, "w")[order]
        x = rows["_x"].to_numpy().reshape(-1, n_tb)[order]
        timed = ~_nulls(rows, "_x").reshape(-1, n_tb)[order]
        after = timed & (x >= 1)
        add = _adder(start, len(number))
        f, w = np.where(usable, flux, 0.0)[:, None, None], np.where(weighted, w, 0.0)[:, None, None]
        m = np.stack([rows[c].to_numpy().reshape(-1, n_tb)[order] for c in powers], axis=2)
        m[~timed] = 0
        fm, mm, ff = f * m * w, m * m * w, (f * f * w)[:, :, 0]
        sums, n, lost = [], 0, False
        for side in (timed & ~after, after):
            some = add((side & usable[:, None]).astype(np.int64))
            count = add(side.astype(np.int64))
            n, lost = n + count, lost | (count > 0) & (some == 0)
            sums.append((add(np.where(side[:, :, None], fm, 0.0)), add(np.where(side[:, :, None], mm, 0.0)), add(np.where(side, ff, 0.0))))
        found = []
        for c in range(0, len(start), 256):
            fm, mm = (sums[0][k][c : c + 256, :, :, None] + sums[1][k][c : c + 256, :, None, :] for k in (0, 1))
            ff = (sums[0][2] + sums[1][2])[c : c + 256, :, None, None]
            norm = np.fmax(0.01, np.fmin(100.0, fm / mm))
            chi = (ff - 2.0 * norm * fm + norm * norm * mm).reshape(len(ff), n_tb, -1)
            best = np.argmin(np.where(np.isnan(chi), np.inf, chi), axis=2)
            found.append((best, *(np.take_along_axis(v.reshape(chi.shape), best[:, :, None], 2)[:, :, 0] for v in (chi, norm))))
        best, chi, norm = (np.concatenate(v) for v in zip(*found))
        best, norm = np.where(lost, 0, best), np.where(lost, 100.0, norm)
        add = _adder(of_burst, len(start))
        total, known = add(np.where(lost, 0.0, chi)), add((~lost).astype(np.int64)) > 0
        k = np.argmin(np.where(known, np.where(np.isnan(total), np.inf, total), -np.inf), axis=1)
        one = np.arange(len(of_burst))
        bands = np.diff(np.r_[of_burst, len(start)])
        at = (np.arange(len(start)), np.repeat(k, bands))
        index = best[at]
        first = pa.array(order[start])
        fits = pa.StructArray.from_arrays([pa.array(early[index // n_alpha]), pa.array(late[index % n_alpha]), pa.array(norm[at])], ["alpha1", "alpha2", "norm"])
        entries = pa.StructArray.from_arrays([point["band"].combine_chunks().take(first), fits], ["band", "fit"])
        lists = pa.ListArray.from_arrays(pa.array(np.r_[of_burst, len(start)].astype(np.int32)), entries)
        head = order[start[of_burst]]
        points_used = add(n)[one, k]
        return pa.RecordBatch.from_arrays([
            point["burst"].combine_chunks().take(pa.array(head)), rows["_tb"].combine_chunks().take(pa.array(head * n_tb + k)),
            pa.array(total[one, k], mask=~known[one, k]), lists, pa.array(points_used - 1 - 3 * bands)], names=["burst", "t_break", "chi_sq", "entries", "dof"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        with np.errstate(all="ignore"):
            for batch in batches:
                held.append(batch)
                size += batch.num_rows
                if size < TOGETHER // 4 or not batch.num_rows:
                    continue
                rows = pa.Table.from_batches(held)
                number = batch.column(0)
                whole = len(rows) - int((np.asarray(rows["_row"]) == number[len(number) - 1].as_py()).sum())  # the last burst may go on
                if whole:
                    yield from _parts(rows.slice(0, whole))
                    held = rows.slice(whole).to_batches()
                    size -= whole
            if size:
                yield from _parts(pa.Table.from_batches(held))

    def _parts(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        number = rows["_row"].to_numpy()
        begin = np.flatnonzero(np.r_[True, number[1:] != number[:-1]])
        for a, b in blocks(np.diff(np.r_[begin, len(number)]), TOGETHER // 8):
            yield fit(rows.slice(begin[a], (begin[b] if b < len(begin) else len(number)) - begin[a]))

    kind = {c: points.schema[c].dataType.simpleString() for c in (burst, band)}
    found = rows.mapInArrow(run, f"burst {kind[burst]}, t_break double, chi_sq double, "
                                 f"entries array<struct<band:{kind[band]},fit:struct<alpha1:double,alpha2:double,norm:double>>>, dof bigint")
    return found.select(F.col("burst").alias(burst), "t_break", "chi_sq", F.map_from_entries(F.array_sort("entries")).alias("bands"), "dof")


def _adder(start: np.ndarray, end: int) -> Callable[[np.ndarray], np.ndarray]:
    """Function that adds the rows of each group, one after the other (``np.add.reduceat`` adds the first one last); ``start`` are the first rows of the groups."""
    size = np.diff(np.r_[start, end])
    later = [(at, start[at] + r) for r in range(1, int(size.max())) for at in [np.flatnonzero(size > r)]]

    def add(v: np.ndarray) -> np.ndarray:
        out = v[start]
        for at, rows in later:
            out[at] += v[rows]
        return out

    return add


def _nulls(rows: pa.Table, *columns: str) -> np.ndarray:
    """Rows with a null in one of the columns."""
    return np.logical_or.reduce([rows[c].is_null().to_numpy() for c in columns])


def _long_bands(points: DataFrame, span: DataFrame, burst: str, band: str, n_tb: int, n_alpha: int) -> DataFrame:
    """What :func:`_best_breaks` returns, with an aggregate per grid point; the sums over the grid are formed and used up in the same task, so no grid point is shuffled."""
    tb = _break(F.col("_tb"), n_tb)
    grid = points.withColumn("_tb", F.explode(F.sequence(F.lit(0), F.lit(n_tb - 1)))).withColumn("_x", F.col("t") / tb)
    side = (F.col("_x") >= 1).cast("int")
    steps = F.explode(F.sequence(F.lit(0), F.lit(n_alpha - 1)))
    alpha = lambda s, g: F.when(s == 0, F.lit(0.1) + F.lit(2.9) * g / F.lit(n_alpha - 1.0)).otherwise(
        F.lit(0.5) + F.lit(4.5) * g / F.lit(n_alpha - 1.0))
    w = F.lit(1.0) / (F.col("flux_err") * F.col("flux_err"))
    rows = grid.withColumn("_side", side).withColumn("_i", steps).withColumn(
        "_m", F.pow(F.col("_x"), -alpha(F.col("_side"), F.col("_i"))))
    sums = rows.groupBy(burst, "_tb", band, "_side", "_i").agg(
        F.sum(F.col("flux") * F.col("_m") * w).alias("fm"), F.sum(F.col("_m") * F.col("_m") * w).alias("mm"),
        F.sum(F.col("flux") * F.col("flux") * w).alias("ff"), F.count(F.lit(1)).alias("n"))
    # at most n_alpha entries per side
    rec = F.struct(F.col("_i").alias("i"), "fm", "mm", "ff", "n")
    sides = sums.groupBy(burst, "_tb", band).agg(
        *[F.collect_list(F.when(F.col("_side") == s, rec)).alias(f"_s{s}") for s in (0, 1)])
    empty = F.array(F.struct(F.lit(0).alias("i"), F.lit(0.0).alias("fm"), F.lit(0.0).alias("mm"), F.lit(0.0).alias("ff"),
                             F.lit(0).cast("long").alias("n")))
    full = sides.select(burst, "_tb", band, *[
        F.when(F.size(f"_s{s}") > 0, F.col(f"_s{s}")).otherwise(empty).alias(f"_s{s}") for s in (0, 1)])
    pairs = full.withColumn("p", F.explode("_s0")).withColumn("q", F.explode("_s1"))
    fm, mm, ff = (F.col(f"p.{c}") + F.col(f"q.{c}") for c in ("fm", "mm", "ff"))
    norm = F.greatest(F.lit(0.01), F.least(F.lit(100.0), F.try_divide(fm, mm)))
    scored = pairs.withColumn("norm", norm).withColumn(
        "chi", ff - F.lit(2.0) * F.col("norm") * fm + F.col("norm") * F.col("norm") * mm)
    best = scored.groupBy(burst, "_tb", band).agg(F.min_by(
        F.struct("chi", (F.col("p.n") + F.col("q.n")).alias("n"), alpha(F.lit(0), F.col("p.i")).alias("alpha1"),
                 alpha(F.lit(1), F.col("q.i")).alias("alpha2"), "norm"), F.struct("chi", F.col("p.i"), F.col("q.i"))).alias("b"))
    total = best.groupBy(burst, "_tb").agg(
        F.sum("b.chi").alias("chi_sq"), F.sum("b.n").alias("_np"), F.count(F.lit(1)).alias("_k"),
        F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col(band), F.struct("b.alpha1", "b.alpha2", "b.norm"))))).alias("bands"))
    win = total.groupBy(burst).agg(F.min_by(F.struct("_tb", "chi_sq", "bands", "_np", "_k"), F.struct("chi_sq", "_tb")).alias("w"))
    return attach(win.select(burst, "w.*"), span, [burst]).select(
        burst, tb.alias("t_break"), "chi_sq", "bands", (F.col("_np") - F.lit(1) - F.lit(3) * F.col("_k")).alias("dof"))


def normalised(points: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Finite positive points with time since the first one (+0.01) and flux limits."""
    good = points.filter((F.col("t") > 0) & (F.col("flux") > 0) & ~F.isnan("flux") & ~F.isnan("t"))
    first = good.groupBy(*keys).agg(F.min("t").alias("_t0"))
    return attach(good, first, keys).select(
        *keys, (F.col("t") - F.col("_t0") + F.lit(0.01)).alias("t_rel"), "flux",
        (F.col("flux") - F.col("flux_err")).alias("flux_lo"), (F.col("flux") + F.col("flux_err")).alias("flux_hi"))
