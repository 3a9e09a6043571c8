"""Bayesian blocks (optimal partition of a series, Scargle et al. 2013) and the statistics of blocks.

The search is sequential in time.  Series are cut into chunks of bins, and the search goes chunk by chunk over all series at once: a chunk gets from the
one before it only the starts that can still win (the others are pruned exactly), and writes the best start of the block that ends at each of its bins.
The way back follows these pointers from the last chunk to the first, handing on one position per series.  So no task holds more than a chunk and the
open starts, a lost task repeats one chunk, and short series are done in one round each way.
Block statistics go back to Spark as an equi-join on the block number.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from burstframe.operators.lightcurve import KEYS
from burstframe.operators.reuse import keep
from burstframe.operators.series import asof_merge, attach, running_sums, with_position

#: Bins of one chunk of the search.
CHUNK_BINS = 1 << 16


class OpenStarts:
    """Starts that can still win, and the running totals, between two chunks of one series."""

    FIELDS = ("at", "best", "a", "b", "edge")

    def __init__(self, at=(), best=(), a=(), b=(), edge=(), end_best: float = 0.0, end_a: float = 0.0, end_b: float = 0.0):
        self.at = np.asarray(at, int)
        self.best, self.a, self.b, self.edge = (np.asarray(v, float) for v in (best, a, b, edge))
        self.end_best, self.end_a, self.end_b = end_best, end_a, end_b


def search_chunk(before: OpenStarts, first: int, edges: np.ndarray, fitness: str, prior: float, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, OpenStarts]:
    """Best start of the block that ends at each bin of a chunk (bins ``first`` ..., one more edge than bins), and what the next chunk needs."""
    m, n_open = len(a), len(before.at)
    ca, cb = (np.cumsum(np.concatenate([[total], v])) for total, v in ((before.end_a, a), (before.end_b, b)))
    at = np.concatenate([before.at, first + np.arange(m)])
    best = np.concatenate([before.best, [before.end_best], np.zeros(m)])  # one longer: the best up to the end of the chunk
    start_a, start_b = np.concatenate([before.a, ca[:-1]]), np.concatenate([before.b, cb[:-1]])
    start_edge = np.concatenate([before.edge, edges[:-1]])
    last = np.zeros(m, int)
    alive = np.arange(n_open)
    for i in range(m):
        alive = np.append(alive, n_open + i)
        sa = ca[i + 1] - start_a[alive]
        if fitness == "events":
            width = edges[i + 1] - start_edge[alive]
            with np.errstate(divide="ignore", invalid="ignore"):
                fit = np.where(sa > 0, sa * (np.log(sa) - np.log(width)), 0.0)
        else:
            sb = cb[i + 1] - start_b[alive]
            fit = sb * sb / (2.0 * sa)
        score = best[alive] + fit
        top = int(np.argmax(score))
        best[n_open + i + 1] = score[top] - prior
        last[i] = at[alive[top]]
        # a start that is already behind a cut here can never catch up: fitness only gains from a split
        alive = alive[score >= best[n_open + i + 1]]
    return last, OpenStarts(at[alive], best[alive], start_a[alive], start_b[alive], start_edge[alive], float(best[n_open + m]), float(ca[-1]), float(cb[-1]))


def cost_of_cut(p0: float, n: int) -> float:
    return 4.0 - np.log(73.53 * p0 * n**-0.478)


def change_points(edges: np.ndarray, fitness: str, p0: float, a: np.ndarray, b: np.ndarray | None = None) -> np.ndarray:
    """Indices of block starts of one series.  ``a``: counts ('events') or 1/sigma^2 ('measures', with b = x/sigma^2)."""
    last, _ = search_chunk(OpenStarts(), 0, edges, fitness, cost_of_cut(p0, len(a)), a, np.zeros(len(a)) if b is None else b)
    starts, r = [], len(a)
    while r > 0:
        r = last[r - 1]
        starts.append(r)
    return np.array(starts[::-1])


def _each(rows: DataFrame, keys: Sequence[str], fields: str, fn: Callable[[dict], Iterator[tuple]]) -> DataFrame:
    """Rows of (keys, fields) that ``fn`` gives for each row, in Arrow batches."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # explicit: small inputs still use every core
    kinds = ", ".join(f"`{k}` {rows.schema[k].dataType.simpleString()}" for k in keys)
    names = [*keys, *[f.split()[0] for f in fields.split(", ")]]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            yield pd.DataFrame([(*[r[k] for k in keys], *row) for r in f.to_dict("records") for row in fn(r)], columns=names)

    return rows.repartition(n, *keys, F.lit(0)).mapInPandas(run, f"{kinds}, {fields}")


def _chunks(lc: DataFrame, keys: list[str], columns: Sequence[str], size: int) -> DataFrame:
    """(keys, _chunk, _n bins of the series, t and columns as arrays, _prev and _next time), written by chunk."""
    rows = with_position(lc.select(*keys, "t", *columns), keys, ["t", *columns], "_pos", "_n")
    packed = rows.groupBy(*keys, F.floor(F.col("_pos") / size).cast("int").alias("_chunk")).agg(
        F.max("_n").alias("_n"), F.array_sort(F.collect_list(F.struct("_pos", "t", *columns))).alias("_rows"))
    arrays = packed.select(*keys, "_chunk", "_n", *[F.col("_rows")[c].alias(c) for c in ("t", *columns)])
    along = Window.partitionBy(*keys).orderBy("_chunk")  # one row for each chunk of a series
    ends = arrays.select(*keys, "_chunk", F.element_at("t", 1).alias("_a"), F.element_at("t", -1).alias("_z"))
    ends = ends.select(*keys, "_chunk", F.lag("_z").over(along).alias("_prev"), F.lead("_a").over(along).alias("_next"))
    return keep(arrays.join(ends, [*keys, "_chunk"]), "_chunk")


def _edges(r: dict) -> np.ndarray:
    """Edges of a chunk's bins: midpoints, and the outer times at the ends of the series."""
    t = np.asarray(r["t"], float)
    first = t[0] if pd.isna(r["_prev"]) else 0.5 * (r["_prev"] + t[0])
    return np.concatenate([[first], 0.5 * (t[1:] + t[:-1]), [t[-1] if pd.isna(r["_next"]) else 0.5 * (t[-1] + r["_next"])]])


_STATE = "at array<bigint>, best array<double>, a array<double>, b array<double>, edge array<double>, end_best double, end_a double, end_b double"


def bayesian_block_edges(
    lc: DataFrame, keys: Sequence[str] = KEYS, fitness: str = "measures", p0: float = 0.01, chunk_bins: int | None = None
) -> DataFrame:
    """(keys, block, t_lo, t_hi) per series, in order of time; a series of one bin is one block without width."""
    keys, size = list(keys), chunk_bins or CHUNK_BINS
    if fitness == "events":
        chunks = _chunks(lc, keys, ["counts"], size)
    else:  # bins without an error get the smallest of the series
        least = lc.groupBy(*keys).agg(F.coalesce(F.min(F.when(F.col("rate_err") > 0, F.col("rate_err"))), F.lit(1.0)).alias("_least"))
        errs = attach(lc.select(*keys, "t", "rate", "rate_err"), least, keys)
        errs = errs.withColumn("rate_err", F.when(F.col("rate_err") > 0, F.col("rate_err")).otherwise(F.col("_least")))
        chunks = _chunks(errs, keys, ["rate", "rate_err"], size)

    def forward(r: dict) -> Iterator[tuple]:
        state = OpenStarts() if r["_chunk"] == 0 else OpenStarts(*[r[f] for f in OpenStarts.FIELDS], r["end_best"], r["end_a"], r["end_b"])
        if fitness == "events":
            a = np.asarray(r["counts"], float)
            b = np.zeros(len(a))
        else:
            a = 1.0 / (np.asarray(r["rate_err"], float) / 2.0) ** 2
            b = a * np.asarray(r["rate"], float)
        last, after = search_chunk(state, r["_chunk"] * size, _edges(r), fitness, cost_of_cut(p0, r["_n"]), a, b)
        yield last, *[getattr(after, f) for f in OpenStarts.FIELDS], after.end_best, after.end_a, after.end_b

    most = chunks.agg(F.max("_chunk")).first()[0]
    most = -1 if most is None else most
    pointers, state = [], None
    for c in range(most + 1):
        rows = chunks.where(F.col("_chunk") == c)
        if c:
            rows = rows.join(state, keys)
        found = keep(_each(rows, keys, f"last array<bigint>, {_STATE}", forward))
        pointers.append(found.select(*keys, "last"))
        state = found.drop("last")

    def backward(r: dict) -> Iterator[tuple]:
        """Blocks that start in this chunk, and the open end (position, start if its edge is in an earlier chunk, upper edge) that is left."""
        base, last, edges = r["_chunk"] * size, r["last"], _edges(r)
        at, start, hi = (r["_n"], None, edges[-1]) if pd.isna(r["at"]) else (int(r["at"]), None if pd.isna(r["start"]) else int(r["start"]), r["edge"])
        found: list[tuple] = []
        while at > base or start is not None:
            start = int(last[at - 1 - base]) if start is None else start
            if start < base:
                break
            lo = float(edges[start - base])
            found.append((start, lo, hi))
            at, start, hi = start, None, lo
        yield [f[0] for f in found], [f[1] for f in found], [f[2] for f in found], at, start, hi

    blocks = None
    cursor = chunks.limit(0).select(*keys, F.lit(0).cast("long").alias("at"), F.lit(0).cast("long").alias("start"), F.lit(0.0).alias("edge"))
    for c in range(most, -1, -1):
        rows = chunks.where(F.col("_chunk") == c).join(pointers[c], keys).join(cursor, keys, "left")
        found = keep(_each(rows, keys, "_s array<bigint>, t_lo array<double>, t_hi array<double>, at bigint, start bigint, edge double", backward))
        cursor = found.select(*keys, "at", "start", "edge")
        here = found.select(*keys, F.inline(F.arrays_zip("_s", "t_lo", "t_hi")))
        blocks = here if blocks is None else blocks.unionByName(here)
    if blocks is None:
        return lc.limit(0).select(*keys, F.lit(0).cast("long").alias("block"), F.lit(0.0).alias("t_lo"), F.lit(0.0).alias("t_hi"))
    return with_position(blocks, keys, ["_s"], "block").select(*keys, "block", "t_lo", "t_hi")


def greedy_block_edges(lc: DataFrame, keys: Sequence[str] = KEYS, gamma: float = 4.0) -> DataFrame:
    """Greedy variant on repeated event times: up to ten passes over candidate edges.

    A bin stands for int(rate * bin) events at its time; candidates are the times of every fiftieth part of the events.  An inner edge stays when the
    block that ends there has n ln(n / T) - gamma > -0.1 gamma.  Only the candidates of a series, about fifty, meet in one row.
    """
    keys = list(keys)
    events = F.greatest((F.col("rate") * F.col("binsize")).cast("long"), F.lit(0))
    rows = with_position(lc.select(*keys, "t", "rate", "binsize", events.alias("_ev")), keys, ["t", "rate", "binsize"], "_pos")
    cum = keep(running_sums(rows, keys, "_pos", {"_to": F.col("_ev")}))
    ends = cum.groupBy(*keys).agg(F.min("t").alias("_a"), F.max("t").alias("_z"), F.max("_to").alias("_total"), F.count(F.lit(1)).alias("_n"))
    step = F.greatest(F.lit(1).cast("long"), F.floor(F.col("_total") / 50))
    hit = (F.col("_ev") > 0) & (F.floor((F.col("_to") - 1) / step) * step >= F.col("_to") - F.col("_ev"))
    times = attach(cum, ends.select(*keys, "_total"), keys).groupBy(*keys, "t").agg(F.max(hit).alias("_hit"), F.min(F.col("_to") - F.col("_ev")).alias("_before"))
    picked = times.where("_hit").groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("t", "_before"))).alias("_p"))
    picked = picked.select(*keys, F.col("_p.t").alias("t"), F.col("_p._before").alias("before"))

    def find(r: dict) -> Iterator[tuple]:
        if not r["_total"] or r["_n"] < 2:
            return iter([(0, r["_a"], r["_z"])])
        before = dict(zip(r["t"], r["before"]))
        edges = sorted({*r["t"], r["_z"]})
        for _ in range(10):
            kept = [edges[0]]
            for hi in edges[1:-1]:
                lo = kept[-1]
                n = before[hi] - before[lo]
                if n > 0 and n * np.log(n / (hi - lo)) - gamma > -0.1 * gamma:
                    kept.append(hi)
            kept.append(edges[-1])
            if len(kept) == len(edges):
                break
            edges = kept
        pairs = list(zip(edges[:-1], edges[1:])) if len(edges) > 1 else [(edges[0], edges[0])]
        return iter([(i, float(lo), float(hi)) for i, (lo, hi) in enumerate(pairs)])

    return _each(attach(ends, picked, keys, "left"), keys, "block bigint, t_lo double, t_hi double", find)


def block_statistics(lc: DataFrame, edges: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Mean rate, error and width per block; both ends closed, so a bin on an edge counts twice."""
    keys = list(keys)
    before = edges.select(*keys, (F.col("block") + 1).alias("block"), F.col("t_hi").alias("_before"))
    blocks = edges.join(before, [*keys, "block"], "left").select(*keys, F.col("t_lo").alias("t"), "block", "t_hi", "_before")
    at = asof_merge(blocks, lc.select(*keys, "t", "rate", "rate_err", "binsize"), keys, "t", ["block", "t_hi", "_before"])
    own, on_edge = F.col("t") <= F.col("_left.t_hi"), (F.col("t") == F.col("_left.t")) & (F.col("t") == F.col("_left._before"))
    both = F.array_compact(F.array(F.when(own, F.col("_left.block")), F.when(on_edge, F.col("_left.block") - 1)))
    hit = at.select(*keys, "rate", "rate_err", "binsize", F.explode(both).alias("block"))
    stats = hit.groupBy(*keys, "block").agg(
        F.avg("rate").alias("rate"), F.count(F.lit(1)).alias("n"),
        (F.sqrt(F.sum(F.col("rate_err") * F.col("rate_err"))) / F.count(F.lit(1))).alias("rate_err"),
        F.sum(F.col("rate") * F.col("binsize")).alias("counts"))
    return edges.join(stats, [*keys, "block"], "left").withColumns(
        {"rate": F.coalesce("rate", F.lit(0.0)), "n": F.coalesce("n", F.lit(0)), "width": F.col("t_hi") - F.col("t_lo")})


def bayesian_blocks(
    lc: DataFrame, keys: Sequence[str] = KEYS, p0: float = 0.01, bands: Sequence[str] | None = None, band: str = "band"
) -> DataFrame:
    """Blocks with rates and errors for every series (or the named bands that exist)."""
    if bands is not None:
        lc = lc.filter(F.col(band).isin(list(bands)))
    return block_statistics(lc, keep(bayesian_block_edges(lc, keys, "measures", p0)), keys)
