"""Chunked Bayesian blocks against the search over a whole series."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest

from burstframe.operators import blocks as B

KEYS = ["burst_id", "band"]
SCHEMA = "burst_id string, band string, bin_idx long, t double, rate double, rate_err double, counts long, binsize double"


def whole(t, fitness, a, err=None, p0=0.01):
    """Textbook search: every start is tried for every end."""
    n = len(t)
    edges = np.concatenate([t[:1], 0.5 * (t[1:] + t[:-1]), t[-1:]])
    if fitness == "measures":
        good = err[err > 0]
        w = 1 / (np.where(err > 0, err, good.min() if len(good) else 1.0) / 2) ** 2
        ca, cb = np.append(0, np.cumsum(w)), np.append(0, np.cumsum(w * a))
    else:
        ca = np.append(0, np.cumsum(a))
    best, last = np.zeros(n + 1), np.zeros(n, int)
    for r in range(n):
        k = np.arange(r + 1)
        s = ca[r + 1] - ca[k]
        with np.errstate(divide="ignore", invalid="ignore"):
            fit = (cb[r + 1] - cb[k]) ** 2 / (2 * s) if fitness == "measures" else np.where(s > 0, s * (np.log(s) - np.log(edges[r + 1] - edges[k])), 0)
        score = best[: r + 1] + fit
        last[r] = np.argmax(score)
        best[r + 1] = score.max() - (4 - np.log(73.53 * p0 * n**-0.478))
    ends, r = [], n
    while r > 0:
        ends.append((edges[last[r - 1]], edges[r]))
        r = last[r - 1]
    return ends[::-1]


def series(rng, n, clustered=False):
    t = np.cumsum(rng.exponential(1, n) ** (6 if clustered else 1)) + 1e-3 * np.arange(n)
    level = np.repeat(rng.integers(1, 40, n // 9 + 1), 9)[:n]
    counts = rng.poisson(level)
    return t, counts, np.where(rng.random(n) < 0.1, 0.0, np.sqrt(np.maximum(counts, 1)))


@pytest.fixture(scope="module")
def curves():
    rng = np.random.default_rng(7)
    return {name: series(rng, n, c) for name, n, c in (("a", 150, False), ("b", 61, True), ("c", 2, False), ("d", 1, False), ("e", 30, True), ("f", 20, False))}


@pytest.fixture(scope="module")
def table(spark, curves):
    rows = [(name, "x", i, float(t[i]), float(c[i]), float(e[i]), int(c[i]), 1.0) for name, (t, c, e) in curves.items() for i in range(len(t))]
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


@pytest.mark.parametrize("fitness", ["events", "measures"])
@pytest.mark.parametrize("chunk_bins", [7, 20, 1 << 16])
def test_chunks_give_the_whole_search(table, curves, fitness, chunk_bins):
    got = B.bayesian_block_edges(table, KEYS, fitness, chunk_bins=chunk_bins).toPandas().sort_values(["burst_id", "block"])
    for name, (t, c, e) in curves.items():
        rows = got[got.burst_id == name]
        want = whole(t, fitness, c.astype(float), e)
        assert rows.block.tolist() == list(range(len(want)))
        assert np.allclose(rows[["t_lo", "t_hi"]].to_numpy(), np.array(want), rtol=1e-12)


def test_search_in_chunks_hands_on_what_it_needs():
    """Without Spark: any cuts give the same pointers."""
    rng = np.random.default_rng(1)
    t, c, _ = series(rng, 400)
    edges = np.concatenate([t[:1], 0.5 * (t[1:] + t[:-1]), t[-1:]])
    prior, zero = B.cost_of_cut(0.01, 400), np.zeros(400)
    one, _ = B.search_chunk(B.OpenStarts(), 0, edges, "events", prior, c.astype(float), zero)
    for cuts in ([0, 400], [0, 1, 2, 399, 400], [0, 130, 260, 400]):
        state, last = B.OpenStarts(), []
        for i, j in zip(cuts, cuts[1:]):
            part, state = B.search_chunk(state, i, edges[i : j + 1], "events", prior, c[i:j].astype(float), zero[i:j])
            last += part.tolist()
        assert last == one.tolist()


def test_empty(table):
    assert B.bayesian_block_edges(table.limit(0), KEYS).count() == 0
    assert B.greedy_block_edges(table.limit(0), KEYS).count() == 0


def greedy(t, rate, binsize, gamma=4.0):
    """Greedy merging on arrays of one series."""
    cum = np.concatenate([[0], np.cumsum(np.maximum((rate * binsize).astype(int), 0))])
    total = int(cum[-1])
    if total == 0 or len(t) < 2:
        return [(t[0], t[-1])]
    edges = np.unique(np.append(t[np.searchsorted(cum, np.arange(0, total, max(1, total // 50)), side="right") - 1], t[-1]))
    for _ in range(10):
        kept = [edges[0]]
        for hi in edges[1:-1]:
            n = cum[np.searchsorted(t, hi)] - cum[np.searchsorted(t, kept[-1])]
            if n > 0 and n * np.log(n / (hi - kept[-1])) - gamma > -0.1 * gamma:
                kept.append(hi)
        kept.append(edges[-1])
        if len(kept) == len(edges):
            break
        edges = np.array(kept)
    return list(zip(edges[:-1], edges[1:])) if len(edges) > 1 else [(edges[0], edges[0])]


def test_greedy(spark, table, curves):
    zero = pd.DataFrame([("z", "x", i, float(i), 0.0, 0.0, 0, 1.0) for i in range(5)], columns=["burst_id", "band", "bin_idx", "t", "rate", "rate_err", "counts", "binsize"])
    got = B.greedy_block_edges(table.unionByName(spark.createDataFrame(zero, SCHEMA)), KEYS).toPandas().sort_values(["burst_id", "block"])
    want = {name: greedy(t, c.astype(float), 1.0) for name, (t, c, _) in curves.items()} | {"z": [(0.0, 4.0)]}
    for name, edges in want.items():
        assert [tuple(r) for r in got[got.burst_id == name][["t_lo", "t_hi"]].to_numpy()] == [tuple(map(float, e)) for e in edges]


def test_arrow_batches_are_bounded(spark):
    from burstframe.session import tune

    assert int(tune(spark).conf.get("spark.sql.execution.arrow.maxBytesPerBatch")) <= 64 << 20
