"""Rank-one updates against full eigenproblems, and whitening against numpy in extended precision."""

from __future__ import annotations

import math

import numpy as np
import pytest


def _rows(rng, kind, n, d):
    if kind == "clustered":
        return rng.integers(0, 3, (n, d)) * 50
    if kind == "low rank":
        return rng.integers(-9, 9, (n, 3)) @ rng.integers(-9, 9, (3, d))
    if kind == "equal":
        return np.full((n, d), 7)
    if kind == "axes":
        return np.eye(d, dtype=int)[np.arange(n) % d] * 10
    return (rng.standard_normal((n, d)) * 64 * np.geomspace(1, 1e-2 if kind == "plain" else 1e4, d)).astype(int)


def _scatter(x):
    c = x - x.mean(axis=0)
    return c.T @ c


def _check(spectrum, x):
    want = _scatter(x.astype(float))
    got = spectrum.vectors * spectrum.values @ spectrum.vectors.T
    size = max(np.abs(want).max(), 1)
    assert np.abs(got - want).max() <= 1e-11 * size
    assert np.abs(spectrum.vectors.T @ spectrum.vectors - np.eye(x.shape[1])).max() < 1e-11
    assert np.abs(spectrum.values - np.linalg.eigvalsh(want)).max() <= 1e-11 * size


KINDS = ["plain", "steep", "clustered", "low rank", "equal", "axes"]


@pytest.mark.parametrize("kind", KINDS)
@pytest.mark.parametrize("d", [1, 2, 12])
def test_spectra(kind, d):
    """Rows one at a time, in batches, and merged."""
    from burstframe.llm.whitening import Spectrum

    rng = np.random.default_rng(d)
    x = _rows(rng, kind, 150, d)
    single, batch, halves = Spectrum(d), Spectrum(d), [Spectrum(d), Spectrum(d)]
    for row in x:
        single.add(row[None])
    for i in range(0, 150, 40):
        batch.add(x[i : i + 40])
    halves[0].add(x[:90])
    halves[1].add(x[90:])
    halves[0].merge(halves[1])
    for s in (single, batch, halves[0]):
        assert s.n == 150 and s.sums == x.sum(axis=0).tolist()
        _check(s, x)


def test_secular_roots():
    from burstframe.llm.whitening import solve_secular

    rng = np.random.default_rng(0)
    for _ in range(200):
        k = rng.integers(1, 20)
        d = np.sort(rng.choice(10**6, k, replace=False)) * 10.0 ** rng.integers(-8, 8)
        z2 = rng.random(k) ** 6 * 10.0 ** rng.integers(-6, 6)
        origin, x = solve_secular(d, z2)
        roots = d[origin] + x
        want = np.linalg.eigvalsh(np.diag(d) + np.outer(np.sqrt(z2), np.sqrt(z2)))
        assert np.abs(roots - want).max() <= 1e-12 * max(np.abs(want).max(), 1e-300)


def _table(spark, vectors, parts=3):
    rows = [(i, [float(c) if c is not None else None for c in v] if v is not None else None, "n", 5) for i, v in vectors]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, n string, x int").repartition(parts)


def _brute(vectors, components):
    x = np.array([[math.floor(64 * float(np.float32(c))) + 1000000 for c in v] for _, v in vectors], dtype=object)
    n, s = len(x), x.sum(axis=0)
    centred = (n * x - s).astype(np.longdouble) / n
    values, vecs = np.linalg.eigh((centred.T @ centred / n).astype(float))
    values, vecs = values[::-1][:components], vecs[:, ::-1][:, :components]
    return ((n * x - s) ** 2).sum(axis=1), (centred @ vecs / np.sqrt(values)).astype(float), values / np.trace((centred.T @ centred / n).astype(float))


@pytest.mark.parametrize("parts", [1, 11])
def test_whitening(spark, parts, monkeypatch):
    from burstframe.llm import whitening as W

    monkeypatch.setattr(W, "FAN_IN", 3)
    rng = np.random.default_rng(1)
    good = [(i, rng.standard_normal(10) * np.geomspace(0.2, 3, 10)) for i in range(300)]
    good += [(7, good[7][1]), (7, good[8][1]), (None, good[9][1])]  # repeated row, repeated id, no id
    bad = [(900, None), (901, [1.0] * 9 + [None]), (902, [1.0] * 9 + [math.nan]), (903, [math.inf] * 10), (904, []), (905, [1.0] * 3), (906, [1e20] * 10)]
    got = W.whiten(_table(spark, good + bad, parts), components=6).collect()
    deviation, whitened, explained = _brute(good, 6)
    assert len(got) == 6 * len(good) and {r["n"] for r in got} == {len(good)}
    assert {r["identity_error"] for r in got} == {got[0]["identity_error"]} and got[0]["identity_error"] < 1e-12
    for c in range(6):
        mine = sorted((str(r["vec_id"]), r["deviation"], r["whitened"]) for r in got if r["component"] == c + 1)
        signs = [1, -1]
        theirs = [sorted((str(i), int(d), s * w) for (i, _), d, w in zip(good, deviation, whitened[:, c])) for s in signs]
        assert [m[:2] for m in mine] == [t[:2] for t in theirs[0]]
        assert min(max(abs(m[2] - t[2]) for m, t in zip(mine, t)) for t in theirs) < 1e-9
        assert abs(next(r["explained"] for r in got if r["component"] == c + 1) / explained[c] - 1) < 1e-12


def test_whitening_without_variance(spark):
    from burstframe.llm.whitening import whiten

    assert whiten(_table(spark, [(1, [1.0, 2.0])])).count() == 0
    assert whiten(_table(spark, [(i, [1.0, 2.0]) for i in range(5)])).count() == 0
    assert whiten(_table(spark, [(1, None)])).count() == 0
    assert whiten(_table(spark, [(1, [0.0])]).limit(0)).columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    line = whiten(_table(spark, [(i, [i / 64, i / 32, 5.0]) for i in range(8)])).collect()  # one direction only
    assert len(line) == 8 and abs(line[0]["explained"] - 1) < 1e-12 and line[0]["identity_error"] < 1e-12


def test_deviation_is_exact():
    from burstframe.llm.whitening import numerators, squares

    rows = np.array([[3 << 40, -(1 << 40)], [1, 2]])
    n, sums = 2, [int(s) for s in rows.sum(axis=0)]
    want = [sum((n * int(c) - s) ** 2 for c, s in zip(r, sums)) for r in rows]
    assert squares(numerators(rows, n, sums)) == [w if w < 1 << 63 else None for w in want]
    assert squares(numerators(rows * 0 + [[5, 5], [1, 2]], 2, [6, 7])) == [16 + 9, 16 + 9]


def test_query_on_embeddings(spark):
    from burstframe.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    good = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding").collect()]
    got = QUERIES["op13_whitening"](spark, sf).collect()
    deviation, whitened, explained = _brute(good, 32)
    assert len(got) == 32 * len(good) and got[0]["identity_error"] < 1e-10
    by_row = {(r["vec_id"], r["component"]): r for r in got}
    assert [by_row[i, 1]["deviation"] for i, _ in good] == deviation.tolist()
    for c in range(32):
        mine = np.array([by_row[i, c + 1]["whitened"] for i, _ in good])
        assert min(np.abs(mine - s * whitened[:, c]).max() for s in (1, -1)) < 1e-8
