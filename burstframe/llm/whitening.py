"""Whitening of vectors by incremental eigendecomposition.

Every partition keeps the spectrum of its scatter matrix and updates it by centred rank-one terms: the secular equation gives the new eigenvalues, entries that
are already eigenvectors and equal eigenvalues are deflated.  A batch with more rows than dimensions is first brought to triangular form, whose few rows have the
same scatter.  Spectra of partitions are combined in rounds of a few: the eigenvectors of one, scaled by the roots of their eigenvalues, and the difference
of the means are rank-one terms of the other.  The vectors found so span the space; one more distributed pass (Rayleigh-Ritz) projects all rows on
them, and the small eigenproblem of the summed products corrects what rounding left.

Entries are scaled to integers, so counts, sums and centred numerators are exact.  What leaves a task is a matrix of dimensions squared.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from burstframe.operators.reuse import keep

#: Scale and shift of the integers.
SCALE, SHIFT = 64, 1_000_000
EPS = float(np.finfo(float).eps)
PART = "part long, n long, sums array<long>, numbers array<double>"
FAN_IN = 8


def solve_secular(d: np.ndarray, z2: np.ndarray, steps: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """Roots of ``1 + sum(z2 / (d - x)) = 0`` for ascending distinct ``d`` and positive ``z2``: (nearest pole, distance from it) of each root.

    Root i lies between pole i and the next (the last one within the sum of ``z2``).  Each step fits two poles to the function and its slope; a step that
    leaves the bracket becomes a bisection.
    """
    k = len(d)
    reach = float(z2.sum())
    gap = np.append(np.diff(d), reach)
    middle = d + gap / 2
    with np.errstate(divide="ignore"):  # the last root may be closer to its pole than rounding tells; it is set below
        left = 1 + (z2 / (d - middle[:, None])).sum(axis=1) >= 0  # the root is in the left half
    left[-1] = True
    origin = np.where(left, np.arange(k), np.minimum(np.arange(k) + 1, k - 1))
    poles = d[None, :] - d[origin][:, None]  # seen from each root's origin
    low, high = np.where(left, 0.0, -gap / 2), np.where(left, gap / 2, 0.0)
    high[-1] = reach
    upper = np.append(poles[np.arange(k - 1), np.arange(1, k)], reach)
    lower = poles[np.arange(k), np.arange(k)]
    x = (low + high) / 2
    before = np.tril(np.ones((k, k), bool))
    for _ in range(steps):
        terms = z2 / (poles - x[:, None])
        slopes = terms / (poles - x[:, None])
        f = 1 + terms.sum(axis=1)
        low, high = np.where(f < 0, x, low), np.where(f < 0, high, x)
        done = np.abs(f) <= EPS * k * (1 + np.abs(terms).sum(axis=1))
        if done.all():
            break
        a, b = lower - x, upper - x
        df1, df2 = (slopes * before).sum(axis=1), (slopes * ~before).sum(axis=1)
        c = f - a * df1 - b * df2
        p, q = (a + b) * f - a * b * (df1 + df2), a * b * f
        with np.errstate(all="ignore"):
            root = np.sqrt(np.maximum(p * p - 4 * q * c, 0))
            step = np.where(p <= 0, (p - root) / (2 * c), 2 * q / (p + root))
        new = x + step
        inside = np.isfinite(new) & (new > low) & (new < high)
        new = np.where(inside, new, (low + high) / 2)
        still = done | (new == x)
        if still.all():
            break
        x = np.where(still, x, new)
    return origin, x


def rank_one(values: np.ndarray, vectors: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spectrum (ascending values, vectors in columns) of ``vectors @ diag(values) @ vectors.T + outer(v, v)``."""
    size = float(v @ v)
    if not size:
        return values, vectors
    z = vectors.T @ v
    tiny = EPS * len(z) * max(size, float(values[-1]))
    vectors = vectors.copy()
    cuts = np.nonzero(np.diff(values) > tiny)[0] + 1  # equal values: turn their vectors until one of them takes all of v
    for first, end in zip([0, *cuts], [*cuts, len(values)]):
        w = z[first:end].copy()
        norm = float(np.sqrt(w @ w))
        if end - first > 1 and norm:
            mirror = w.copy()
            mirror[-1] += norm if w[-1] >= 0 else -norm
            mirror /= np.sqrt(mirror @ mirror)
            vectors[:, first:end] -= 2 * np.outer(vectors[:, first:end] @ mirror, mirror)
            z[first:end] = 0
            z[end - 1] = -norm if w[-1] >= 0 else norm
    active = np.nonzero(z * z > EPS * EPS * size)[0]
    if len(active):
        d, za = values[active], z[active]
        origin, x = solve_secular(d, za * za)
        apart = (d[None, :] - d[origin][:, None]) - x[:, None]  # pole j minus root i
        # the numbers for which these roots are exact: keeps the vectors orthogonal
        k = len(d)
        ratio = np.ones((k, k))
        gaps = d[:, None] - d[None, :]  # [j, i]: pole j minus pole i
        i, j = np.meshgrid(np.arange(k), np.arange(k - 1))
        ratio[j, i] = -apart[j, i] / np.where(j < i, gaps[j, i], gaps[j + 1, i])
        exact = np.sqrt(np.abs(ratio.prod(axis=0) * apart[-1])) * np.sign(za)
        u = (exact[None, :] / apart).T
        u /= np.sqrt((u * u).sum(axis=0))
        values = values.copy()
        values[active] = d[origin] + x
        vectors[:, active] = vectors[:, active] @ u
    order = np.argsort(values, kind="stable")
    return values[order], vectors[:, order]


class Spectrum:
    """Count, exact sums and spectrum of the scatter matrix of the integer rows met so far."""

    def __init__(self, d: int):
        self.n, self.sums = 0, [0] * d
        self.values, self.vectors = np.zeros(d), np.eye(d)

    def _term(self, v: np.ndarray) -> None:
        self.values, self.vectors = rank_one(self.values, self.vectors, v)

    def _shift(self, n: int, sums: list[int]) -> None:
        """Take in ``n`` rows as if they all stood at their mean."""
        if self.n:
            apart = np.array([a * self.n - b * n for a, b in zip(sums, self.sums)], float) / (n * self.n)
            self._term(np.sqrt(n * self.n / (n + self.n)) * apart)
        self.n += n
        self.sums = [a + b for a, b in zip(self.sums, sums)]

    def add(self, rows: np.ndarray) -> None:
        sums, n = [int(s) for s in rows.sum(axis=0)], len(rows)
        centred = numerators(rows, n, sums).astype(float) / n
        if n > rows.shape[1]:
            centred = np.linalg.qr(centred, mode="r")
        for v in centred:
            self._term(v)
        self._shift(n, sums)

    def merge(self, other: Spectrum) -> None:
        for value, v in zip(other.values, other.vectors.T):
            if value > 0:
                self._term(np.sqrt(value) * v)
        self._shift(other.n, other.sums)

    def packed(self) -> tuple[int, list[int], np.ndarray]:
        return self.n, self.sums, np.concatenate([self.values, self.vectors.ravel()])

    @classmethod
    def unpacked(cls, n: int, sums, numbers) -> Spectrum:
        out = cls(len(sums))
        out.n, out.sums = int(n), [int(s) for s in sums]
        numbers = np.asarray(numbers, float)
        out.values, out.vectors = numbers[: len(sums)], numbers[len(sums) :].reshape(len(sums), -1)
        return out


def numerators(rows: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """``n * rows - sums``, exact (Python integers where 64 bits are too few)."""
    top = max(int(np.abs(rows).max(initial=0)) * n, *[abs(s) for s in sums], 0)
    if top >= 1 << 61:
        rows = rows.astype(object)
    return rows * n - np.array(sums, dtype=rows.dtype)


def squares(numbers: np.ndarray) -> list[int | None]:
    """Sum of the squares of each row, exact; None beyond a long."""
    if numbers.size and (numbers.dtype == object or int(np.abs(numbers).max()) ** 2 * numbers.shape[1] >= 1 << 63):
        found = (numbers.astype(object) ** 2).sum(axis=1)
        return [s if s < 1 << 63 else None for s in found.tolist()]
    return (numbers**2).sum(axis=1).tolist()


def usable(vector: Column) -> Column:
    """Not null, not empty, and all entries are finite numbers below 2**46 (their integers are exact doubles)."""
    fine = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float(1 << 46)))
    return F.coalesce(fine & (F.size(vector) > 0), F.lit(False))


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def _per_partition(rows: DataFrame, start: Callable[[], object], step: Callable[[object, np.ndarray], None], end: Callable[[object], tuple], d: int) -> DataFrame:
    """One row of ``PART`` for each partition of ``rows`` (column ``x``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        state = None
        for batch in batches:
            if batch.num_rows:
                state = start() if state is None else state
                step(state, _matrix(batch.column(0), d))
        if state is not None:
            n, sums, numbers = end(state)
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([n], pa.int64()),
                                              pa.array([sums], pa.list_(pa.int64())), pa.array([numbers.tolist()], pa.list_(pa.float64()))],
                                             names=["part", "n", "sums", "numbers"])

    return rows.select("x").mapInArrow(run, PART)


def _combined(parts: DataFrame, merge: Callable[[pd.DataFrame], tuple]):
    """The one row that is left when ``FAN_IN`` neighbours at a time are merged, round by round."""
    parts = keep(parts)
    width = (parts.agg(F.max("part")).first()[0] or 0) + 1

    def few(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("part")
        n, sums, numbers = merge(group)
        return pd.DataFrame({"part": [group["part"].iloc[0] // FAN_IN], "n": [n], "sums": [list(sums)], "numbers": [list(numbers)]})

    while width > 1:
        parts = parts.groupBy(F.floor(F.col("part") / FAN_IN)).applyInPandas(few, PART)
        width = -(-width // FAN_IN)
    return parts.first()


def _merge_spectra(group: pd.DataFrame) -> tuple:
    spectra = [Spectrum.unpacked(*r) for r in zip(group["n"], group["sums"], group["numbers"])]
    for other in spectra[1:]:
        spectra[0].merge(other)
    return spectra[0].packed()


def _add(group: pd.DataFrame) -> tuple:
    return group["n"].sum(), [], np.sum(np.stack(group["numbers"].to_numpy()), axis=0)


class Whitening:
    """``n``, exact ``sums`` (of the shifted integers), and per component the unit eigenvector (columns), its value and its share of the trace."""

    def __init__(self, n: int, sums: list[int], components: np.ndarray, values: np.ndarray, explained: np.ndarray):
        self.n, self.sums, self.components, self.values, self.explained = n, sums, components, values, explained

    def centred(self, rows: np.ndarray) -> np.ndarray:
        return numerators(rows, self.n, self.sums).astype(float) / self.n

    def whitened(self, rows: np.ndarray) -> np.ndarray:
        return self.centred(rows) @ self.components / np.sqrt(self.values)


def _products(rows: DataFrame, project: Callable[[np.ndarray], np.ndarray], d: int, k: int) -> np.ndarray:
    """Sum over all rows of the outer product of their projection with itself."""

    def step(state: np.ndarray, x: np.ndarray) -> None:
        y = project(x)
        state += y.T @ y

    total = _combined(_per_partition(rows, lambda: np.zeros((k, k)), step, lambda s: (0, [], s.ravel()), d), _add)
    return np.array(total["numbers"]).reshape(k, k)


def integers(vectors: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """(vec_id, x): rows that take part, as shifted integers."""
    v = F.transform(F.col(vector), lambda c: F.floor(c.cast("double") * SCALE).cast("long"))
    rows = keep(vectors.where(usable(F.col(vector))).select(F.col(vec_id).alias("vec_id"), v.alias("x")))
    sizes = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return rows.where(F.size("x") == (sizes["d"] if sizes else 0))


def fit(rows: DataFrame, components: int) -> Whitening | None:
    """Components of all ``rows`` by falling eigenvalue; those without variance are left out."""
    first = rows.select(F.size("x").alias("d")).first()
    if first is None:
        return None
    d = first["d"]
    spectra = _per_partition(rows, lambda: Spectrum(d), Spectrum.add, Spectrum.packed, d)
    one = _combined(spectra, _merge_spectra)
    total = Spectrum.unpacked(one["n"], one["sums"], one["numbers"])
    basis = np.linalg.qr(total.vectors)[0]
    model = Whitening(total.n, total.sums, basis, np.ones(d), np.ones(d))
    values, turn = np.linalg.eigh(_products(rows, lambda x: model.centred(x) @ basis, d, d) / total.n)
    values, vectors = values[::-1], basis @ turn[:, ::-1]
    vectors = vectors * np.where(vectors[np.abs(vectors).argmax(axis=0), np.arange(d)] < 0, -1, 1)
    there = int((values > max(float(values[0]), 0.0) * d * EPS).sum())
    k = min(components, there)
    return Whitening(total.n, total.sums, vectors[:, :k], values[:k], values[:k] / values.sum() if there else values[:0])


def whiten(vectors: DataFrame, components: int = 32, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) of every usable row and component.

    Rows whose vector is null or empty, holds null, non-finite or entries of 2**46 and more, or has another length than most (ties: the longer) take no part.
    Entries become ``floor(64 * c) + 1000000``; covariances divide by n.  ``deviation`` is null where it exceeds a long.  Repeated rows and ids, and
    null ids, are rows like others.  Components without variance are left out: rows that are all equal, one row, or none give an empty result.
    """
    kind = vectors.schema[vec_id].dataType.simpleString()
    schema = f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    rows = integers(vectors, vec_id, vector)
    model = fit(rows, components)
    if model is None or not len(model.values):
        return vectors.sparkSession.createDataFrame([], schema)
    d, k = model.components.shape
    # the whitened rows have the mean zero, up to rounding
    error = float(np.abs(_products(rows, model.whitened, d, k) / model.n - np.eye(k)).max())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column(1), d)
                m = len(x)
                each = pa.array(np.repeat(np.arange(m), k))
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).take(each), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, model.n)),
                    pa.array(squares(numerators(x, model.n, model.sums)), pa.int64()).take(each), pa.array(model.whitened(x).ravel()),
                    pa.array(np.tile(model.explained, m)), pa.array(np.full(m * k, error))],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.select("vec_id", "x").mapInArrow(run, schema)
