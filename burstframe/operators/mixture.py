"""Gaussian mixtures in the (log T90, log hardness) plane."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from burstframe.operators.population import finite
from burstframe.operators.reuse import keep

# A component is (weight, (mx, my), ((cxx, cxy), (cxy, cyy))).
Component = tuple[float, tuple[float, float], tuple[tuple[float, float], tuple[float, float]]]
TYPES = ("full", "tied", "diag", "spherical")


def log_density(x: Column, y: Column, comp: Component) -> Column:
    """Log of weight times the 2-D normal density."""
    w, (mx, my), ((a, b), (_, d)) = comp
    det = a * d - b * b
    dx, dy = x - F.lit(mx), y - F.lit(my)
    q = (F.lit(d / det) * dx * dx - F.lit(2 * b / det) * dx * dy + F.lit(a / det) * dy * dy)
    return F.lit(math.log(w) - math.log(2 * math.pi) - 0.5 * math.log(det)) - q / F.lit(2.0)


def posterior(x: Column, y: Column, comps: Sequence[Component]) -> list[Column]:
    """Membership probabilities, safe against underflow."""
    logs = [log_density(x, y, c) for c in comps]
    top = F.greatest(*logs) if len(logs) > 1 else logs[0]
    parts = [F.exp(v - top) for v in logs]
    total = sum(parts[1:], parts[0])
    return [p / total for p in parts]


def negative_log_likelihood(x: Column, y: Column, comps: Sequence[Component]) -> Column:
    logs = [log_density(x, y, c) for c in comps]
    top = F.greatest(*logs) if len(logs) > 1 else logs[0]
    return -(top + F.ln(sum((F.exp(v - top) for v in logs[1:]), F.exp(logs[0] - top))))


def short_index(comps: Sequence[Component]) -> int:
    """Component with the smallest mean log T90."""
    return min(range(len(comps)), key=lambda i: comps[i][1][0])


def fit_mixture(
    df: DataFrame, x: str = "log_t90", y: str = "log_hr", k: int = 2, covariance_type: str = "full", seed: int = 42,
    max_iter: int = 100, tol: float = 1e-4,
) -> list[Component]:
    """Components of the mixture.

    The full type uses MLlib; the constrained types run expectation-maximisation with one aggregate pass per
    iteration.  Only the sums of the components (a few numbers) reach the driver.
    """
    if covariance_type not in TYPES:
        raise ValueError(f"covariance type must be one of {TYPES}")
    pts = df.filter(finite(F.col(x)) & finite(F.col(y))).select(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"))
    if covariance_type == "full":
        from pyspark.ml.clustering import GaussianMixture
        from pyspark.ml.feature import VectorAssembler

        model = GaussianMixture(k=k, seed=seed, maxIter=max_iter, tol=tol).fit(
            VectorAssembler(inputCols=["x", "y"], outputCol="features").transform(pts))
        out = []
        for w, g in zip(model.weights, model.gaussians):
            c = g.cov.toArray()
            out.append((float(w), (float(g.mean[0]), float(g.mean[1])), ((float(c[0, 0]), float(c[0, 1])), (float(c[1, 0]), float(c[1, 1])))))
        return out
    return _expectation_maximisation(keep(pts), k, covariance_type, max_iter, tol)


def _expectation_maximisation(pts: DataFrame, k: int, kind: str, max_iter: int, tol: float) -> list[Component]:
    s = pts.agg(F.avg("x"), F.avg("y"), F.var_pop("x"), F.var_pop("y"),
                F.percentile_approx("x", [(i + 0.5) / k for i in range(k)], 10000), F.count(F.lit(1))).first()
    vx, vy, n = max(s[2], 1e-6), max(s[3], 1e-6), s[5]
    comps = [(1.0 / k, (float(m), s[1]), ((vx, 0.0), (0.0, vy))) for m in s[4]]
    last = -math.inf
    for _ in range(max_iter):
        x, y = F.col("x"), F.col("y")
        post = posterior(x, y, comps)
        rows = pts.select("x", "y", negative_log_likelihood(x, y, comps).alias("nll"), *[p.alias(f"r{i}") for i, p in enumerate(post)])
        aggs = [F.sum("nll")]
        for i in range(k):
            r = F.col(f"r{i}")
            aggs += [F.sum(r), F.sum(r * x), F.sum(r * y), F.sum(r * x * x), F.sum(r * x * y), F.sum(r * y * y)]
        v = rows.agg(*aggs).first()
        comps, pooled = [], [0.0, 0.0, 0.0]
        for i in range(k):
            w, sx, sy, sxx, sxy, syy = v[1 + 6 * i: 7 + 6 * i]
            w = max(w, 1e-12)
            mx, my = sx / w, sy / w
            cov = [sxx / w - mx * mx, sxy / w - mx * my, syy / w - my * my]
            pooled = [p + c * w / n for p, c in zip(pooled, cov)]
            comps.append((w / n, (mx, my), cov))
        comps = [(w, m, _constrain(pooled if kind == "tied" else c, kind)) for w, m, c in comps]
        score = -v[0] / n
        if abs(score - last) < tol:
            break
        last = score
    return comps


def _constrain(c: Sequence[float], kind: str) -> tuple[tuple[float, float], tuple[float, float]]:
    a, b, d = c[0] + 1e-6, c[1], c[2] + 1e-6
    if kind == "diag":
        b = 0.0
    elif kind == "spherical":
        a = d = (a + d) / 2
        b = 0.0
    return ((a, b), (b, d))


def components_frame(spark, comps: Sequence[Component]) -> DataFrame:
    return spark.createDataFrame(
        [(i, w, list(m), [list(r) for r in c]) for i, (w, m, c) in enumerate(comps)],
        "component int, weight double, means array<double>, cov array<array<double>>")


def predict(df: DataFrame, comps: Sequence[Component], x: str = "log_t90", y: str = "log_hr") -> DataFrame:
    """Adds the most probable component."""
    if not comps:
        raise ValueError("mixture is not fitted")
    post = posterior(F.col(x), F.col(y), comps)
    best = F.array_position(F.array(*post), F.greatest(*post)) - 1 if len(post) > 1 else F.lit(0)
    return df.withColumn("component", best.cast("int"))


def short_probability(x: Column, y: Column, comps: Sequence[Component]) -> Column:
    return posterior(x, y, comps)[short_index(comps)]


def classify(df: DataFrame, comps: Sequence[Component], t90: str = "t90", hr: str = "hr_ratio") -> tuple[DataFrame, DataFrame]:
    """(classified rows, rejected rows); both inputs must be positive."""
    good = (F.col(t90) > 0) & (F.col(hr) > 0)
    ok = df.filter(good).withColumn("short_probability", short_probability(F.log10(t90), F.log10(hr), comps))
    bad = df.filter(~F.coalesce(good, F.lit(False))).withColumn("reason", F.lit("duration and hardness must be positive"))
    return ok.withColumn("mixture_class", F.when(F.col("short_probability") >= 0.5, "Short").otherwise("Long")), bad


def surface(df: DataFrame, comps: Sequence[Component], n: int = 200, x: str = "log_t90", y: str = "log_hr", what: str = "short") -> DataFrame:
    """Short probability (or negative log-likelihood) on an n x n grid over the sample range +- 5 %."""
    lim = df.filter(finite(F.col(x)) & finite(F.col(y))).agg(
        F.min(x).alias("a"), F.max(x).alias("z"), F.min(y).alias("b"), F.max(y).alias("t"))
    side = lambda name: F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias(name)
    g = lim.select("*", side("i")).repartition("i").select("*", side("j"))
    at = lambda lo, hi, i: F.col(lo) - 0.05 * (F.col(hi) - F.col(lo)) + F.col(i) * 1.1 * (F.col(hi) - F.col(lo)) / (n - 1)
    pts = g.select("i", "j", at("a", "z", "i").alias("x"), at("b", "t", "j").alias("y"))
    v = short_probability(F.col("x"), F.col("y"), comps) if what == "short" else negative_log_likelihood(F.col("x"), F.col("y"), comps)
    return pts.withColumn("value", v)
