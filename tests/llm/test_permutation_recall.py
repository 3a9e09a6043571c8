"""Recall of the permutation index at its registered share, on whole blocks and small ones, and ids that stand more than once."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F


def _recall(spark, x, step, k=5):
    from burstframe.llm.permutation_index import search

    df = spark.createDataFrame(pd.DataFrame({"vec_id": np.arange(len(x)), "embedding": list(x.tolist())}), "vec_id long, embedding array<double>")
    got = search(df, F.col("vec_id") % step == 0, k=k).toPandas()
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    hits = total = 0
    for q, rows in got.groupby("query_id"):
        s = unit @ unit[q]
        s[q] = -2
        assert sorted(rows["rank"]) == list(range(1, k + 1))
        hits += len(set(np.argsort(-s)[:k]) & set(rows["vec_id"]))
        total += k
    assert total == k * -(-len(x) // step)
    return hits / total


@pytest.mark.parametrize("kind", ["random", "clustered"])
@pytest.mark.parametrize("n", [200, 2000, 16384])
def test_recall(spark, kind, n):
    rng = np.random.default_rng(n)
    x = rng.standard_normal((n, 64))
    if kind == "clustered":
        x = 0.4 * x + rng.standard_normal((50, 64))[rng.integers(0, 50, n)]
    assert _recall(spark, x, max(n // 200, 1)) >= 0.9


def test_repeated_ids(spark):
    """An id is one query and one candidate; its best pair of vectors counts."""
    from burstframe.llm.permutation_index import search

    rng = np.random.default_rng(3)
    x = rng.standard_normal((60, 8))
    ids = [*range(50), *[1] * 8, 7, 7]  # id 1 stands nine times, 7 three times
    df = spark.createDataFrame([(i, v.tolist()) for i, v in zip(ids, x)], "vec_id long, embedding array<double>")
    got = search(df, F.col("vec_id") % 7 <= 1, k=5, rerank=1.0).collect()
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    s = unit @ unit.T
    for q in sorted({i for i in ids if i % 7 <= 1}):
        best = {}
        for a, i in enumerate(ids):
            for b, j in enumerate(ids):
                if i == q != j:
                    best[j] = max(best.get(j, -2), s[a, b])
        want = sorted(best.items(), key=lambda kv: (-kv[1], kv[0]))[:5]
        mine = sorted((r["rank"], r["vec_id"], r["score"]) for r in got if r["query_id"] == q)
        assert [(r, i) for r, i, _ in mine] == [(r + 1, i) for r, (i, _) in enumerate(want)]
        assert np.allclose([m[2] for m in mine], [w[1] for w in want], atol=1e-12)
