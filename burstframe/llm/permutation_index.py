"""Approximate nearest neighbours by a permutation index.

Pivots are a bounded sample of the distinct vectors (``pivots``, by hash).  A vector is represented by its ``prefix`` nearest pivots in order of
nearness.  Blocks of vectors post their members in pivot inverted files: per pivot the members that have it, with its place.
A query adds up, over the files of its own pivots, how much each member's footrule distance (sum of differences of places,
absent pivots at place ``prefix``) falls below that of a member without a common pivot; the nearest ``rerank`` share of each
block is then ranked by the exact cosine.

Equal vectors are indexed once with their smallest ids, so a very common vector neither fills a file nor a task.  Blocks of the index meet blocks of
the stated queries: every row of the index is searched, each task holds one block of either, and only the best few of a block are shuffled.
Posting vectors under their first pivot alone would let clustered data skip blocks, but loses neighbours in data without clusters.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from burstframe.operators.reuse import keep

BLOCK, QUERY_BLOCK = 8192, 2048


def usable(vector: Column) -> Column:
    """Not null, not empty, not zero, and all components are finite numbers."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    return F.coalesce(fine & F.exists(vector, lambda x: x != 0), F.lit(False))


def permutations(unit: np.ndarray, pivots: np.ndarray, prefix: int) -> np.ndarray:
    """The nearest pivots of each row in order (ties to the first pivot)."""
    return np.argsort(-(unit @ pivots.T), axis=1, kind="stable")[:, :prefix]


class Files:
    """Inverted files of one block: per pivot its members and the places they give it."""

    def __init__(self, perms: np.ndarray, n_pivots: int):
        n, self.prefix = perms.shape
        order = np.argsort(perms.ravel(), kind="stable")
        self.members = (order // self.prefix).astype(np.int32)
        self.places = (order % self.prefix).astype(np.int32)
        self.starts = np.searchsorted(perms.ravel()[order], np.arange(n_pivots + 1))
        self.n = n

    def footrule(self, perm: np.ndarray) -> np.ndarray:
        """Distance of every member to a query's permutation."""
        total = np.full(self.n, self.prefix * (self.prefix + 1), np.int32)  # nothing in common
        for place, p in enumerate(perm):
            at = slice(self.starts[p], self.starts[p + 1])
            total[self.members[at]] -= 2 * (self.prefix - np.maximum(place, self.places[at]))
        return total


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def search(vectors: DataFrame, is_query: Column, k: int = 5, pivots: int = 128, prefix: int = 64, rerank: float = 0.25, vec_id: str = "vec_id",
           vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` rows with the largest cosine to each row that ``is_query`` selects, its own row left out.

    Ties go to the smaller id.  Rows with a null id, unusable vectors and vectors of another length than most (ties: the longer) take no part.  An id is one
    query and one candidate, however often it stands: with several vectors the best score of any pair counts, and an id is never its own
    neighbour.  Each block reranks the ``rerank`` share of its members, whatever its size, and enough for ``k`` results.  A query with fewer candidates gets
    all of them; an empty table gives an empty result.
    """
    spark = vectors.sparkSession
    rows = vectors.where(usable(F.col(vector)) & F.col(vec_id).isNotNull())
    rows = rows.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"), F.coalesce(is_query, F.lit(False)).alias("q"))
    rows = rows.withColumns({"h1": F.xxhash64("v"), "h2": F.xxhash64(F.lit(7), "v")})
    sizes = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    result = "query_id long, rank int, vec_id long, score double"
    if sizes is None:
        return spark.createDataFrame([], result)
    rows = rows.where(F.size("v") == sizes["d"])
    near = Window.partitionBy("h1", "h2").orderBy("vec_id")
    first = rows.select("h1", "h2", "vec_id", "v").dropDuplicates(["h1", "h2", "vec_id"]).withColumn("i", F.row_number().over(near)).where(F.col("i") <= k + 1)
    index = keep(first.groupBy("h1", "h2").agg(F.first("v").alias("v"), F.sort_array(F.collect_list("vec_id")).alias("ids")))
    n = index.count()
    chosen = _unit(np.array([r["v"] for r in index.orderBy("h1", "h2").limit(pivots).select("v").collect()]))
    asked = keep(rows.where("q").groupBy("h1", "h2").agg(F.first("v").alias("v")))
    n_blocks, n_asked = max(1, -(-n // BLOCK)), max(1, -(-asked.count() // QUERY_BLOCK))
    shared = spark.sparkContext.broadcast(chosen)  # pivots x dimensions
    prefix = min(prefix, len(chosen))

    def each(n_parts: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n_parts - 1)))

    left = index.select("v", "ids", F.pmod("h2", F.lit(n_blocks)).cast("int").alias("b"), each(n_asked).alias("a"))
    right = asked.select("h1", "h2", "v", F.pmod("h2", F.lit(n_asked)).cast("int").alias("a")).select("h1", "h2", "v", each(n_blocks).alias("b"), "a")

    def best(block: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out = [[], [], [], []]
        if len(block) and len(queries):
            x, y = np.stack(block["v"].to_numpy()), np.stack(queries["v"].to_numpy())
            norms = np.linalg.norm(x, axis=1)
            files = Files(permutations(_unit(x), shared.value, prefix), len(shared.value))
            ids = block["ids"].to_numpy()
            take = min(len(x), max(k + 1, int(np.ceil(rerank * len(x)))))
            for h1, h2, q, perm in zip(queries["h1"], queries["h2"], y, permutations(_unit(y), shared.value, prefix)):
                near = np.argpartition(files.footrule(perm), take - 1)[:take]
                score = (x[near] @ q) / (norms[near] * np.linalg.norm(q))
                wanted = k + 1
                while True:  # more vectors while some of them belong to the same ids
                    m = min(wanted, take)
                    least = np.partition(score, -m)[-m]
                    best_of: dict[int, float] = {}
                    for j, s in zip(near[score >= least], score[score >= least]):
                        for i in ids[j]:
                            best_of[i] = max(s, best_of.get(i, -np.inf))
                    if len(best_of) > k or m == take:
                        break
                    wanted *= 4
                found = sorted((-s, i) for i, s in best_of.items())[: k + 1]
                for column, values in zip(out, ([h1] * len(found), [h2] * len(found), [i for _, i in found], [-s for s, _ in found])):
                    column += values
        return pd.DataFrame(dict(zip(("h1", "h2", "found", "score"), out))).astype({"h1": "int64", "h2": "int64", "found": "int64", "score": "float64"})

    found = left.groupBy("b", "a").cogroup(right.groupBy("b", "a")).applyInPandas(best, "h1 long, h2 long, found long, score double")
    order = Window.partitionBy("h1", "h2").orderBy(F.desc("score"), "found")
    single = found.groupBy("h1", "h2", "found").agg(F.max("score").alias("score"))
    top = single.withColumn("i", F.row_number().over(order)).where(F.col("i") <= k + 1).select("h1", "h2", "found", "score")
    ask = rows.where("q").select("h1", "h2", F.col("vec_id").alias("query_id")).distinct()
    pairs = ask.join(top, ["h1", "h2"]).where("query_id != found").groupBy("query_id", "found").agg(F.max("score").alias("score"))
    mine = Window.partitionBy("query_id").orderBy(F.desc("score"), "found")
    ranked = pairs.withColumn("rank", F.row_number().over(mine)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), F.col("found").alias("vec_id"), "score")
