"""Connected components of link tables by alternating large and small stars, as joins and minima over written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from burstframe.operators.reuse import drop, keep


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0)).alias("h")).first()
    return row["n"], row["h"]


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (a, b): root is the smallest node that can be reached.

    Each round links what lies above a node, then what lies below it, to the smallest neighbour.  Minima are combined before the shuffle and
    joins are split by AQE where a node has very many neighbours; the number of rounds grows with the log of the longest path.
    The result is a kept table; the links of a round are deleted when those of the next are written.
    """
    edges = keep(links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    state = _state(edges)
    while state[0]:
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.col("b").alias("a"), "m").where("a != m").unionAll(low.select("a", "m"))
        before, edges = edges, keep(small.select("a", F.col("m").alias("b")).distinct())
        drop(before)
        new = _state(edges)
        if new == state:
            break
        state = new
    out = keep(edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(edges.select("b", "b").distinct()))
    drop(edges)
    return out
