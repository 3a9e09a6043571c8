"""Mixing sources to target weights by Pareto order sampling.

Targets are words per source.  A document's expected number of copies follows from its source's target (and an optional weight);
its whole part is allocated for certain, and the fraction p is the inclusion probability of one more copy.  Documents
are ranked by their random odds over their inclusion odds, (u / (1 - u)) / (p / (1 - p)), and taken in this order until the
source has its words.  The cut is found by three sums of ever finer rank cells, so no task and no window holds the documents
of a source; one more document, the one whose size comes nearest to the words still missing, closes the sample.

Draws are the first 52 bits of the md5 of seed and document id: reruns, retries and other engines draw the same.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from burstframe.llm.common import WORD
from burstframe.operators.reuse import keep

#: Cells per level of the search for the cut.
CELLS = 4096


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def draw(key: Column, seed: str) -> Column:
    """Uniform number in (0, 1) from an id."""
    digits = F.substring(F.md5(F.concat(F.lit(seed + "|"), F.coalesce(key.cast("string"), F.lit("")))), 1, 13)
    return (F.conv(digits, 16, 10).cast("double") + F.lit(0.5)) / F.lit(float(1 << 52))


def targets(sizes: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """From (source, size) per source: target words; sources in code point order, null last, take the weights in turn.

    Together they get ``share`` times all sizes; a target stops at ``cap`` times its source's size and the excess goes to the others
    by weight.  Sources are sorted by cap over weight: the level at which the rest share is the first one that clamps no more
    source.  The window is over the distinct sources, one row each.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    every = Window.partitionBy()
    at = F.pmod(F.row_number().over(order) - 1, F.lit(len(weights)))
    out = sizes.select("source", "size", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (at + 1).cast("int")).alias("w"),
                       F.row_number().over(order).alias("sid"))
    out = out.withColumns({"cap": F.col("size") * F.lit(float(cap)), "all": F.sum("size").over(every) * F.lit(float(share))})
    out = out.withColumn("full", F.col("cap") / F.col("w"))
    rank = Window.orderBy("full", "sid")
    before = rank.rowsBetween(Window.unboundedPreceding, -1)
    out = out.withColumns({"k": F.row_number().over(rank),
                           "level": (F.col("all") - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
                           / (F.sum("w").over(every) - F.coalesce(F.sum("w").over(before), F.lit(0.0)))})
    out = out.withColumn("at", F.min(F.when(F.col("level") <= F.col("full"), F.struct("k", "level"))).over(every)["level"])
    return out.select("sid", "source", F.col("size").alias("source_size"), F.least("cap", F.coalesce(F.col("at") * F.col("w"), F.col("cap"))).alias("target"))


def _boundary(cells: DataFrame, cell: str) -> DataFrame:
    """Per source the first cell whose running sum passes the words still wanted, and the words before it."""
    run = Window.partitionBy("sid").orderBy(cell)
    sums = cells.withColumn("upto", F.sum("size").over(run))
    first = sums.where(F.col("base") + F.col("upto") > F.col("rest")).groupBy("sid").agg(F.min(F.struct(cell, "upto", "size", "base", "rest")).alias("m"))
    return first.select("sid", F.col(f"m.{cell}").alias(cell), (F.col("m.base") + F.col("m.upto") - F.col("m.size")).alias("base"), F.col("m.rest").alias("rest"))


def cuts(draws: DataFrame, rest: DataFrame) -> DataFrame:
    """Per source the rank below which (``edge``) or up to which (``cut``) documents are taken, and the closing rank ``last``.

    ``draws``: sid, v (rank in (0, 1)), size, one row per distinct rank; ``rest``: sid, rest (words wanted).
    """
    fine = draws.withColumns({"c1": F.floor(F.col("v") * CELLS), "c2": F.floor(F.col("v") * CELLS * CELLS)})
    wanted = rest.withColumn("base", F.lit(0.0))
    one = _boundary(fine.groupBy("sid", "c1").agg(F.sum("size").alias("size")).join(wanted, "sid"), "c1")
    in_one = fine.join(one, ["sid", "c1"])
    two = _boundary(in_one.groupBy("sid", "c2").agg(F.sum("size").alias("size"), F.first("base").alias("base"), F.first("rest").alias("rest")), "c2")
    run = Window.partitionBy("sid").orderBy("v")
    rows = fine.join(two, ["sid", "c2"]).withColumn("upto", F.col("base") + F.sum("size").over(run))
    found = rows.groupBy("sid").agg(F.max(F.when(F.col("upto") <= F.col("rest"), F.struct("v", "upto"))).alias("m"), F.first("base").alias("base"),
                                    F.first("rest").alias("rest"), F.first("c2").alias("c2"))
    found = keep(found.select("sid", (F.col("c2") / F.lit(float(CELLS * CELLS))).alias("edge"), F.coalesce("m.v", F.lit(-1.0)).alias("cut"),
                              (F.col("rest") - F.coalesce("m.upto", "base")).alias("missing")))
    left = draws.join(found, "sid").where((F.col("v") >= F.col("edge")) & (F.col("v") > F.col("cut")) & (F.col("size") > 0))
    off = F.abs(F.col("size") - F.col("missing"))
    close = left.where(off < F.col("missing")).groupBy("sid").agg(F.min(F.struct(off.alias("off"), F.col("v").alias("v")))["v"].alias("last"))
    return found.join(close, "sid", "left").select("sid", "edge", "cut", F.coalesce("last", F.lit(-1.0)).alias("last"))


def _scale(rows: DataFrame, goal: DataFrame, cap: float) -> DataFrame:
    """Per source the factor that turns weights into expected copies, at most ``cap`` each, with the target as their sum of words.

    Each pass is one sum per source; copies that reach the cap leave the scale until none does any more.
    """
    level = keep(goal.withColumn("top", F.lit(float("inf"))))
    while True:
        joined = rows.join(level, "sid")
        sums = joined.groupBy("sid").agg(F.sum(F.when(F.col("w") < F.col("top"), F.col("size") * F.col("w"))).alias("free"),
                                         F.sum(F.when(F.col("w") >= F.col("top"), F.col("size") * F.lit(cap))).alias("fixed"),
                                         F.first("target").alias("target"), F.first("top").alias("old"))
        scale = F.when(F.col("free") > 0, F.greatest(F.lit(0.0), F.col("target") - F.coalesce("fixed", F.lit(0.0))) / F.col("free")).otherwise(0.0)
        new = keep(sums.withColumn("scale", scale).select("sid", "target", "scale", "old", F.least("old", F.when(F.col("scale") > 0, F.lit(cap) / F.col("scale"))
                                                                                                .otherwise(F.col("old"))).alias("top")))
        if new.where("top < old").isEmpty():
            return new.select("sid", "scale", "top")
        level = new.select("sid", "target", "top")


def mix(docs: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, cap: float = 2.0, seed: str = "mix", doc_id: str = "doc_id",
        text: str = "text", source: str = "source", weight: str | None = None) -> DataFrame:
    """Documents with ``size``, ``source_size``, ``target`` and ``copies`` (how often the mix takes the document; 0: not at all).

    Sizes are words; null text has none.  Null sources are one source, the last.  ``weight`` names a column of relative
    expected copies within a source (null or negative: 0); by default all documents of a source are alike.  Rows that share an id share their
    draw and are taken or left together.  An empty table gives an empty result; input columns with the names of results are replaced.
    """
    made = ("size", "source_size", "target", "copies")
    rows = docs.select(F.struct(*[c for c in docs.columns if c not in made]).alias("r"), F.col(source).alias("source"), word_count(F.col(text)).alias("size"),
                       draw(F.col(doc_id), seed).alias("u"),
                       (F.greatest(F.coalesce(F.col(weight).cast("double"), F.lit(0.0)), F.lit(0.0)) if weight else F.lit(1.0)).alias("w"))
    small = keep(rows.select("source", "size", "u", "w"))
    goal = keep(targets(small.groupBy("source").agg(F.sum("size").alias("size")), weights, share, cap))
    plan = goal
    if weight:
        slim = small.join(goal, small["source"].eqNullSafe(goal["source"])).select("sid", "size", "w")
        plan = goal.join(_scale(slim, goal.select("sid", "target"), cap), "sid", "left")
        copies = F.least(F.lit(cap), F.when(F.col("w") >= F.col("top"), F.lit(cap)).otherwise(F.coalesce(F.col("scale") * F.col("w"), F.lit(0.0))))
    else:
        copies = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))

    def ranked(frame: DataFrame) -> DataFrame:
        out = frame.withColumn("c", copies).withColumn("whole", F.floor("c")).withColumn("p", F.col("c") - F.col("whole"))
        odds = F.col("u") / (F.lit(1.0) - F.col("u")) * (F.lit(1.0) - F.col("p")) / F.col("p")
        return out.withColumn("v", F.when(F.col("p") > 0, odds / (F.lit(1.0) + odds)))

    p = plan.withColumnRenamed("source", "goal_source")
    scored = ranked(small.join(p, F.col("source").eqNullSafe(F.col("goal_source"))))
    rest = keep(scored.groupBy("sid").agg((F.first("target") - F.sum(F.col("whole") * F.col("size"))).alias("rest")))
    draws = keep(scored.where("v IS NOT NULL AND size > 0").groupBy("sid", "v").agg(F.sum("size").alias("size")))
    limit = cuts(draws, rest)
    p = keep(p.join(limit, "sid", "left"))
    out = ranked(rows.join(p, F.col("source").eqNullSafe(F.col("goal_source"))))
    more = F.col("v").isNotNull() & ((F.col("v") < F.coalesce("edge", F.lit(2.0))) | (F.col("v") <= F.col("cut")) | (F.col("v") == F.col("last")))
    return out.select("r.*", "size", "source_size", "target", (F.col("whole") + F.coalesce(more, F.lit(False)).cast("int")).cast("int").alias("copies"))
