"""Ordered operations over long series, without one task per series.

A window over a whole series puts that series in one task.  A single burst may
hold a third of all rows, so ordered operators here work on *chunks*:

* ``running_sums``  - local prefix sums per chunk plus the prefix of chunk totals;
* ``sliding``       - fixed offset frames; each chunk receives a halo of border rows;
* ``with_position`` - row numbers per series: even ranges of the whole order are numbered
  locally and shifted by the prefix of the range counts.

``pos`` is always a 0-based position that is unique inside a series.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from burstframe.operators.reuse import keep

CHUNK = 4096
_CHUNK_COL = "_chunk"


def attach(df: DataFrame, per_key: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join a one-row-per-key frame back to the rows.

    No broadcast hint: Spark broadcasts it when its measured size is under the
    threshold, otherwise AQE splits the skewed side of the shuffled join.  Without keys
    ``per_key`` is the single row of a global aggregate.
    """
    if not keys:
        return df.join(F.broadcast(per_key), how="cross")
    return df.join(per_key, list(keys), how)


def with_chunk(df: DataFrame, pos: str, size: int = CHUNK) -> DataFrame:
    return df.withColumn(_CHUNK_COL, F.floor(F.col(pos) / F.lit(size)).cast("long"))


def running_sums(
    df: DataFrame,
    keys: Sequence[str],
    pos: str,
    sums: dict[str, Column],
    size: int = CHUNK,
) -> DataFrame:
    """Add inclusive running sums ``sums[name]`` ordered by ``pos`` within each series."""
    group = [*keys, _CHUNK_COL]
    chunked = with_chunk(df, pos, size)
    totals = chunked.groupBy(*group).agg(*[F.sum(e).alias(f"_t_{n}") for n, e in sums.items()])
    before = Window.partitionBy(*keys).orderBy(_CHUNK_COL).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *group,
        *[F.coalesce(F.sum(f"_t_{n}").over(before), F.lit(0)).alias(f"_o_{n}") for n in sums],
    )
    local = Window.partitionBy(*group).orderBy(pos).rowsBetween(Window.unboundedPreceding, 0)
    rows = chunked.select("*", *[F.sum(e).over(local).alias(f"_l_{n}") for n, e in sums.items()])
    joined = rows.join(offsets, group)
    for n in sums:
        joined = joined.withColumn(n, F.col(f"_l_{n}") + F.col(f"_o_{n}"))
    return joined.drop(_CHUNK_COL, *[f"_l_{n}" for n in sums], *[f"_o_{n}" for n in sums])


def sliding(
    df: DataFrame,
    keys: Sequence[str],
    pos: str,
    reach: int,
    build: Callable[[Window], dict[str, Column]],
    size: int = CHUNK,
) -> DataFrame:
    """Add columns computed from at most ``reach`` neighbours on either side.

    ``build`` gets the ordered window spec and returns ``{name: column}``; positions must
    be contiguous.  Border rows are copied to the neighbouring chunk, so one shuffle is enough.
    """
    if reach > size:
        size = reach
    own = F.floor(F.col(pos) / F.lit(size)).cast("long")
    inside = F.col(pos) - own * F.lit(size)
    targets = F.array_compact(
        F.array(
            own,
            F.when((inside < reach) & (own > 0), own - 1),
            F.when(inside >= size - reach, own + 1),
        )
    )
    spread = df.select("*", own.alias("_own"), F.explode(targets).alias(_CHUNK_COL))
    spec = Window.partitionBy(*keys, _CHUNK_COL).orderBy(pos)
    built = spread.select("*", *[c.alias(n) for n, c in build(spec).items()])
    return built.filter(F.col("_own") == F.col(_CHUNK_COL)).drop("_own", _CHUNK_COL)


def ranged(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Kept rows, cut into even ranges of (keys, order); ``_part`` is the number of the range, ``_tie`` tells equal rows apart.

    The cuts are quantiles of the whole order with a unique last column, so neither ties nor clustered values pile up in one range.
    """
    rows = df.withColumn("_tie", F.monotonically_increasing_id())
    return keep(rows.repartitionByRange(*keys, *order, "_tie").withColumn("_part", F.spark_partition_id()))


def _before_part(parts: DataFrame, keys: Sequence[str], size: Column) -> DataFrame:
    """Per (keys, range) the total of the earlier ranges of the key (``_off``) and of all (``_all``); a key has at most one row per range."""
    totals = parts.groupBy(*keys, "_part").agg(size.alias("_cn"))
    order = Window.partitionBy(*keys).orderBy("_part")
    return totals.select(*keys, "_part", F.coalesce(F.sum("_cn").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"),
                         F.sum("_cn").over(Window.partitionBy(*keys)).alias("_all"))


def with_position(df: DataFrame, keys: Sequence[str], order: Sequence[str], pos: str = "pos", size: str | None = None) -> DataFrame:
    """0-based row number in each series ordered by ``order``; ``size`` names an optional column for the row count of the series."""
    rows = ranged(df, keys, order)
    offsets = _before_part(rows, keys, F.count(F.lit(1)))
    local = Window.partitionBy(*keys, "_part").orderBy(*order, "_tie")
    out = rows.withColumn("_rn", F.row_number().over(local) - 1).join(offsets, [*keys, "_part"]).withColumn(pos, (F.col("_rn") + F.col("_off")).cast("long"))
    if size:
        out = out.withColumn(size, F.col("_all"))
    return out.drop("_rn", "_off", "_all", "_part", "_tie")


def asof_merge(source: DataFrame, target: DataFrame, keys: Sequence[str], t: str, payload: Sequence[str]) -> DataFrame:
    """Rows of ``target`` with ``_left``, the last source row of the series at or before ``t``, and ``_right``, the first one after it (structs of t and payload).

    Source and target rows are sorted together and cut into even ranges, whatever the spacing of the times; inside a range the neighbours are carried along the
    order, and the last and first source row of each range are carried over the ranges without one.  Target rows stay one each: of source rows at the same time the
    last in the order counts.  Source rows without a time are left out; keys are not null.
    """
    keys = list(keys)
    one = F.struct(F.col(t).alias(t), *payload)
    side = source.where(F.col(t).isNotNull()).select(*keys, F.col(t).alias("_at"), F.lit(0).alias("_kind"), one.alias("_s"))
    goal = target.select(*keys, F.col(t).cast(source.schema[t].dataType).alias("_at"), F.lit(1).alias("_kind"), F.struct(*target.columns).alias("_g"))
    rows = ranged(side.unionByName(goal, allowMissingColumns=True), keys, ["_at", "_kind"])
    order = ["_at", "_kind", "_tie"]
    back = [F.desc(c) for c in order]
    ends = rows.where("_kind = 0").groupBy(*keys, "_part").agg(F.max_by("_s", F.struct(*order)).alias("_last"), F.min_by("_s", F.struct(*order)).alias("_first"))
    ends = rows.select(*keys, "_part").distinct().join(ends, [*keys, "_part"], "left")
    near = Window.partitionBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.select(*keys, "_part", F.last("_last", ignorenulls=True).over(near.orderBy("_part")).alias("_before"),
                       F.last("_first", ignorenulls=True).over(near.orderBy(F.desc("_part"))).alias("_after"))
    local = Window.partitionBy(*keys, "_part").rowsBetween(Window.unboundedPreceding, 0)
    found = rows.select("*", F.last("_s", ignorenulls=True).over(local.orderBy(*order)).alias("_l"), F.last("_s", ignorenulls=True).over(local.orderBy(*back)).alias("_r"))
    out = found.where("_kind = 1").join(ends, [*keys, "_part"], "left")
    return out.select("_g.*", F.coalesce("_l", "_before").alias("_left"), F.coalesce("_r", "_after").alias("_right"))


def dense_grid(per_key: DataFrame, n: Column, idx: str = "bin_idx", size: int = CHUNK) -> DataFrame:
    """One row per (key, 0..n-1); produced chunk by chunk so no long array is built."""
    n = n.cast("long")
    chunks = per_key.withColumn("_gn", n).filter(F.col("_gn") > 0).withColumn(
        "_start", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_gn") - 1, F.lit(size).cast("long")))
    )
    last = F.least(F.col("_start") + F.lit(size - 1), F.col("_gn") - 1)
    return chunks.withColumn(idx, F.explode(F.sequence(F.col("_start"), last))).drop("_gn", "_start")


def first_max(value: str, order: str, *payload: str) -> Column:
    """Struct of ``payload`` at the first maximum of ``value`` (numpy argmax rule)."""
    return F.max_by(F.struct(*payload), F.struct(F.col(value), -F.col(order)))


def median_by_position(df: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """Exact median per key from running counts of its distinct values, which are combined before the shuffle."""
    counts = ranged(df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_k")), keys, [value])
    offsets = _before_part(counts, keys, F.sum("_k"))
    local = Window.partitionBy(*keys, "_part").orderBy(value, "_tie").rowsBetween(Window.unboundedPreceding, 0)
    rows = counts.withColumn("_to", F.sum("_k").over(local)).join(offsets, [*keys, "_part"]).withColumn("_to", F.col("_to") + F.col("_off"))

    def at(i: Column) -> Column:
        return F.max(F.when((F.col("_to") - F.col("_k") <= i) & (i < F.col("_to")), F.col(value)))

    two = rows.groupBy(*keys).agg(at(F.floor((F.col("_all") - 1) / 2)).alias("_a"), at(F.floor(F.col("_all") / 2)).alias("_b"))
    return two.select(*keys, ((F.col("_a") + F.col("_b")) / 2).alias(name))
