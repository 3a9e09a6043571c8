"""Merkle trees over the rows of a table, with every row's proof, by butterfly exchange.

Leaves of a group are numbered in order and cut into aligned blocks of ``fanout ** block_levels`` leaves.  A task hashes a block up to the block's root and
keeps the siblings of each leaf.  The blocks of a group then swap roots round by round: in round r a block meets the blocks whose number differs in
the r-th digit (base ``fanout``) only, all of them hash the parent, and go on with it.  So after the last round each block has the group's root and all
upper siblings, and nothing is handed down again.  Where the last partner is cut short and has no block with the wanted lower digits, the
blocks that it has stand in for them in turn.

Groups are hashed alike: their roots are the leaves of one more tree, whose proofs join the blocks, never the rows.  No group is ever in one task: a group
with a third of all rows is many blocks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from burstframe.operators.reuse import keep
from burstframe.operators.series import with_position

FANOUT, BLOCK_LEVELS = 3, 7


def leaf_hash(*values: Column) -> Column:
    """sha256 (hex) of the values, each ``-`` if null, else its UTF-8 length, a colon and the value."""
    texts = [v.cast("string") for v in values]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]), 256)


def fold(leaf: Column, lefts: Column, rights: Column) -> Column:
    """Root that follows from a leaf and the siblings before and after it, level by level."""
    levels = F.arrays_zip(lefts.alias("l"), rights.alias("r"))
    return F.aggregate(levels, leaf, lambda node, x: F.sha2(F.concat(x["l"], node, x["r"]), 256))


def proof_hash(lefts: Column, rights: Column) -> Column:
    """sha256 (hex) of all siblings, level by level, left to right."""
    return F.sha2(F.array_join(F.zip_with(lefts, rights, lambda x, y: F.concat(x, y)), ""), 256)


def _hash(nodes: Sequence[str]) -> str:
    return hashlib.sha256("".join(nodes).encode()).hexdigest()


def levels_of(n: int, fanout: int) -> int:
    """Levels of hashing until one of n nodes is left."""
    out = 0
    while n > 1:
        n, out = -(-n // fanout), out + 1
    return out


def block_proofs(leaves: list[str], levels: int, fanout: int) -> tuple[str, list[list[tuple[str, str]]]]:
    """Root of one block and, per level, the siblings before and after each node."""
    sides, nodes = [], leaves
    for _ in range(levels):
        runs = [nodes[i : i + fanout] for i in range(0, len(nodes), fanout)]
        sides.append([("".join(run[:i]), "".join(run[i + 1 :])) for run in runs for i in range(len(run))])
        nodes = [_hash(run) for run in runs]
    return nodes[0], sides


def _in_blocks(rows: DataFrame, fanout: int, block_levels: int) -> DataFrame:
    """Rows with ``_top`` (root of their block) and their siblings inside it (``_lefts``, ``_rights``)."""
    from pyspark.sql.types import ArrayType, StringType, StructType

    schema = StructType(list(rows.schema.fields)).add("_top", StringType()).add("_lefts", ArrayType(StringType())).add("_rights", ArrayType(StringType()))
    g, b, leaf, n = (rows.columns.index(c) for c in ("_group", "_block", "_leaf", "_n"))
    sorted_rows = rows.repartition("_group", "_block").sortWithinPartitions("_group", "_block", "_pos")

    def finished(block: pa.RecordBatch) -> pa.RecordBatch:
        hashes = block.column(leaf).to_pylist()
        top, sides = block_proofs(hashes, min(block_levels, levels_of(block.column(n)[0].as_py(), fanout)), fanout)
        width = len(hashes)
        pairs = [side[i // fanout**level] for i in range(width) for level, side in enumerate(sides)]
        ends = pa.array(range(0, width * len(sides) + 1, len(sides)) if sides else [0] * (width + 1), pa.int32())
        both = [pa.ListArray.from_arrays(ends, pa.array([p[k] for p in pairs], pa.string())) for k in (0, 1)]
        return pa.RecordBatch.from_arrays([*block.columns, pa.array([top] * width), *both], names=[*block.schema.names, "_top", "_lefts", "_rights"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, key = [], None
        for batch in batches:
            keys = list(zip(batch.column(g).to_pylist(), batch.column(b).to_pylist()))
            start = 0
            for i, k in enumerate(keys):
                if k != key:
                    if i > start:
                        held.append(batch.slice(start, i - start))
                    if held:
                        yield finished(pa.Table.from_batches(held).combine_chunks().to_batches()[0])
                    held, key, start = [], k, i
            if len(keys) > start:
                held.append(batch.slice(start))
        if held:
            yield finished(pa.Table.from_batches(held).combine_chunks().to_batches()[0])

    return sorted_rows.mapInArrow(run, schema)


def _exchange(blocks: DataFrame, reach: int, fanout: int) -> DataFrame:
    """One round: blocks ``reach`` apart swap the nodes they hold and hash the parent.

    ``blocks`` are (_group, _block, _m blocks of the group, _node, _lefts, _rights); groups of up to ``reach`` blocks have their root already.
    """
    place, digit = F.floor(F.col("_block") / reach), F.floor(F.col("_block") / reach) % fanout
    low, short = F.col("_block") % reach, F.col("_m") - place * reach
    goes = F.when((F.col("_m") > reach) & (digit > 0) & (short < reach), F.sequence(low, F.lit(reach - 1).cast("long"), short)).otherwise(F.array(low))
    sent = blocks.withColumns({"_d": digit, "_g": F.floor(F.col("_block") / (reach * fanout)), "_low": low, "_to": F.explode(goes)})
    met = F.sort_array(F.collect_list(F.struct("_d", "_node")).over(Window.partitionBy("_group", "_g", "_to")))
    rows = sent.withColumn("_met", met).where("_low = _to")

    def side(test) -> Column:
        return F.array_join(F.transform(F.filter("_met", lambda x: test(x["_d"])), lambda x: x["_node"]), "")

    going = F.col("_m") > reach
    return rows.select(
        "_group", "_block", "_m", F.when(going, F.sha2(side(lambda d: d >= 0), 256)).otherwise(F.col("_node")).alias("_node"),
        *[F.when(going, F.concat(c, F.array(side(test)))).otherwise(F.col(c)).alias(c) for c, test in (("_lefts", lambda d: d < F.col("_d")), ("_rights", lambda d: d > F.col("_d")))])


def butterfly(blocks: DataFrame, most: int, fanout: int = FANOUT) -> DataFrame:
    """All rounds for groups of up to ``most`` blocks: every block ends with its group's root and its siblings up to it."""
    reach = 1
    while reach < most:
        blocks = _exchange(blocks, reach, fanout)
        reach *= fanout
    return blocks


def forest(leaves: DataFrame, order: Sequence[str], fanout: int = FANOUT, block_levels: int = BLOCK_LEVELS) -> tuple[DataFrame, DataFrame]:
    """Trees of the rows (_group, _leaf, order columns, others): rows with their siblings inside their block, and blocks with their upper siblings.

    Rows get _block, _lefts, _rights; blocks are (_group, _block, _node: the group's root, _lefts, _rights).  No column is null but order columns.
    """
    rows = with_position(leaves, ["_group"], order, "_pos", "_n")
    rows = rows.withColumn("_block", F.floor(F.col("_pos") / fanout**block_levels))
    rows = keep(_in_blocks(rows, fanout, block_levels))
    m = F.ceil(F.col("_n") / fanout**block_levels)
    none = F.array().cast("array<string>")
    firsts = rows.where(F.col("_pos") % fanout**block_levels == 0)
    firsts = firsts.select("_group", "_block", m.alias("_m"), F.col("_top").alias("_node"), none.alias("_lefts"), none.alias("_rights"))
    most = firsts.agg(F.max("_m")).first()[0] or 1
    if most > 1:
        firsts = butterfly(firsts.where("_m > 1"), most, fanout).unionByName(firsts.where("_m = 1"))
    return rows, firsts.drop("_m")


def manifest(docs: DataFrame, leaf: Column, group: str = "source", order: str = "doc_id", carry: Sequence[Column] = (), fanout: int = FANOUT,
             block_levels: int = BLOCK_LEVELS) -> DataFrame:
    """(order column, carried columns, leaf, subroot, root, lefts, rights) of every row.

    ``leaf`` is the hash of a row.  The rows of a group ascend by the order column (null first, equal ones by their hash; repeated rows are leaves of
    their own), groups by their UTF-8 bytes (null first, a group like any other).  While a tree has several nodes, every ``fanout`` neighbours become the
    hash of their hex digests, the last run also with fewer.  ``lefts`` and ``rights`` are the siblings before and after the row's node per level, up to the
    root over all groups.  A table of one row has its leaf as root and no siblings; an empty table gives an empty result.
    """
    named = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit(""))  # null before all others, also before the empty text
    carried = [c.alias(f"_c{i}") for i, c in enumerate(carry)]
    names = [docs.select(c).columns[0] for c in carry]
    leaves = keep(docs.select(F.col(order).alias("_order"), named.alias("_group"), leaf.alias("_leaf"), *carried))
    rows, blocks = forest(leaves, ["_order", "_leaf"], fanout, block_levels)
    blocks = keep(blocks)
    roots = blocks.where("_block = 0").select(F.lit("").alias("_group"), F.col("_node").alias("_leaf"), F.col("_group").alias("_source"))
    sources, tops = forest(roots, ["_source"], fanout, block_levels)
    sources = sources.join(tops.withColumnsRenamed({"_lefts": "_l", "_rights": "_r"}), ["_group", "_block"]).select(
        F.col("_source").alias("_group"), F.col("_node").alias("_root"), F.concat("_lefts", "_l").alias("_l2"), F.concat("_rights", "_r").alias("_r2"))
    upper = blocks.withColumnsRenamed({"_lefts": "_l1", "_rights": "_r1"}).join(sources, "_group")
    out = rows.join(upper, ["_group", "_block"])
    return out.select(F.col("_order").alias(order), *[F.col(f"_c{i}").alias(n) for i, n in enumerate(names)], F.col("_leaf").alias("leaf"),
                      F.col("_node").alias("subroot"), F.col("_root").alias("root"), F.concat("_lefts", "_l1", "_l2").alias("lefts"),
                      F.concat("_rights", "_r1", "_r2").alias("rights"))
