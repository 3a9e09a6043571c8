"""Merkle manifests against a plain recursive version."""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict

import pytest
from llm_data import SCHEMA
from pyspark.sql import functions as F


def _h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def _leaf(row, text):
    values = [row["doc_id"], row["source"], row["lang"], row["n_chars"], text]
    return _h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def _tree(nodes, fanout):
    """Root and, per leaf, its list of (siblings before, siblings after)."""
    steps, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        runs = [nodes[i : i + fanout] for i in range(0, len(nodes), fanout)]
        for k, i in enumerate(at):
            run = runs[i // fanout]
            steps[k].append(("".join(run[: i % fanout]), "".join(run[i % fanout + 1 :])))
        nodes, at = [_h("".join(r)) for r in runs], [i // fanout for i in at]
    return nodes[0], steps


def _brute(rows, fanout=3):
    groups = defaultdict(list)
    for r in rows:
        groups[r["source"]].append((r["doc_id"] is not None, r["doc_id"] or 0, _leaf(r, r["text"]), r))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in names:
        groups[s].sort(key=lambda x: x[:3])
        trees[s] = _tree([x[2] for x in groups[s]], fanout)
    root, upper = _tree([trees[s][0] for s in names], fanout)
    out = []
    for s, above in zip(names, upper):
        for (_, _, leaf, r), steps in zip(groups[s], trees[s][1]):
            steps = [*steps, *above]
            even = zlib.crc32(str("" if r["doc_id"] is None else r["doc_id"]).encode()) % 2 == 0
            node = _leaf(r, r["text"].replace("\n", "")) if even and r["text"] is not None else leaf
            for a, b in steps:
                node = _h(a + node + b)
            out.append((r["doc_id"], leaf, trees[s][0], root, _h("".join(a + b for a, b in steps)), node, node == root))
    return sorted(out, key=str)


def _got(docs, **kw):
    from burstframe.llm.common import crc_of_id
    from burstframe.llm.merkle import fold, leaf_hash, manifest, proof_hash

    def leaf(text):
        return leaf_hash(F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), text)

    cut = F.when(F.pmod(crc_of_id(), F.lit(2)) == 0, leaf(F.replace("text", F.lit("\n"), F.lit(""))))
    rows = manifest(docs, leaf(F.col("text")), carry=[cut.alias("cut")], **kw)
    rows = rows.select("doc_id", "leaf", "subroot", "root", proof_hash(F.col("lefts"), F.col("rights")).alias("p"),
                       fold(F.coalesce("cut", "leaf"), F.col("lefts"), F.col("rights")).alias("f"))
    return sorted(((*r, r["f"] == r["root"]) for r in rows.collect()), key=str)


@pytest.mark.parametrize("block_levels", [0, 1, 2, 7])
def test_manifest(docs, block_levels):
    """Blocks of one to 2,187 leaves give the same trees."""
    rows = docs.collect()
    assert _got(docs, block_levels=block_levels) == _brute(rows)


@pytest.mark.parametrize("fanout", [2, 5])
def test_fanouts(docs, fanout):
    got = _got(docs, fanout=fanout, block_levels=1)
    assert [r[:5] for r in got] == [r[:5] for r in _brute(docs.collect(), fanout)]


@pytest.mark.parametrize("n", [1, 2, 3, 4, 9, 10, 28, 83])
def test_ragged_groups(spark, n):
    """One hot group beside groups of one row, for sizes about the powers of the fanout."""
    rows = [(i, f"t{i}\nx", "xx", "hot", 3, 1, "", "") for i in range(n)] + [(-1, None, None, None, None, None, None, None), (5, "", "", "", 0, 1, "", "")]
    docs = spark.createDataFrame(rows, SCHEMA)
    assert _got(docs, block_levels=0) == _brute(docs.collect())


def test_small_tables(spark, empty):
    assert _got(empty) == []
    one = spark.createDataFrame([(1, "a\nb", "xx", "s", 3, 1, "", "")], SCHEMA)
    assert _got(one) == _brute(one.collect())


def test_order_of_groups(spark):
    """Null, empty, and UTF-8 bytes; not UTF-16."""
    names = [None, "", "-", "=", "a", "Z", "é", "￿", "😀", "aa"]
    docs = spark.createDataFrame([(i, "t", "xx", s, 1, 1, "", "") for i, s in enumerate(names)], SCHEMA)
    assert _got(docs) == _brute(docs.collect())
