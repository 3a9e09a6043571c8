"""Reversible line dedup: sharded cuckoo filters in front of exact reference counts.

The state is two tables: ``counts`` holds, per line key, in how many documents it stands (exact, by a 128-bit digest), and ``filters``
one cuckoo filter per shard with the keys whose count has reached the threshold.  Inserting documents adds to the counts and
puts the keys that cross the threshold into their shard's filter; deleting documents subtracts and takes them out again, which a
cuckoo filter allows and a Bloom filter does not.  To drop lines, the filter of a shard screens the line keys that are
dealt to it, and what passes is joined with the exact counts.

Keys are counted per batch before they are shuffled; the probe deals each shard over salted copies, so one line
that stands in a third of all documents does not land in one task.  Shards hold about ``SHARD_KEYS`` keys: their number follows the table.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from burstframe.llm.common import WHITE, arrow_map, as_bytes, mix64, text_key
from burstframe.operators.reuse import keep

SHARD_KEYS = 200_000
SALTS = 16
COPIES = 4
STRIP = WHITE.encode()


def line_keys(text: bytes) -> list[bytes]:
    """Key of each line: A-Z lower-cased (bytes.lower touches nothing else), white space stripped at both ends."""
    return [line.strip(STRIP) for line in text.lower().split(b"\n")]


def _long_enough(key: bytes, least: int) -> bool:
    return len(key) >= least and (least <= 1 or len(key.decode("utf-8", "replace")) >= least)


def _digests(keys: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(xxhash.xxh3_128_digest(k) for k in keys), "<i8").reshape(-1, 2)


class Cuckoo:
    """Cuckoo filter of 64-bit hashes: four slots per bucket, 16-bit fingerprints, the second bucket from bucket and fingerprint.

    Deleting a hash that was inserted is exact; a lookup may err towards yes.  What finds no place after many kicks goes to a stash.
    """

    KICKS = 500

    def __init__(self, capacity: int):
        self.mask = (1 << max(1, int(np.ceil(np.log2(max(1, capacity) / 3.2))))) - 1
        self.slots = np.zeros((self.mask + 1, 4), np.uint16)
        self.stash: list[tuple[int, int]] = []

    def _places(self, hashes: np.ndarray):
        h = mix64(hashes.astype(np.uint64))
        prints = np.maximum(h >> np.uint64(48), 1).astype(np.uint16)
        one = (h & np.uint64(self.mask)).astype(np.int64)
        return prints, one, self._other(one, prints)

    def _other(self, bucket, prints):
        return (np.asarray(bucket, np.int64) ^ (mix64(np.asarray(prints, np.uint64)) & np.uint64(self.mask)).astype(np.int64))

    def contains(self, hashes: np.ndarray) -> np.ndarray:
        prints, one, two = self._places(hashes)
        found = (self.slots[one] == prints[:, None]).any(1) | (self.slots[two] == prints[:, None]).any(1)
        for p, b in self.stash:
            found |= (prints == p) & ((one == b) | (two == b))
        return found

    def insert(self, hashes: np.ndarray) -> None:
        prints, one, two = self._places(hashes)
        left = np.arange(len(prints))
        for bucket in (one, two):
            for slot in range(4):  # one key per bucket and round, all buckets at once
                if not len(left):
                    return
                _, first = np.unique(bucket[left], return_index=True)
                mine = left[first]
                mine = mine[self.slots[bucket[mine], slot] == 0]
                self.slots[bucket[mine], slot] = prints[mine]
                left = np.setdiff1d(left, mine, assume_unique=True)
        rng = np.random.default_rng(len(hashes))
        for i in left:
            p, b = prints[i], int(one[i])
            for _ in range(self.KICKS):
                free = np.flatnonzero(self.slots[b] == 0)
                if len(free):
                    self.slots[b, free[0]] = p
                    break
                s = int(rng.integers(4))
                p, self.slots[b, s] = self.slots[b, s], p
                b = int(self._other(b, p))
            else:
                self.stash.append((int(p), b))

    def delete(self, hashes: np.ndarray) -> None:
        prints, one, two = self._places(hashes)
        for p, a, b in zip(prints, one, two):
            for bucket in (a, b):
                at = np.flatnonzero(self.slots[bucket] == p)
                if len(at):
                    self.slots[bucket, at[0]] = 0
                    break
            else:
                self.stash.remove(next(x for x in self.stash if x[0] == p and x[1] in (a, b)))

    @property
    def capacity(self) -> int:
        return int((self.mask + 1) * 4 * 0.85)

    def to_bytes(self) -> bytes:
        stash = np.array(self.stash, np.int64).reshape(-1, 2)
        return np.array([self.mask, len(stash)], np.int64).tobytes() + stash.tobytes() + self.slots.tobytes()

    @classmethod
    def from_bytes(cls, data: bytes) -> Cuckoo:
        out = cls.__new__(cls)
        out.mask, n = (int(x) for x in np.frombuffer(data, np.int64, 2))
        out.stash = [tuple(x) for x in np.frombuffer(data, np.int64, 2 * n, 16).reshape(-1, 2).tolist()]
        out.slots = np.frombuffer(data, np.uint16, offset=16 + 16 * n).reshape(-1, 4).copy()
        return out


FILTERS = "shard int, n long, capacity long, filter binary"


def _row(shard: int, n: int, cuckoo: Cuckoo) -> pd.DataFrame:
    return pd.DataFrame({"shard": [shard], "n": [n], "capacity": [cuckoo.capacity], "filter": [cuckoo.to_bytes()]})


class LineDedup:
    """State of the lines of a growing and shrinking set of documents.

    A document is a row; a line counts once per document.  Null and empty texts are one empty line, which is never a key of
    one or more code points.  ``counts`` and ``filters`` are written tables; ``insert`` and ``delete`` replace them.
    """

    def __init__(self, spark: SparkSession, threshold: int = 10, min_chars: int = 1, text: str = "text"):
        self.spark, self.threshold, self.min_chars, self.text = spark, threshold, min_chars, text
        self.counts = spark.createDataFrame([], "k1 long, k2 long, n long")
        self.filters = spark.createDataFrame([], FILTERS)
        self.shards = 0

    def _lines(self, docs: DataFrame) -> DataFrame:
        least = max(1, self.min_chars)

        def step(batch: pa.RecordBatch):
            seen: Counter = Counter()
            for text in as_bytes(batch.column(0)):
                seen.update(k for k in set(line_keys(text)) if _long_enough(k, least))
            if not seen:
                return None
            d = _digests(list(seen))
            return {"k1": d[:, 0], "k2": d[:, 1], "n": np.fromiter(seen.values(), np.int64, len(seen))}

        return arrow_map(docs.select(F.col(self.text).cast("string")), "k1 long, k2 long, n long", step).groupBy("k1", "k2").agg(F.sum("n").alias("n"))

    def insert(self, docs: DataFrame) -> LineDedup:
        return self._change(self._lines(docs))

    def delete(self, docs: DataFrame) -> LineDedup:
        """Take back documents that were inserted."""
        return self._change(self._lines(docs).withColumn("n", -F.col("n")))

    def _change(self, delta: DataFrame) -> LineDedup:
        if not self.shards:  # nothing counted before
            self.counts = keep(delta.where("n > 0"))
            return self._build()
        old = self.counts.select("k1", "k2", F.col("n").alias("was"), F.lit(0).cast("long").alias("d"))
        new = keep(old.unionAll(delta.select("k1", "k2", F.lit(0).cast("long"), "n")).groupBy("k1", "k2").agg(F.sum("was").alias("was"), F.sum("d").alias("d")))
        least = F.lit(self.threshold)
        now = F.col("was") + F.col("d")
        crossed = keep(new.where((F.col("was") < least) != (now < least)).select(self._shard(), F.col("k2").alias("h"), (now >= least).alias("come")))
        self.counts = keep(new.where(now > 0).select("k1", "k2", now.alias("n")))
        more = crossed.where("come").groupBy("shard").agg(F.count("*").alias("more"))
        if not more.join(self.filters, "shard", "left").where("coalesce(n + more > capacity, true)").isEmpty():
            return self._build()  # a shard would be too full, or is new

        def update(filters: pd.DataFrame, keys: pd.DataFrame) -> pd.DataFrame:
            if not len(filters):
                return filters.assign(shard=[], n=[], capacity=[], filter=[])
            f = filters.iloc[0]
            cuckoo = Cuckoo.from_bytes(f["filter"])
            come = keys["come"].to_numpy(bool)
            hashes = keys["h"].to_numpy(np.int64)
            cuckoo.delete(hashes[~come])
            cuckoo.insert(hashes[come])
            return _row(int(f["shard"]), int(f["n"]) + int(come.sum()) - int((~come).sum()), cuckoo)

        self.filters = keep(self.filters.groupBy("shard").cogroup(crossed.groupBy("shard")).applyInPandas(update, FILTERS))
        return self

    def _shard(self):
        return F.pmod(F.col("k1"), F.lit(max(1, self.shards))).cast("int").alias("shard")

    def _frequent(self) -> DataFrame:
        return self.counts.where(F.col("n") >= self.threshold)

    def _build(self) -> LineDedup:
        """All filters anew from the exact counts; the number of shards follows the number of keys."""
        self.shards = max(1, -(-self._frequent().count() // SHARD_KEYS))

        def build(key: tuple, keys: pd.DataFrame) -> pd.DataFrame:
            cuckoo = Cuckoo(2 * len(keys))  # room for as many again
            cuckoo.insert(keys["h"].to_numpy(np.int64))
            return _row(key[0], len(keys), cuckoo)

        self.filters = keep(self._frequent().select(self._shard(), F.col("k2").alias("h")).groupBy("shard").applyInPandas(build, FILTERS))
        return self

    def _possible(self, docs: DataFrame) -> DataFrame:
        """(t1, t2, k1, k2) of the lines that pass their shard's filter."""
        least, shards = max(1, self.min_chars), max(1, self.shards)
        kinds = "shard int, salt int, t1 long, t2 long, k1 long, k2 long, filter binary"

        def step(batch: pa.RecordBatch):
            t1, t2 = (batch.column(i).to_numpy() for i in (1, 2))
            keys, rows, seen = [], [], set()
            for i, text in enumerate(as_bytes(batch.column(0))):
                if (at := (int(t1[i]), int(t2[i]))) not in seen:  # copies have the same lines
                    seen.add(at)
                    mine = [k for k in set(line_keys(text)) if _long_enough(k, least)]
                    keys += mine
                    rows += [i] * len(mine)
            if not keys:
                return None
            d, rows = _digests(keys), np.array(rows)
            return {"shard": (d[:, 0] % shards).astype(np.int32), "salt": (t1[rows] % SALTS).astype(np.int32), "t1": t1[rows], "t2": t2[rows],
                    "k1": d[:, 0], "k2": d[:, 1], "filter": pa.nulls(len(keys), pa.binary())}

        lines = arrow_map(docs.select(F.col(self.text).cast("string"), *text_key(F.col(self.text).cast("string"))), kinds, step)
        no = F.lit(None).cast("long")
        filters = self.filters.select("shard", F.explode(F.array(*[F.lit(s) for s in range(SALTS)])).alias("salt"), no.alias("t1"), no.alias("t2"),
                                      no.alias("k1"), no.alias("k2"), "filter")

        def probe(batches):
            shard, cuckoo = None, None
            for batch in batches:
                of = batch.column("shard").to_numpy()
                at = 0
                while at < len(of):  # runs of one shard; a filter comes before its lines
                    end = at + int(np.searchsorted(of[at:], of[at], "right"))
                    run = batch.slice(at, end - at)
                    blob = run.column("filter").slice(0, 1)[0].as_py()
                    if blob is not None:
                        shard, cuckoo = of[at], Cuckoo.from_bytes(blob)
                        run = run.filter(run.column("filter").is_null())
                    if cuckoo is not None and shard == of[at] and run.num_rows:
                        hit = cuckoo.contains(run.column("k2").to_numpy())
                        yield run.filter(pa.array(hit)).select(["t1", "t2", "k1", "k2"])
                    at = end

        dealt = lines.unionAll(filters).repartition("shard", "salt").sortWithinPartitions("shard", F.col("filter").isNull())
        return dealt.mapInArrow(probe, "t1 long, t2 long, k1 long, k2 long")

    def apply(self, docs: DataFrame) -> DataFrame:
        """Documents with the lines of frequent keys taken out of the text, ``n_lines`` (before) and ``n_dropped``.

        Null text becomes the empty text of one line.  Copies of a text are treated once; input columns n_lines and n_dropped are replaced.
        """
        docs = docs.drop("n_lines", "n_dropped")
        drops = (self._possible(docs).join(self._frequent().select("k1", "k2"), ["k1", "k2"], "left_semi").distinct()
                 .groupBy("t1", "t2").agg(F.collect_list("k1").alias("a"), F.collect_list("k2").alias("b")))
        drops = drops.withColumn("salt", F.explode(F.array(*[F.lit(s) for s in range(COPIES)])))  # copies of one text go to several tasks
        t1, t2 = text_key(F.col(self.text).cast("string"))
        others = [F.col(c).cast("string") for c in docs.columns if c != self.text]
        salt = F.pmod(F.xxhash64(F.lit(0), *others), F.lit(COPIES)).cast("int").alias("salt")
        rows = docs.select(F.struct("*").alias("r"), t1, t2, salt).join(drops, ["t1", "t2", "salt"], "left")

        @F.pandas_udf("n_lines long, n_dropped long, kept string")
        def cut(text: pd.Series, a: pd.Series, b: pd.Series) -> pd.DataFrame:
            out = []
            for t, x, y in zip(text, a, b):
                raw = (t or "").encode()
                n = raw.count(b"\n") + 1
                if x is None:
                    out.append((n, 0, t or ""))
                    continue
                gone = set(zip(x.tolist(), y.tolist()))
                keys = line_keys(raw)
                at = dict(zip(unique := list(set(keys)), map(tuple, _digests(unique).tolist())))
                left = [line for line, k in zip(raw.split(b"\n"), keys) if not k or at[k] not in gone]
                out.append((n, n - len(left), b"\n".join(left).decode()))
            return pd.DataFrame(out, columns=["n_lines", "n_dropped", "kept"])

        done = rows.withColumn("c", cut(F.col(f"r.{self.text}").cast("string"), "a", "b"))
        return done.select(*[F.col("c.kept").alias(c) if c == self.text else F.col("r")[c].alias(c) for c in docs.columns],
                           F.col("c.n_lines").alias("n_lines"), F.col("c.n_dropped").alias("n_dropped"))


def drop_frequent_lines(docs: DataFrame, threshold: int = 10, min_chars: int = 1, text: str = "text") -> DataFrame:
    """Count the lines of ``docs`` and drop, in all of them, those that stand in ``threshold`` documents or more."""
    return LineDedup(docs.sparkSession, threshold, min_chars, text).insert(docs).apply(docs)
