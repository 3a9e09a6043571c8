"""N-gram Jaccard join with signature trees: near-duplicate components of documents by their word shingles.

Documents with equal sets are one node.  A set that links has all but a few of its shingles in another set.  So among the first shingles of a set in any
order a known number must stand elsewhere too; the order is by hash, with shingles last that a bounded sample shows to be frequent.  Nodes that
pass this filter have their sets built a second time from their texts, and now the shingles are counted exactly and ordered by their number
of nodes: two sets that link share one of the first few shingles of each (prefix filter), rarest first.

Nodes that share a key are joined in one signature tree: leaves in the order of their smallest shingles, inner nodes with the OR of the bitmaps below
and the range of set sizes.  A dual traversal descends into pairs of tree nodes and drops a pair when the largest overlap that bitmaps and
sizes allow is too small, or when everything below is linked already; what is left is compared exactly.  The first keys are minimal hashes, which link
nearly all copies while each set is sent once; the last round takes every shared prefix shingle whose nodes are not yet in one component,
which makes the result complete.  Nodes that meet under several keys are joined once, in the tree of their family, unless that is larger
than a block.  Large groups are cut into blocks that meet in pairs, so a task holds at most two blocks.

Prefixes, sets and links are written tables that are deleted as soon as the step that reads them has written its own.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from burstframe.llm.common import arrow_map, as_bytes, blocks, lists, mix64, text_key
from burstframe.llm.graph import components
from burstframe.operators.reuse import drop, keep

#: One document in so many shows which shingles are frequent; the list has so many entries at most (8 bytes each).
SAMPLE, FREQUENT = 64, 200_000
#: Children of a tree node; bits of a bitmap per shingle of the largest set of a group.
FAN, BITS = 4, 16
#: Shingles of the sets in one block of a large group.
BLOCK = 2_000_000
KEYS = 4


def shingles(texts: list[bytes], k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the ``k``-word shingles of each text (A-Z lower-cased), with repeats, and the offsets of the texts.

    A text of fewer words has its whole sequence as its one shingle; a text without words has none.
    """
    split = [t.lower().split() for t in texts]  # on bytes: ASCII letters and the six white characters only
    n = np.fromiter(map(len, split), np.int64, len(split))
    ids: dict[bytes, int] = {}
    flat = np.fromiter((ids.setdefault(w, len(ids)) for ws in split for w in ws), np.int64, int(n.sum()))
    word = np.fromiter(map(xxhash.xxh3_64_intdigest, ids), np.uint64, len(ids))
    h = word[flat] if len(ids) else np.zeros(0, np.uint64)
    out = h[: len(h) - k + 1].copy() if len(h) >= k else h[:0].copy()
    for j in range(1, k):
        out = mix64(out * np.uint64(0xD6E8FEB86659FD93) + h[j : j + len(out)])
    ends = np.cumsum(n)
    starts = ends - n
    text = np.repeat(np.arange(len(n)), n)[: len(out)]
    out = out[np.arange(len(out)) + k <= ends[text]]
    counts = np.maximum(n - k + 1, 0)
    few = np.flatnonzero((n > 0) & (n < k))
    if len(few):
        own = np.array([xxhash.xxh3_64_intdigest(b" ".join(split[i]), seed=k) for i in few], np.uint64)
        out = np.insert(out, np.concatenate([[0], np.cumsum(counts)])[few], own)
        counts[few] = 1
    return out, np.concatenate([[0], np.cumsum(counts)])


def sets(texts: list[bytes], k: int) -> list[np.ndarray]:
    """Sorted distinct shingles of each text."""
    flat, at = shingles(texts, k)
    return [np.unique(flat[a:b]) for a, b in zip(at, at[1:])]


class Order:
    """Common order of shingles: those not known as frequent by hash, then the frequent ones, rarest first."""

    def __init__(self, frequent: np.ndarray, counts: np.ndarray):
        by = np.argsort(frequent)
        self.frequent, self.counts = frequent[by], counts[by]
        self.maybe = np.zeros(1 << 22, bool)
        self.maybe[self.frequent & np.uint64(len(self.maybe) - 1)] = True

    def first(self, members: np.ndarray, n: int) -> np.ndarray:
        test = np.flatnonzero(self.maybe[members & np.uint64(len(self.maybe) - 1)])
        if not len(test):
            return members[:n]
        at = np.minimum(np.searchsorted(self.frequent, members[test]), len(self.frequent) - 1)
        known = self.frequent[at] == members[test]
        rank = np.zeros(len(members), np.int64)
        rank[test[known]] = self.counts[at[known]]
        return members[np.argsort(rank, kind="stable")[:n]]


class Tree:
    """Signature tree over sets and the links that its dual traversal finds."""

    def __init__(self, members: list[np.ndarray], labels: np.ndarray, num: int, den: int):
        self.num, self.den = num, den
        order = sorted(range(len(members)), key=lambda i: (members[i][0], members[i][1], len(members[i])))
        self.members = [members[i] for i in order]
        self.place = np.array(order)
        self.parent = np.unique(labels[order], return_inverse=True)[1]
        first = {}
        self.parent = np.array([first.setdefault(x, i) for i, x in enumerate(self.parent.tolist())])
        self.links: list[tuple[int, int]] = []

    def _root(self, i: int) -> int:
        p = self.parent
        while p[i] != i:
            p[i] = p[p[i]]
            i = p[i]
        return i

    def _roots(self) -> np.ndarray:
        p = self.parent
        while True:
            q = p[p]
            if (q == p).all():
                self.parent = q
                return q
            p = q

    def _try(self, i: int, j: int) -> None:
        if (a := self._root(i)) == (b := self._root(j)):
            return
        x, y = self.members[i], self.members[j]
        if self.den * min(len(x), len(y)) < self.num * max(len(x), len(y)):
            return
        both = len(np.intersect1d(x, y, assume_unique=True))
        if self.den * both >= self.num * (len(x) + len(y) - both):
            self.parent[max(a, b)] = min(a, b)
            self.links.append((int(self.place[i]), int(self.place[j])))

    def join(self) -> list[tuple[int, int]]:
        """Pairs of members (as given) whose links connect all that link."""
        n = len(self.members)
        for i in range(n - 1):  # neighbours in the leaf order first: most copies
            self._try(i, i + 1)
        if n > 2 and len(np.unique(self._roots())) > 1:
            if n <= FAN:
                for i in range(n):
                    for j in range(i + 2, n):
                        self._try(i, j)
            else:
                self._traverse()
        return self.links

    def _levels(self) -> list[tuple]:
        sizes = np.array([len(m) for m in self.members])
        bits = 1 << int(np.clip(np.ceil(np.log2(BITS * sizes.max())), 9, 17))
        maps = np.zeros((len(sizes), bits // 64), np.uint64)
        for row, m in zip(maps, self.members):
            at = m & np.uint64(bits - 1)
            np.bitwise_or.at(row, (at >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at & np.uint64(63)))
        over = sizes - np.bitwise_count(maps).sum(1, dtype=np.int64)  # shingles beyond one per bit
        out = [(maps, sizes, sizes, over)]
        while len(out[-1][0]) > 1:
            maps, low, high, over = out[-1]
            at = np.arange(0, len(maps), FAN)
            out.append((np.bitwise_or.reduceat(maps, at, axis=0), np.minimum.reduceat(low, at), np.maximum.reduceat(high, at), np.maximum.reduceat(over, at)))
        return out

    def _possible(self, level: tuple, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Whether a pair below x and y may link by sizes and by the largest overlap of their bitmaps."""
        maps, low, high, over = level
        ok = (self.den * high[x] >= self.num * low[y]) & (self.den * high[y] >= self.num * low[x])
        at = np.flatnonzero(ok)
        shared = np.bitwise_count(maps[x[at]] & maps[y[at]]).sum(1, dtype=np.int64) + np.minimum(over[x[at]], over[y[at]])
        most = np.minimum(shared, np.minimum(high[x[at]], high[y[at]]))
        ok[at] = (self.den + self.num) * most >= self.num * (low[x[at]] + low[y[at]])
        return ok

    def _traverse(self) -> None:
        levels = self._levels()
        stack = [(len(levels) - 1, np.zeros(1, np.int64), np.zeros(1, np.int64))]
        while stack:
            depth, x, y = stack.pop()
            roots = self._roots()
            at = np.arange(0, len(roots), FAN**depth)
            low, high = np.minimum.reduceat(roots, at), np.maximum.reduceat(roots, at)
            open_ = (low[x] != high[x]) | (low[y] != high[y]) | (low[x] != low[y])
            x, y = x[open_], y[open_]
            ok = self._possible(levels[depth], x, y)
            x, y = x[ok], y[ok]
            if depth == 0:
                for i, j in zip(x.tolist(), y.tolist()):
                    self._try(i, j)
                continue
            n = len(levels[depth - 1][0])
            a, b = np.divmod(np.arange(FAN * FAN), FAN)
            cx, cy = (x[:, None] * FAN + a).ravel(), (y[:, None] * FAN + b).ravel()
            fits = (cx < n) & (cy < n) & (cx <= cy)
            if depth == 1:
                fits &= cx < cy
            cx, cy = cx[fits], cy[fits]
            for s in range(0, len(cx), 16384):
                stack.append((depth - 1, cx[s : s + 16384], cy[s : s + 16384]))


def _join_groups(num: int, den: int):
    """Function over Arrow batches sorted by key, i, j: links found in each group."""

    def run(batches):
        held, of = [], None

        def flush():
            rows = pa.Table.from_batches(held)
            ids, first = np.unique(rows.column("nid").to_numpy(), return_index=True)
            if len(ids) < 2:
                return None
            column = rows.column("members").combine_chunks()
            values, at = column.values.to_numpy().view(np.uint64), column.offsets.to_numpy()
            labels = rows.column("comp").to_numpy()[first]
            links = Tree([values[at[i] : at[i + 1]] for i in first], labels, num, den).join()
            if not links:
                return None
            a, b = np.array(links).T
            return pa.RecordBatch.from_pydict({"a": ids[a], "b": ids[b]})

        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in ("key", "i", "j")], axis=1)
            cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1).tolist(), len(keys)]
            for s, e in zip(cuts, cuts[1:]):
                if s == e:
                    continue
                if of is not None and tuple(keys[s]) != of:
                    if (out := flush()) is not None:
                        yield out
                    held.clear()
                of = tuple(keys[s])
                held.append(batch.slice(s, e - s))
        if held and (out := flush()) is not None:
            yield out

    return run


class JaccardJoin:
    """Near-duplicate components at ``num / den`` Jaccard similarity of ``k``-word shingles."""

    def __init__(self, k: int = 5, num: int = 80, den: int = 100, doc_id: str = "doc_id", text: str = "text"):
        self.k, self.num, self.den, self.doc_id, self.text = k, num, den, doc_id, text
        self.share = 0.5 ** max(0, k - 3)
        #: smallest set that can link to a different one (its partner has one shingle more)
        self.least = next(n for n in range(1, 10 * den) if den * n >= num * (n + 1))

    def _alone(self, n: int) -> int:
        """How many shingles of a set may be missing in a set that links to it."""
        return n - -(-self.num * n // self.den)

    def _found(self, n: int) -> int:
        """How many of the first ``_alone + _found`` shingles must stand in another set; longer shingles seldom do by chance."""
        return max(1, int(self._alone(n) * self.share))

    def _rows(self, docs: DataFrame) -> DataFrame:
        text = F.col(self.text).cast("string")
        return docs.select(F.col(self.doc_id).cast("long").alias("id"), text.alias("text"), text_key(text)[0])

    def _order(self, rows: DataFrame) -> Order:
        k = self.k

        def step(batch: pa.RecordBatch):
            texts = as_bytes(batch.column(0))
            each = [m for a, b in blocks([len(t) for t in texts]) for m in sets(texts[a:b], k)]
            values, n = np.unique(np.concatenate(each), return_counts=True)
            return {"s": values.view(np.int64), "n": n}

        seen = arrow_map(rows.where(F.pmod(F.xxhash64("id", "t1"), F.lit(SAMPLE)) == 0).select("text"), "s long, n long", step)
        top = seen.groupBy("s").agg(F.sum("n").alias("n")).where("n >= 3").orderBy(F.desc("n"), "s").limit(FREQUENT).toArrow()
        return Order(top.column("s").to_numpy().view(np.uint64), top.column("n").to_numpy())

    def _sketch(self, rows: DataFrame) -> DataFrame:
        """Per row: set size, digest, minimal hashes and prefix."""
        k, least = self.k, self.least
        shared = rows.sparkSession.sparkContext.broadcast(self._order(rows))

        def step(batch: pa.RecordBatch):
            order = shared.value
            texts = as_bytes(batch.column(1))
            n, digest, keys, at, prefix = [], [], [], [0], []
            for a, b in blocks([len(t) for t in texts]):
                for m in sets(texts[a:b], k):
                    n.append(len(m))
                    digest.append(xxhash.xxh3_128_digest(m.tobytes()))
                    if len(m) >= least:
                        keys.append([m[0], *((mix64(m ^ np.uint64(j * 0xA0761D6478BD642F % (1 << 64)))).min() for j in range(1, KEYS))])
                        prefix.append(order.first(m, self._alone(len(m)) + self._found(len(m))))
                        at.append(at[-1] + len(prefix[-1]))
                    else:
                        keys.append([0] * KEYS)
                        at.append(at[-1])
            keys = np.array(keys, np.uint64).view(np.int64)
            d = np.frombuffer(b"".join(digest), "<i8").reshape(-1, 2)
            return {"id": batch.column(0), "t1": batch.column(2), "n": np.array(n, np.int64), "d1": d[:, 0], "d2": d[:, 1],
                    **{f"a{j}": keys[:, j] for j in range(KEYS)}, "prefix": lists(np.array(at), np.concatenate([np.zeros(0, np.uint64), *prefix]).view(np.int64))}

        names = ", ".join(f"a{j} long" for j in range(KEYS))
        return arrow_map(rows, f"id long, t1 long, n long, d1 long, d2 long, {names}, prefix array<long>", step)

    def _sets(self, rows: DataFrame, wanted: DataFrame) -> DataFrame:
        """Sets of the wanted nodes (nid, id, t1), from their texts."""
        k = self.k

        def step(batch: pa.RecordBatch):
            texts = as_bytes(batch.column(1))
            each = [m for a, b in blocks([len(t) for t in texts]) for m in sets(texts[a:b], k)]
            at = np.concatenate([[0], np.cumsum([len(m) for m in each])])
            return {"nid": batch.column(0), "n": np.diff(at), "members": lists(at, np.concatenate(each).view(np.int64))}

        w = wanted.select("nid", F.col("id").alias("wid"), F.col("t1").alias("wt"))
        texts = rows.join(w, (F.col("t1") == F.col("wt")) & F.col("id").eqNullSafe(F.col("wid"))).select("nid", "text")
        return arrow_map(texts, "nid long, n long, members array<long>", step)

    def _round(self, keyed: DataFrame, comps: DataFrame, members: DataFrame, overlapping: bool) -> DataFrame:
        """Links among nodes that share a key (key, nid), for keys whose nodes are in several components; a kept table."""
        rows = keyed.join(comps, "nid")
        marks = [F.sum(F.xxhash64(F.lit(i), "nid").cast("decimal(38,0)")).alias(f"h{i}") for i in range(2)]
        mixed = rows.groupBy("key").agg(F.min("comp").alias("x"), F.max("comp").alias("y"), F.sum("n").alias("total"), F.count("*").alias("m"), *marks).where("x != y")
        mixed = mixed.groupBy("m", "h0", "h1").agg(F.min(F.struct("key", "total")).alias("g")).select("g.*")  # keys of the same nodes: once
        rows = rows.join(mixed, "key").select("key", "nid", "comp", "n", "total")
        used = []
        if overlapping:  # nodes that share several keys meet once, in their family, unless it is too large
            rows = keep(rows)
            first = rows.groupBy("key").agg(F.min("nid").alias("b"))
            family = components(rows.join(first, "key").select(F.col("nid").alias("a"), "b"))
            used = [rows, family]
            sized = family.select(F.col("node").alias("nid"), F.col("root").alias("family")).join(rows.select("nid", "comp", "n").distinct(), "nid")
            small = sized.groupBy("family").agg(F.sum("n").alias("total")).where(F.col("total") <= BLOCK)
            rest = sized.select("nid", "family").join(small, "family", "left_anti").select("nid")
            whole = sized.join(small, "family").select(F.col("family").alias("key"), "nid", "comp", "n", "total", F.lit(0).alias("kind"))
            rows = whole.unionAll(rows.join(rest, "nid", "left_semi").select("key", "nid", "comp", "n", "total", F.lit(1).alias("kind")))
        else:
            rows = rows.withColumn("kind", F.lit(1))
        parts = F.ceil(F.col("total") / F.lit(BLOCK)).cast("int")
        part = F.pmod("nid", parts).cast("int")
        dealt = rows.withColumn("o", F.explode(F.sequence(F.lit(0), parts - 1)))
        dealt = dealt.select(F.xxhash64("kind", "key").alias("key"), F.least(part, "o").alias("i"), F.greatest(part, "o").alias("j"), "nid", "comp")
        dealt = dealt.join(members.select("nid", "members"), "nid").select("key", "i", "j", "nid", "comp", "members")
        dealt = dealt.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
        links = keep(dealt.mapInArrow(_join_groups(self.num, self.den), "a long, b long"))
        drop(*used)
        return links

    def classes(self, docs: DataFrame) -> DataFrame:
        """(id, n_shingles, component_id, t1) for every row of ``docs``; t1 is a hash of the text.

        The component is the smallest id that links reach, the row's own included; rows without words are linked with nothing and keep their
        own id.  Null ids take part in links but name no component unless there is no other id (then null).  Rows that repeat
        an id are nodes of their own text.
        """
        rows = self._rows(docs)
        sketch = keep(self._sketch(rows))
        some = sketch.where("n > 0")
        first = ["n", *[f"a{j}" for j in range(KEYS)], "prefix"]
        nodes = some.groupBy("d1", "d2").agg(F.min("id").alias("least"), F.min(F.struct("id", "t1")).alias("at"), *[F.first(c).alias(c) for c in first])
        nodes = keep(nodes.withColumn("nid", F.monotonically_increasing_id()))
        plain = keep(sketch.select("id", "n", "d1", "d2", "t1"))
        named = keep(nodes.select("d1", "d2", "nid", "least"))
        drop(sketch)
        n = F.col("n")
        alone = n - F.ceil(n * F.lit(self.num) / F.lit(float(self.den)) - F.lit(1e-9))
        found = F.greatest(F.lit(1), F.floor(alone * self.share))
        able = nodes.where(n >= self.least)
        tokens = able.select("nid", F.explode("prefix").alias("key"))
        twice = tokens.groupBy("key").count().where("count > 1").select("key")
        hits = tokens.join(twice, "key", "left_semi").groupBy("nid").count()
        able = able.join(hits, "nid").where(F.col("count") >= found)
        likely = keep(able.select("nid", "n", F.col("at.id").alias("id"), F.col("at.t1").alias("t1"), *[f"a{j}" for j in range(KEYS)]))
        drop(nodes)
        members = keep(self._sets(rows, likely))
        tokens = members.select("nid", "n", F.explode("members").alias("key"))
        twice = tokens.groupBy("key").agg(F.count("*").alias("df")).where("df > 1")
        rare = Window.partitionBy("nid").orderBy("df", "key")
        ranked = tokens.join(twice, "key").withColumns({"i": F.row_number().over(rare), "common": F.count("*").over(Window.partitionBy("nid"))})
        # shingles of one node only come first; where they fill the prefix the node cannot link
        tokens = keep(ranked.where(F.col("i") <= alone + 1 - (n - F.col("common"))).select("nid", "n", "key"))
        able = keep(likely.join(tokens.select("nid").distinct(), "nid", "left_semi"))
        drop(likely)
        comps = able.select("nid", F.col("nid").alias("comp"))
        links = None
        minimal = [able.select("nid", "n", F.col(f"a{j}").alias("key")) for j in range(KEYS)]
        others = minimal[1]
        for m in minimal[2:]:
            others = others.unionAll(m)
        for keyed, overlapping in ((minimal[0], False), (others, True), (tokens, True)):
            new = self._round(keyed, comps, members, overlapping)
            if not new.isEmpty():
                before, links = links, components(new if links is None else new.unionAll(links))
                if before is not None:
                    drop(before)
                roots = links.select(F.col("node").alias("nid"), "root")
                comps = able.select("nid").join(roots, "nid", "left").select("nid", F.coalesce("root", "nid").alias("comp"))
            drop(new)
        drop(members, tokens, able)
        if links is not None:
            named = named.join(links.select(F.col("node").alias("nid"), "root"), "nid", "left").withColumn("root", F.coalesce("root", "nid"))
            smallest = named.groupBy("root").agg(F.min("least").alias("component_id"))
            named = named.join(smallest, "root")
        else:
            named = named.withColumn("component_id", F.col("least"))
        named = named.select("d1", "d2", "component_id")
        out = plain.where("n > 0").join(named, ["d1", "d2"]).select("id", "n", "component_id", "t1")
        return out.unionAll(plain.where("n = 0").select("id", "n", F.col("id").alias("component_id"), "t1")).withColumnRenamed("n", "n_shingles")

    def representatives(self, docs: DataFrame) -> DataFrame:
        """One document of each component, with all columns: that of the smallest id.

        Rows that repeat an id and text count once; other texts under an id are judged by their own components.  Rows without an id stay if their component has no id at all, one for each text.
        """
        rows = keep(self.classes(docs))
        named = rows.where("id = component_id").select(F.col("id").alias("__id"), F.col("t1").alias("__t1")).distinct()
        key, hashed = F.col(self.doc_id), docs.withColumn("__t", text_key(F.col(self.text).cast("string"))[0])
        out = hashed.where(key.isNotNull()).join(named, (key == F.col("__id")) & (F.col("__t") == F.col("__t1")), "left_semi")
        out = out.dropDuplicates([self.doc_id, "__t"]).select(*docs.columns)
        bare = rows.where("id IS NULL AND component_id IS NULL").select(F.col("t1").alias("__t1")).distinct()
        rest = hashed.where(key.isNull())
        return out.unionAll(rest.join(bare, F.col("__t") == F.col("__t1"), "left_semi").dropDuplicates(["__t"]).select(*docs.columns))
