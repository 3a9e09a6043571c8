"""Suffix-array dedup of repeated byte strings across all texts.

A byte goes when it lies in a string of ``length`` bytes that also starts earlier (smaller id, or the same text further left).

1. Anchors.  In every window of ``length`` bytes the ``GRAM``-byte string with the least hash is an anchor, so equal windows have equal
   anchors.  Anchors that stand once in the whole table need no more work; these are counted, combined before the shuffle.
2. Regions.  Around an anchor that stands several times lie all windows that hold it: at most ``2 * length - GRAM`` bytes.  Regions go to the shard of
   their anchor, so all windows that can be equal meet.  Equal regions are one: the later ones are covered without further work.
3. Shards.  A shard's regions get one suffix array: Larsson-Sadakane refinement in numpy, ranks of 8 bytes doubled up to
   the window, sorting only what still shares a rank.  Common prefixes follow Kasai's rule, one step in all regions at a time.  Runs of
   suffixes that agree in ``length`` bytes keep their first member; the windows of the others are covered.
4. Merging.  The regions of a very frequent anchor are cut into several shards.  Each hands on its distinct windows in order, and
   pieces of the windows' range are merged by binary search of one shard's run in another's.

Exact copies of a text are settled by their hash: all but the first are covered whole.  Texts, ids and regions stay in Spark; a task holds one shard.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from burstframe.llm.common import arrow_map, as_bytes, mix64, text_key
from burstframe.operators.reuse import keep

GRAM = 36
#: Bytes that one vectorised step takes: a long text is cut into pieces that overlap by a window.
PIECE = 512 << 10
#: Bytes of regions in a shard; regions of one anchor beyond PART rows are cut into several shards.
SHARD, PART = 2 << 20, 20_000
#: Tasks that the rows of one text's copies are dealt to.
COPIES = 4
BASE = 0x9E3779B97F4A7C15
LAST = (1 << 63) - 1


def _sliding(a: np.ndarray, width: int, best) -> np.ndarray:
    """best(a[i], ..., a[i + width - 1]) for each i that has so many."""
    done = 1
    while 2 * done <= width:
        a = best(a[:-done], a[done:])
        done *= 2
    rest = width - done
    return best(a[: len(a) - rest], a[rest:]) if rest else a


_POWERS: dict = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if _POWERS.get("n", 0) < n:
        inverse = pow(BASE, -1, 1 << 64)
        for name, b in (("up", BASE), ("down", inverse)):
            p = np.full(n, b, np.uint64)
            p[0] = 1
            _POWERS[name] = np.multiply.accumulate(p)
        _POWERS["n"] = n
    return _POWERS["up"], _POWERS["down"]


def anchors(pieces: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(piece, place, hash) of the anchors of pieces of text."""
    pieces_at = np.cumsum([0, *map(len, pieces)])
    c = np.frombuffer(b"".join(pieces), np.uint8)
    none = np.zeros(0, np.int64)
    if len(c) < length:
        return none, none, none.view(np.uint64)
    up, down = _powers(len(c))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((c.astype(np.uint64) + np.uint64(1)) * up[: len(c)])])
    n = len(c) - GRAM + 1
    h = mix64((sums[GRAM:] - sums[:n]) * down[:n])
    np.clip(h, 1, None, out=h)
    width = length - GRAM + 1
    least = _sliding(h, width, np.minimum)  # per window
    of = np.repeat(np.arange(len(pieces)), np.diff(pieces_at))
    starts = np.arange(len(least))
    least = np.where(starts + length <= pieces_at[1:][of[: len(least)]], least, np.uint64(0))
    pad = np.zeros(width - 1, np.uint64)
    most = _sliding(np.concatenate([pad, least, pad]), width, np.maximum)  # the greatest of the minima of all windows around a place
    at = np.flatnonzero(h == most)
    return of[at], at - pieces_at[of[at]], h[at]


def _cut(texts: list[bytes], length: int):
    """Blocks of pieces: (bytes, row, offset) with pieces of a text overlapping by length - 1."""
    held, total = [], 0
    for row, t in enumerate(texts):
        if len(t) < length:
            continue
        for at in range(0, max(1, len(t) - length + 1), PIECE):
            piece = t[at : at + PIECE + length - 1]
            held.append((piece, row, at))
            total += len(piece)
            if total >= PIECE:
                yield held
                held, total = [], 0
    if held:
        yield held


def _all_anchors(texts: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, place, hash) of the anchors of whole texts, each once."""
    out = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    for held in _cut(texts, length):
        piece, place, h = anchors([p for p, _, _ in held], length)
        rows, offsets = (np.array([x[i] for x in held], np.int64) for i in (1, 2))
        for o, v in zip(out, (rows[piece], place + offsets[piece], h)):
            o.append(v)
    row, place, h = (np.concatenate(o) for o in out)
    if any(len(t) > PIECE for t in texts):  # pieces of a text overlap
        _, i = np.unique(np.stack([row, place]), axis=1, return_index=True)
        row, place, h = row[i], place[i], h[i]
    return row, place, h


def suffix_ranks(data: np.ndarray, ends: np.ndarray, depth: int) -> np.ndarray:
    """Ranks of all suffixes by their first ``depth`` bytes (8 times a power of two); equal strings share a rank.

    ``ends`` is the end of each place's string; suffixes shorter than the depth get ranks of their own.
    """
    n = len(data)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    key = np.zeros(n, np.uint64)
    for i in range(8):
        key = key << np.uint64(8) | padded[i : i + n]
    places = np.arange(n)
    order = np.argsort(key)
    s = key[order]
    new = np.ones(n, bool)
    new[1:] = s[1:] != s[:-1]
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, places, 0))
    open_ = np.flatnonzero(places + 8 <= ends)  # suffixes that may share their rank
    rank = np.where(places + 8 <= ends, rank, n + places)
    h = 8
    while h < depth:
        after = rank.copy()
        long = places[open_] + 2 * h <= ends[open_]
        after[open_[~long]] = n + open_[~long]
        open_ = open_[long]
        both = rank[open_] * (2 * n) + rank[open_ + h]  # only what still shares a rank is sorted again
        by = np.argsort(both)
        f, b, o = rank[open_][by], both[by], open_[by]
        begins, split = np.ones(len(o), bool), np.ones(len(o), bool)
        begins[1:], split[1:] = f[1:] != f[:-1], b[1:] != b[:-1]
        i = np.arange(len(o))
        after[o] = f + np.maximum.accumulate(np.where(split, i, 0)) - np.maximum.accumulate(np.where(begins, i, 0))
        shared = np.zeros(n, bool)
        shared[o[~(split & np.append(split[1:], True))]] = True
        rank, open_ = after, np.flatnonzero(shared)
        h *= 2
    return rank


def prefixes_by_kasai(data: np.ndarray, starts: np.ndarray, counts: np.ndarray, before: np.ndarray, rank: np.ndarray, least: int, length: int) -> np.ndarray:
    """Common prefix (up to ``length``) of each wanted suffix with its predecessor in the order, which shares ``least`` bytes (-1: none does).

    Kasai's rule: one place to the right at least one byte less is common, if the suffix there is sorted before this one too (suffixes are sorted by
    ``length`` bytes only; ``rank`` is the place in the order, -1 for unwanted ones).  All regions take the step to their next place together.
    """
    out = np.zeros(len(data), np.int64)
    wide = np.concatenate([data, np.zeros(4, np.uint8)]).astype(np.uint32)
    four = (wide[:-4] << np.uint32(24) | wide[1:-3] << np.uint32(16) | wide[2:-2] << np.uint32(8) | wide[3:-1])
    held = np.zeros(len(starts), np.int64)
    prev = np.full(len(starts), -1, np.int64)
    for step in range(int(counts.max(initial=0))):
        live = np.flatnonzero(counts > step)
        p = starts[live] + step
        q = before[p]
        other = rank[np.minimum(prev[live] + 1, len(data) - 1)]
        follows = (prev[live] >= 0) & (other >= 0) & (other < rank[p])
        l = np.where(q < 0, 0, np.where(follows, np.maximum(held[live] - 1, least), least))
        todo = np.flatnonzero((q >= 0) & (l + 4 <= length))
        while len(todo):  # four bytes at a time
            same = four[p[todo] + l[todo]] == four[q[todo] + l[todo]]
            l[todo] += 4 * same
            todo = todo[same & (l[todo] + 4 <= length)]
        todo = np.flatnonzero((q >= 0) & (l < length))
        while len(todo):
            same = data[p[todo] + l[todo]] == data[q[todo] + l[todo]]
            l[todo] += same
            todo = todo[same & (l[todo] < length)]
        out[p], held[live], prev[live] = l, l, q
    return out


class Shard:
    """Distinct regions with the order (id, text, start) of their first occurrence, and the equal windows among them."""

    def __init__(self, regions: list[bytes], ids: np.ndarray, texts: np.ndarray, starts: np.ndarray, length: int):
        self.length, self.data = length, np.frombuffer(b"".join(regions), np.uint8)
        sizes = np.fromiter(map(len, regions), np.int64, len(regions))
        self.at = np.cumsum(sizes) - sizes
        self.of = np.repeat(np.arange(len(regions)), sizes)
        ends = np.repeat(self.at + sizes, sizes)
        places = np.arange(len(self.data))
        wanted = places + length <= ends
        depth = 8
        while 2 * depth <= length:
            depth *= 2
        rank = suffix_ranks(self.data, ends, depth)
        w = np.flatnonzero(wanted)
        self.order = w[np.argsort(rank[w] * (2 * len(places)) + rank[w + length - depth])]
        before = np.full(len(places), -1, np.int64)
        close = rank[self.order[1:]] == rank[self.order[:-1]]  # others share fewer than depth bytes
        before[self.order[1:][close]] = self.order[:-1][close]
        placed = np.full(len(places), -1, np.int64)
        placed[self.order] = np.arange(len(self.order))
        lcp = prefixes_by_kasai(self.data, self.at, sizes - length + 1, before, placed, depth, length)
        self.run = np.cumsum(lcp[self.order] < length) - 1
        region = self.of[self.order]
        self.key = ids[region], texts[region], starts[region] + self.order - self.at[region]
        self.regions, self.texts, self.starts = regions, texts, starts

    def leaders(self) -> np.ndarray:
        """Per run of equal windows the place (in the order) of the earliest."""
        sizes = np.bincount(self.run)
        lead = np.cumsum(sizes) - sizes
        several = np.flatnonzero(sizes[self.run] > 1)
        by = several[np.lexsort((*(k[several] for k in self.key[::-1]), self.run[several]))]
        first = np.ones(len(by), bool)
        first[1:] = self.run[by][1:] != self.run[by][:-1]
        lead[self.run[by[first]]] = by[first]
        return lead

    def covered(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, start, end) of what later windows cover."""
        lead = self.leaders()[self.run]
        later = np.zeros(len(self.order), bool)  # a window may stand in the regions of two anchors: it is not later than itself
        for k in self.key:
            later |= k != k[lead]
        at = np.sort(self.order[later])
        if not len(at):
            return at, at, at
        new = np.ones(len(at), bool)
        new[1:] = (np.diff(at) > 1) | (self.of[at][1:] != self.of[at][:-1])
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(at)) - 1
        r = self.of[at[first]]
        return self.texts[r], self.starts[r] + at[first] - self.at[r], self.starts[r] + at[last] - self.at[r] + self.length

    def windows(self, lead: np.ndarray) -> np.ndarray:
        """Digests of the leaders' windows."""
        raw = self.data.tobytes()
        return np.frombuffer(b"".join(xxhash.xxh3_128_digest(raw[p : p + self.length]) for p in self.order[lead].tolist()), "<i8").reshape(-1, 2)


ROWS = "key long, part int, parts int, d1 long, d2 long, id long, t1 long, s long, e long, region binary"


def _columns(n: int, **given) -> dict:
    blank = {c.split()[0]: np.zeros(n, np.int32 if c.split()[1] == "int" else np.int64) for c in ROWS.split(", ")[:-1]}
    return {**blank, "region": pa.nulls(n, pa.binary()), **given}


def _spans(text, s, e) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"kind": pa.array(np.zeros(len(s), np.int32)), **{k: pa.array(v) for k, v in _columns(len(s), t1=text, s=s, e=e).items()}})


def _resolve(length: int):
    """Arrow batches of regions sorted by (key, part) to covered spans (kind 0) and windows of split anchors (kind 1)."""

    def run(batches):
        held: list[pa.RecordBatch] = []
        size, of = 0, None

        def flush():
            rows = pa.Table.from_batches(held)
            regions = rows.column("region").combine_chunks()
            sizes = pc.binary_length(regions).to_numpy()
            key, part, parts, d1, ids, text, start = (rows.column(c).to_numpy() for c in ("key", "part", "parts", "d1", "id", "t1", "s"))
            by = np.lexsort((start, text, ids, d1, part, key))
            same = np.zeros(len(by), bool)  # an equal region of the same anchor came earlier
            same[1:] = (key[by][1:] == key[by][:-1]) & (d1[by][1:] == d1[by][:-1])
            own = np.zeros(len(by), bool)  # and is the same one: a repeated row
            own[1:] = (text[by][1:] == text[by][:-1]) & (start[by][1:] == start[by][:-1])
            again, first = by[same & ~own], by[~same]
            if len(again):
                yield _spans(text[again], start[again], start[again] + sizes[again])
            k = np.stack([key[first], part[first]])
            several = np.zeros(len(first), bool)
            several[1:] |= (k[:, 1:] == k[:, :-1]).all(0)
            several[:-1] |= (k[:, 1:] == k[:, :-1]).all(0)
            first = first[several | (parts[first] > 1)]
            if not len(first):
                return
            shard = Shard(regions.take(pa.array(first)).to_pylist(), ids[first], text[first], start[first], length)
            yield _spans(*shard.covered())
            if (parts[first] > 1).any():
                lead = shard.leaders()
                r = first[shard.of[shard.order[lead]]]
                lead, r = lead[parts[r] > 1], r[parts[r] > 1]
                d = shard.windows(lead)
                out = _columns(len(r), key=key[r], part=(d[:, 0] % parts[r]).astype(np.int32), parts=part[r], d1=d[:, 0], d2=d[:, 1], id=shard.key[0][lead],
                               t1=shard.key[1][lead], s=shard.key[2][lead])
                yield pa.RecordBatch.from_pydict({"kind": pa.array(np.ones(len(r), np.int32)), **{c: pa.array(v) if not isinstance(v, pa.Array) else v for c, v in out.items()}})

        for batch in batches:
            e = batch.column("region").is_null().to_numpy(zero_copy_only=False)
            if e.any():
                yield pa.RecordBatch.from_pydict({"kind": pa.array(np.zeros(int(e.sum()), np.int32)), **{n: batch.filter(pa.array(e)).column(n) for n in batch.schema.names}})
                batch = batch.filter(pa.array(~e))
            keys = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in ("key", "part")], axis=1)
            cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1).tolist(), len(keys)]
            lengths = np.concatenate([[0], np.cumsum(pc.binary_length(batch.column("region")).to_numpy())])
            begin = 0
            for s, t in zip(cuts, cuts[1:]):
                if s == t:
                    continue
                if size >= SHARD and of is not None and tuple(keys[s]) != of:  # whole groups only
                    if s > begin:
                        held.append(batch.slice(begin, s - begin))
                    yield from flush()
                    held.clear()
                    size, begin = 0, s
                of = tuple(keys[s])
                size += int(lengths[t] - lengths[s])
            if len(keys) > begin:
                held.append(batch.slice(begin))
        if held:
            yield from flush()

    return run


def _merge(length: int):
    """Windows of split anchors, sorted by (key, part, shard): all but the earliest of equal ones are covered."""

    def run(batches):
        held, of = [], None

        def flush():
            rows = pa.Table.from_batches(held)
            shard, d1, d2, ids, text, start = (rows.column(c).to_numpy() for c in ("parts", "d1", "d2", "id", "t1", "s"))
            digest = np.empty(len(d1), [("a", np.int64), ("b", np.int64)])
            digest["a"], digest["b"] = d1, d2
            merged = np.zeros(0, np.int64)  # rows, in the order of their windows, the earliest of each
            later = []
            for s in np.unique(shard):
                mine = np.flatnonzero(shard == s)
                mine = mine[np.argsort(digest[mine])]
                at = np.searchsorted(digest[merged], digest[mine])
                met = (at < len(merged)) & (digest[merged[np.minimum(at, max(0, len(merged) - 1))]] == digest[mine]) if len(merged) else np.zeros(len(mine), bool)
                old, new = merged[at[met]], mine[met]
                swap = _before(ids, text, start, new, old)
                later.append(np.where(swap, old, new)[(ids[old] != ids[new]) | (text[old] != text[new]) | (start[old] != start[new])])
                merged[at[met]] = np.where(swap, new, old)
                merged = np.insert(merged, at[~met], mine[~met])
            gone = np.concatenate(later)
            return _spans(text[gone], start[gone], start[gone] + length) if len(gone) else None

        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in ("key", "part")], axis=1)
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


def _before(ids, text, start, a, b) -> np.ndarray:
    return (ids[a] < ids[b]) | ((ids[a] == ids[b]) & ((text[a] < text[b]) | ((text[a] == text[b]) & (start[a] < start[b]))))


def _merged(spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Overlapping spans (text, start, end) of a text as one."""
    out: list[tuple[int, int, int]] = []
    for t, s, e in sorted(spans):
        if out and out[-1][0] == t and s <= out[-1][2]:
            out[-1] = t, out[-1][1], max(e, out[-1][2])
        else:
            out.append((t, s, e))
    return out


def covered_spans(rows: DataFrame, firsts: DataFrame, length: int) -> DataFrame:
    """(t1, s, e): covered byte ranges, which may overlap, of the first row of each text.

    ``rows``: id, text, t1, t2; ``firsts``: t1, t2, id of the first row of each text.
    """
    def count(batch: pa.RecordBatch):
        _, _, h = _all_anchors(as_bytes(batch.column(0)), length)
        keys, n = np.unique(h, return_counts=True)
        return {"key": keys.view(np.int64), "n": n}

    def place(batch: pa.RecordBatch):
        t1 = batch.column(1).to_numpy()
        _, one = np.unique(t1, return_index=True)
        texts = as_bytes(batch.column(0))
        row, at, h = _all_anchors([texts[i] for i in one], length)
        return {"key": h.view(np.int64), "t1": t1[one][row], "p": at.astype(np.int32)}

    long = rows.where(F.octet_length("text") >= length)
    distinct = long.join(firsts, ["t1", "t2", "id"], "left_semi")
    shared = keep(arrow_map(distinct.select("text"), "key long, n long", count).groupBy("key").agg(F.sum("n").alias("n")).where("n > 1"))
    anchored = arrow_map(long.select("text", "t1"), "key long, t1 long, p int", place).join(shared, "key").distinct()
    parts = F.ceil(F.col("n") / F.lit(PART)).cast("int")
    wanted = keep(anchored.groupBy("t1").agg(F.collect_list(F.struct("p", "key", parts.alias("parts"))).alias("a")))

    def regions(batch: pa.RecordBatch):
        ids, t1 = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        texts, lists = as_bytes(batch.column(2)), batch.column(3)
        seen: dict = {}
        found, spans = [], []
        for i in np.lexsort((t1, ids)).tolist():
            a = lists[i].values
            p, key, n = (a.field(j).to_numpy() for j in range(3))
            text, me, t = texts[i], int(ids[i]), int(t1[i])
            for j in np.argsort(p, kind="stable").tolist():
                at, k = int(p[j]), int(key[j])
                s = max(0, at - (length - GRAM))
                region = text[s : at + length]
                d = int.from_bytes(xxhash.xxh3_64_digest(region, seed=at - s), "little", signed=True)
                if (k, d) in seen:  # all of an equal region's windows start earlier there, unless it is this one (a repeated row)
                    if seen[k, d] != (t, s):
                        spans.append((t, s, s + len(region)))
                else:
                    seen[k, d] = t, s
                    found.append((k, d % int(n[j]), int(n[j]), d, me, t, s, region))
        spans = _merged(spans)
        f = list(zip(*found)) or [[] for _ in range(8)]
        t, s, e = list(zip(*spans)) or ([], [], [])
        m, n = len(found), len(spans)
        blank = _columns(n, key=np.array(t, np.int64), t1=np.array(t, np.int64), s=np.array(s, np.int64), e=np.array(e, np.int64))
        mine = _columns(m, key=np.array(f[0], np.int64), part=np.array(f[1], np.int32), parts=np.array(f[2], np.int32), d1=np.array(f[3], np.int64),
                        id=np.array(f[4], np.int64), t1=np.array(f[5], np.int64), s=np.array(f[6], np.int64), region=pa.array(f[7], pa.binary()))
        return {c: pa.concat_arrays([pa.array(mine[c]) if not isinstance(mine[c], pa.Array) else mine[c], pa.array(blank[c]) if not isinstance(blank[c], pa.Array) else blank[c]])
                for c in mine}

    first = firsts.join(wanted, "t1")
    found = arrow_map(long.join(first, ["t1", "t2", "id"]).select("id", "t1", "text", "a"), ROWS, regions)
    resolved = keep(found.repartition("key", "part").sortWithinPartitions("key", "part").mapInArrow(_resolve(length), "kind int, " + ROWS))
    split = resolved.where("kind = 1").drop("kind").repartition("key", "part").sortWithinPartitions("key", "part", "parts")
    merged = split.mapInArrow(_merge(length), "kind int, " + ROWS)
    return resolved.where("kind = 0").select("t1", "s", "e").unionAll(merged.select("t1", "s", "e"))


def remove_repeats(docs: DataFrame, length: int = 100, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Documents with ``n_bytes``, ``removed_spans`` (maximal removed byte ranges [s, e)) and ``kept`` (the remaining bytes, binary).

    Null texts are empty; a null id counts as the largest.  Rows with the same id and text are one document (each gets the same result); different
    texts under one id are ordered by hash.  Strings are judged on the input, not on what is left.  Input columns with the names of results are replaced.
    """
    if length < GRAM + 8:
        raise ValueError(f"length must be {GRAM + 8} or more")
    made = ("n_bytes", "removed_spans", "kept")
    column = F.col(text).cast("string")
    order = F.coalesce(F.col(doc_id).cast("long"), F.lit(LAST))
    rows = docs.select(order.alias("id"), column.alias("text"), *text_key(column))
    texts = keep(rows.where(F.octet_length("text") >= length).groupBy("t1", "t2").agg(F.min("id").alias("id"), F.count("*").alias("n")))
    spans = covered_spans(rows, texts.drop("n"), length).groupBy("t1").agg(F.collect_set(F.struct("s", "e")).alias("spans"))
    plan = texts.join(spans, "t1", "left").where("n > 1 OR spans IS NOT NULL").select("t1", "t2", F.col("id").alias("first"), "spans")
    plan = keep(plan).withColumn("salt", F.explode(F.array(*[F.lit(i) for i in range(COPIES)])))
    salt = F.pmod(F.xxhash64(F.lit(0), order), F.lit(COPIES)).cast("int").alias("salt")
    names = [c for c in docs.columns if c not in made or c == text]
    all_ = docs.select(F.struct(*names).alias("r"), order.alias("id"), *text_key(column), salt).join(plan, ["t1", "t2", "salt"], "left")

    @F.pandas_udf("n_bytes long, removed_spans array<struct<s:long,e:long>>, kept binary")
    def cut(text: pd.Series, ids: pd.Series, first: pd.Series, spans: pd.Series) -> pd.DataFrame:
        out = []
        for t, i, f, given in zip(text, ids, first, spans):
            raw = (t or "").encode()
            if f is None or f != f:
                found = []
            elif i != f:
                found = [(0, len(raw))]
            else:
                found = []
                for s, e in sorted((x["s"], x["e"]) for x in (given if given is not None else [])):
                    if found and s <= found[-1][1]:
                        found[-1] = (found[-1][0], max(e, found[-1][1]))
                    else:
                        found.append((s, e))
            ends = [0, *[e for _, e in found]]
            kept = b"".join(raw[a:b] for a, b in zip(ends, [*[s for s, _ in found], len(raw)]))
            out.append((len(raw), [{"s": s, "e": e} for s, e in found], kept))
        return pd.DataFrame(out, columns=["n_bytes", "removed_spans", "kept"])

    # ids as text: longs with nulls would become doubles in pandas
    done = all_.withColumn("c", cut(F.col(f"r.{text}").cast("string"), F.col("id").cast("string"), F.col("first").cast("string"), "spans"))
    return done.select(*[F.col("r")[c].alias(c) for c in names if c not in made], *[F.col(f"c.{c}").alias(c) for c in made])
