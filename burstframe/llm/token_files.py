"""Token ids in raw binary files with a minimal perfect hash index of the documents.

Layout of a folder (all integers little-endian):

* ``ids-<shard>-<tag>.bin``: ids of the shard's documents, one after the other, 2 bytes each where the vocabulary fits, else 4;
* ``off-<shard>-<tag>.bin``: 8-byte positions (in ids) of every document of the shard, and the end;
* ``key-<bucket>-<tag>.bin``: a minimal perfect hash of the keys of one bucket, then per slot a 64-bit fingerprint, shard, first record and
  number of records of the key;
* ``shards`` and ``buckets``: Parquet tables that name the files.  A retried task writes files under another tag; files that no table names are leftovers.

Documents are ordered by id (null first), rows of one id by a hash of their text; shards are even ranges of that order, so an id with a third of all rows
is spread over many shards.  The first key of each shard is found on the ids and hashes alone and sent to the tasks (one entry for each shard), so texts
are encoded once and their ids shuffled once.  A key is (id, run): run 0 is the id's first shard and knows how many further shards hold the id.
The perfect hash is a cascade of bit arrays: a level keeps the keys that meet no other key and hands on the rest; a key's slot is the number of bits set
before its own.  Access costs one bucket, one slot, two positions and one read, whatever the size of the folder.
"""

from __future__ import annotations

import re
import struct
import sys
import uuid
from array import array
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from burstframe.llm.common import mix64
from burstframe.operators.reuse import keep
from burstframe.session import ensure_checkpoint_dir

#: Bytes of text in a shard (its ids take about as many), and keys in an index bucket.
SHARD_BYTES, BUCKET_KEYS = 16 << 20, 200_000
#: Chunks and pieces that a worker remembers at most (the oldest go first), and the longest chunk that it remembers.
REMEMBERED, PIECES_KEPT, LONGEST = 1_400_000, 100_000, 48
#: Bytes that one read of neighbouring records takes at most (a longer record is a read of its own).
READ_BYTES = 4 << 20
#: The published split of byte-level vocabularies (fixed value).
PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
#: The same split of printable ASCII.
ASCII_PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^ A-Za-z0-9]+| +(?![^ ])| +")
#: Marks of ASCII, which are a piece by themselves after a letter.
MARKS = frozenset("!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")
SINGLE = re.compile("(?<=[^\\s\u180e]) (?=[^\\s\u180e])")
#: Texts on whose classes of characters all libraries agree.
PLAIN = re.compile("[\t\n\r -~\u00a1-\u024f]*")
MAGIC = b"mphkeys1"


def byte_names() -> dict[int, str]:
    """The printable character by which byte-level vocabularies write each byte."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(256, 512))
    return {b: chr(b) if b in plain else chr(next(others)) for b in range(256)}


class Names(dict):
    """The name of each character met (of texts of plain Latin letters) in a byte-level vocabulary."""

    def __init__(self):
        super().__init__()
        self.bytes = byte_names()

    def __missing__(self, char: str) -> str:
        name = self[char] = "".join(self.bytes[b] for b in char.encode())
        return name


class Chunks(dict):
    """Ids (as bytes) of chunks by the library, remembered; ``None`` where a chunk may not be cut off at its spaces.

    The splitting pattern always cuts before a single space between two other characters, so the ids of a text are those of its chunks.  Chunks of
    plain Latin letters go piece by piece to the library's model; all others go to its whole encoder.
    """

    def __init__(self, tokenizer, kind: str, lead: str = " "):
        super().__init__()
        self.tokenizer, self.kind, self.lead = tokenizer, kind, lead
        self.model, self.names = tokenizer.model.tokenize, Names()
        self.space, self.code = self.names[" "], {"<u2": "H", "<u4": "I"}[kind]
        self.marks = {c: self.word(c) for c in MARKS}
        self.old: dict[str, bytes | None] = {}  # the half that has not been asked for lately
        self.pieces: dict[str, bytes] = {}

    def __missing__(self, chunk: str) -> bytes | None:
        if chunk in self.old:
            found = self.old.pop(chunk)
        elif chunk.isascii() and chunk.isalpha():
            found = self.word(self.lead + chunk)
        elif chunk[-1:] in MARKS and chunk[:-1].isalpha() and len(chunk) < LONGEST and max(chunk) <= "\u024f":  # a word and a mark are two pieces
            found = self[chunk[:-1]] + self.marks[chunk[-1]]
        elif not chunk and self.lead or chunk and (chunk[0].isspace() or chunk[-1].isspace() or "\u180e" in chunk):
            found = None
        else:
            found = self.whole(self.lead + chunk)
        if len(chunk) <= LONGEST:
            if len(self) >= REMEMBERED // 2:
                self.old = dict(self)
                self.clear()
            self[chunk] = found
        return found

    def whole(self, text: str) -> bytes:
        plain = text.isprintable()
        ascii_ = plain and text.isascii()
        if len(text) > LONGEST or not (ascii_ or plain and max(text) <= "\u024f" or PLAIN.fullmatch(text)):
            return self.packed(self.tokenizer.encode(text, add_special_tokens=False).ids)
        if text[1:].isalpha() and (text[0] == " " or text[0].isalpha()):
            return self.piece(text)
        out = []
        for piece in (ASCII_PIECES if ascii_ else PIECES).findall(text):
            ids = self.pieces.get(piece)
            if ids is None and self.lead and piece[0] == " ":
                ids = self.get(piece[1:])  # the word stood by itself before
            if ids is None:
                if len(self.pieces) >= PIECES_KEPT:
                    self.pieces.clear()
                ids = self.pieces[piece] = self.word(piece) if ascii_ else self.piece(piece)
            out.append(ids)
        return b"".join(out)

    def piece(self, piece: str) -> bytes:
        return self.packed([t.id for t in self.model("".join(map(self.names.__getitem__, piece)))])

    def word(self, piece: str) -> bytes:
        """Ids of a piece of printable ASCII, where only the space has another name."""
        if len(piece) > LONGEST:
            return self.packed(self.tokenizer.encode(piece, add_special_tokens=False).ids)
        return self.packed([t.id for t in self.model(piece.replace(" ", self.space))])

    def packed(self, ids: list[int]) -> bytes:
        out = array(self.code, ids)
        if sys.byteorder == "big":
            out.byteswap()
        return out.tobytes()


class Encoder:
    """Whole texts to ids, equal to the library's ``encode(text, add_special_tokens=False)``."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.kind = "<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4"
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.chunks, self.heads = Chunks(self.tokenizer, self.kind), Chunks(self.tokenizer, self.kind, "")

    def encode(self, text: str) -> bytes:
        if any(s in text for s in self.special):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.kind).tobytes()
        head, *rest = text.split(" ")
        try:
            return b"".join([self.heads[head], *map(self.chunks.__getitem__, rest)])
        except TypeError:  # white space beside a space: cut at the single spaces only
            pass
        head, *rest = SINGLE.split(text)
        return b"".join([self.heads.whole(head), *[self.chunks[c] if self.chunks[c] is not None else self.chunks.whole(" " + c) for c in rest]])


_ENCODERS: dict[str, Encoder] = {}


def encoded(docs: DataFrame, tokenizer: str, end: int, bounds: list[tuple]) -> DataFrame:
    """Rows of (doc_id, t1, t2, row, text) with ``ids`` (bytes in the width of the vocabulary, ``end`` last) and ``shard`` in place of the text."""
    from pyspark.sql.types import BinaryType, IntegerType, StructType

    kept = ["doc_id", "t1", "t2", "row"]
    rows = docs.select(*kept, "text")
    schema = StructType([*[rows.schema[c] for c in kept]]).add("ids", BinaryType()).add("shard", IntegerType())
    shared = docs.sparkSession.sparkContext.broadcast(bounds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _ENCODERS.get(tokenizer) or _ENCODERS.setdefault(tokenizer, Encoder(tokenizer))
        last = np.array([end], encoder.kind).tobytes()
        firsts = shared.value
        for batch in batches:
            ids = [encoder.encode(t or "") + last for t in batch.column(4).to_pylist()]
            shard = [bisect_right(firsts, _place(*k)) - 1 for k in zip(*[c.to_pylist() for c in batch.columns[:4]])]
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(ids, pa.binary()), pa.array(shard, pa.int32())], names=[*kept, "ids", "shard"])

    return rows.mapInArrow(run, schema)


def _place(doc_id, *rest: int) -> tuple:
    """A row's place in the order of documents, to be compared."""
    return (doc_id is not None, 0 if doc_id is None else doc_id, *rest)


class PerfectHash:
    """A minimal perfect hash of distinct 128-bit keys (two unsigned 64-bit arrays)."""

    def __init__(self, levels: np.ndarray, words: np.ndarray):
        self.levels, self.words = levels, words  # words of each level; all bits
        self.starts = np.concatenate([[0], np.cumsum(levels)]).astype(np.int64)
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(words))]).astype(np.int64)

    @staticmethod
    def _place(h1: np.ndarray, h2: np.ndarray, level: int, bits: int) -> np.ndarray:
        return (mix64(h1 ^ mix64(h2 + np.uint64(level * 0x9E3779B97F4A7C15 % 2**64))) % np.uint64(bits)).astype(np.int64)

    @classmethod
    def build(cls, h1: np.ndarray, h2: np.ndarray, room: float = 2.0) -> PerfectHash:
        levels, words = [], []
        while len(h1):
            if len(levels) > 200:
                raise ValueError("two keys have equal hashes of 128 bits")
            n = max(1, int(np.ceil(room * len(h1) / 64)))
            at = cls._place(h1, h2, len(levels), 64 * n)
            alone = np.bincount(at, minlength=64 * n) == 1
            words.append(np.packbits(alone, bitorder="little").view("<u8"))
            levels.append(n)
            left = ~alone[at]
            h1, h2 = h1[left], h2[left]
        return cls(np.array(levels, np.int64), np.concatenate(words) if words else np.zeros(0, "<u8"))

    def slots(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        """Slot of each key; a key that was not built in gets any slot or -1."""
        out = np.full(len(h1), -1, np.int64)
        left = np.arange(len(h1))
        for level, n in enumerate(self.levels):
            at = self._place(h1[left], h2[left], level, 64 * int(n))
            word, bit = self.starts[level] + (at >> 6), (at & 63).astype(np.uint64)
            mine = self.words[word]
            hit = (mine >> bit & np.uint64(1)).astype(bool)
            below = np.bitwise_count(mine & ((np.uint64(1) << bit) - np.uint64(1)))
            out[left[hit]] = (self.before[word] + below)[hit]
            left = left[~hit]
        return out


SLOT = np.dtype([("print", "<u8"), ("shard", "<i8"), ("record", "<i8"), ("count", "<i8"), ("runs", "<i8")])


def _pack(h1: np.ndarray, h2: np.ndarray, values: np.ndarray) -> bytes:
    table = PerfectHash.build(h1, h2)
    slots = np.zeros(len(h1), SLOT)
    at = table.slots(h1, h2)
    slots[at] = values
    slots["print"][at] = h2
    return b"".join([MAGIC, struct.pack("<qqq", len(h1), len(table.levels), len(table.words)), table.levels.astype("<i8").tobytes(), table.words.tobytes(), slots.tobytes()])


def _unpack(data: bytes) -> tuple[PerfectHash, np.ndarray]:
    if data[:8] != MAGIC:
        raise ValueError("not an index file")
    n, n_levels, n_words = struct.unpack_from("<qqq", data, 8)
    at = 32 + 8 * n_levels
    table = PerfectHash(np.frombuffer(data, "<i8", n_levels, 32), np.frombuffer(data, "<u8", n_words, at))
    return table, np.frombuffer(data, SLOT, n, at + 8 * n_words)


def _store(folder: str):
    """File system and path of a folder given as path or URI."""
    from pyarrow import fs

    if re.match(r"file:/+", folder):
        folder = "/" + re.sub(r"^file:/+", "", folder)
    return fs.FileSystem.from_uri(folder)


def _key(run: Column, doc_id: str = "doc_id") -> list[Column]:
    parts = [F.col(doc_id).isNull(), F.coalesce(F.col(doc_id).cast("string"), F.lit("")), run.cast("long")]
    return [F.xxhash64(*parts).alias("h1"), F.xxhash64(F.lit(7), *parts).alias("h2")]


class TokenFiles:
    """A folder of token files: ``write`` makes it, ``lookup`` finds keys through the perfect hash, ``fetch`` reads their records."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self.shards = spark.read.parquet(f"{folder}/shards")
        self.buckets = spark.read.parquet(f"{folder}/buckets")
        one = self.buckets.agg(F.max("buckets").alias("n"), F.max("width").alias("w")).first()
        self.n_buckets, self.width = one["n"] or 1, one["w"] or 4

    @classmethod
    def write(cls, docs: DataFrame, tokenizer: str, end: int, folder: str | None = None, doc_id: str = "doc_id", text: str = "text",
              shard_bytes: int = SHARD_BYTES, bucket_keys: int = BUCKET_KEYS) -> TokenFiles:
        """Encode every row of ``docs`` and write the folder (by default a new one under the checkpoint folder).

        Null and empty texts are documents with the ``end`` id only; a null id is a key of its own and comes first; repeated rows and ids are all
        written, in an order that does not depend on partitions; other columns are ignored.  A long text is one record, whatever its size.
        An empty table gives a folder without files.
        """
        spark = docs.sparkSession
        folder = folder or f"{ensure_checkpoint_dir(spark).rstrip('/')}/tokens-{uuid.uuid4().hex}"
        body = F.coalesce(F.col(text).cast("string"), F.lit(""))
        order = ["doc_id", "t1", "t2", "row"]
        rows = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(body).alias("t1"), F.xxhash64(F.lit(7), body).alias("t2"),
                           F.monotonically_increasing_id().alias("row"), body.alias("text"))
        keys = keep(rows.select(*order, F.octet_length("text").alias("size")))
        n_shards = max(1, -(-(keys.agg(F.sum("size")).first()[0] or 0) // shard_bytes))
        firsts = keys.select(*order).repartitionByRange(n_shards, *order).groupBy(F.spark_partition_id()).agg(F.min(F.struct(*order)).alias("k"))
        bounds = sorted(_place(*r["k"]) for r in firsts.collect())  # one entry for each shard
        bounds[:1] = [(False,)]  # nothing comes before the first shard
        ids = encoded(rows, tokenizer, end, bounds)
        ranged = ids.repartitionById(len(bounds), F.col("shard")).sortWithinPartitions("shard", *order).select("doc_id", "ids", "shard")
        width = 2 if Encoder(tokenizer).kind == "<u2" else 4
        runs = keep(ranged.mapInArrow(_shard_writer(folder, width), f"doc_id {dict(keys.dtypes)['doc_id']}, shard long, tag string, record long, count long, n_ids long, edge boolean"))
        shards = runs.groupBy("shard", "tag").agg(F.sum("count").alias("n_docs"), F.sum("n_ids").alias("n_ids"))
        earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row per shard
        shards.withColumn("start", F.coalesce(F.sum("n_ids").over(earlier), F.lit(0))).write.parquet(f"{folder}/shards")
        along = Window.partitionBy("doc_id")
        edges = runs.where("edge").withColumns({"run": F.row_number().over(along.orderBy("shard")) - 1, "runs": F.count(F.lit(1)).over(along)})
        keys = runs.where("not edge").withColumns({"run": F.lit(0), "runs": F.lit(1).cast("long")}).unionByName(edges)
        n_keys = runs.count()
        n_buckets = max(1, -(-n_keys // bucket_keys))
        keys = keys.select(*_key(F.col("run")), "shard", "record", "count", F.when(F.col("run") == 0, F.col("runs")).otherwise(F.lit(0)).alias("runs"))
        made = keys.withColumn("bucket", F.pmod("h1", F.lit(n_buckets))).groupBy("bucket").applyInArrow(_bucket_writer(folder), "bucket long, tag string, n_keys long")
        made.withColumns({"buckets": F.lit(n_buckets), "width": F.lit(width)}).write.parquet(f"{folder}/buckets")
        return cls(spark, folder)

    def _probe(self, keys: DataFrame) -> DataFrame:
        """Slots of (doc_id, h1, h2); a key whose fingerprint differs is not there."""
        fields = [keys.schema["doc_id"].simpleString().split(":", 1)[1]]
        where = keys.withColumn("bucket", F.pmod("h1", F.lit(self.n_buckets))).join(self.buckets.select("bucket", "tag"), "bucket")
        return where.repartition("bucket").sortWithinPartitions("bucket").select("doc_id", "h1", "h2", "bucket", "tag").mapInArrow(
            _prober(self.folder), f"doc_id {fields[0]}, shard long, record long, count long, runs long")

    def lookup(self, keys: DataFrame, doc_id: str = "doc_id") -> DataFrame:
        """(doc_id, shard, record, count) of the runs of records of each distinct id of ``keys``; ids without a document give no row."""
        ids = keys.select(F.col(doc_id).alias("doc_id")).distinct()
        first = keep(self._probe(ids.select("doc_id", *_key(F.lit(0)))))
        more = first.where("runs > 1").select("doc_id", F.explode(F.sequence(F.lit(1).cast("long"), F.col("runs") - 1)).alias("run"))
        return first.unionByName(self._probe(more.select("doc_id", *_key(F.col("run"))))).select("doc_id", "shard", "record", "count")

    def fetch(self, entries: DataFrame) -> DataFrame:
        """(doc_id, start, n_tokens, id_bytes) of every record of entries; ``start`` counts the ids of all documents before it."""
        kind = entries.schema["doc_id"].simpleString().split(":", 1)[1]
        rows = entries.join(self.shards.select("shard", "tag", "start"), "shard").repartition("shard").sortWithinPartitions("shard", "record")
        return rows.select("doc_id", "shard", "tag", "start", "record", "count").mapInArrow(
            _reader(self.folder, self.width), f"doc_id {kind}, start long, n_tokens long, id_bytes binary")


def _shard_writer(folder: str, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, tag = None, uuid.uuid4().hex
        out = ends = None
        place = records = 0
        open_run = None  # [id, first record, records, ids]

        def rows(runs, last=False):
            edge = [r[1] == 0 or last for r in runs]
            n = len(runs)
            return pa.RecordBatch.from_arrays([
                pa.array([r[0] for r in runs], id_type), pa.array([shard] * n, pa.int64()), pa.array([tag] * n, pa.string()), pa.array([r[1] for r in runs], pa.int64()),
                pa.array([r[2] for r in runs], pa.int64()), pa.array([r[3] for r in runs], pa.int64()), pa.array(edge, pa.bool_())],
                names=["doc_id", "shard", "tag", "record", "count", "n_ids", "edge"])

        for batch in batches:
            if not batch.num_rows:
                continue
            if out is None:
                shard = batch.column(2)[0].as_py()  # a partition is one shard
                fs, path = _store(folder)
                fs.create_dir(path, recursive=True)
                out, ends = fs.open_output_stream(f"{path}/ids-{shard}-{tag}.bin"), fs.open_output_stream(f"{path}/off-{shard}-{tag}.bin")
                ends.write(struct.pack("<q", 0))
                id_type = batch.column(0).type
            ids = batch.column(1).to_pylist()
            out.write(b"".join(ids))
            sizes = np.array([len(x) // width for x in ids], np.int64)
            ends.write((place + np.cumsum(sizes)).astype("<i8").tobytes())
            done = []
            for doc_id, n in zip(batch.column(0).to_pylist(), sizes.tolist()):
                if open_run is None or open_run[0] != doc_id:
                    if open_run is not None:
                        done.append(open_run)
                    open_run = [doc_id, records, 0, 0]
                open_run[2] += 1
                open_run[3] += n
                records += 1
            place += int(sizes.sum())
            if done:
                yield rows(done)
        if out is not None:
            out.close()
            ends.close()
            yield rows([open_run], last=True)

    return run


def _bucket_writer(folder: str):
    def run(keys: pa.Table) -> pa.Table:
        keys = keys.combine_chunks()
        h1, h2 = (keys[c].to_numpy().astype(np.int64).view(np.uint64) for c in ("h1", "h2"))
        values = np.zeros(len(h1), SLOT)
        for c in ("shard", "record", "count", "runs"):
            values[c] = keys[c].to_numpy()
        bucket, tag = keys["bucket"][0].as_py(), uuid.uuid4().hex
        fs, path = _store(folder)
        with fs.open_output_stream(f"{path}/key-{bucket}-{tag}.bin") as out:
            out.write(_pack(h1, h2, values))
        return pa.table({"bucket": pa.array([bucket], pa.int64()), "tag": pa.array([tag]), "n_keys": pa.array([len(h1)], pa.int64())})

    return run


def _prober(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs = at = table = slots = None
        for batch in batches:
            if not batch.num_rows:
                continue
            if fs is None:
                fs, path = _store(folder)
            buckets = batch.column(3).to_numpy(zero_copy_only=False)
            cuts = [0, *(np.nonzero(np.diff(buckets))[0] + 1).tolist(), len(buckets)]
            for a, b in zip(cuts, cuts[1:]):
                part = batch.slice(a, b - a)
                name = (buckets[a], part.column(4)[0].as_py())
                if name != at:
                    with fs.open_input_file(f"{path}/key-{name[0]}-{name[1]}.bin") as f:
                        table, slots = _unpack(f.read())
                    at = name
                h1, h2 = (part.column(i).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64) for i in (1, 2))
                slot = table.slots(h1, h2)
                found = slot >= 0
                found[found] = slots["print"][slot[found]] == h2[found]
                hit = slots[slot[found]]
                yield pa.RecordBatch.from_arrays([part.column(0).filter(pa.array(found)), *[pa.array(np.ascontiguousarray(hit[c]), pa.int64()) for c in ("shard", "record", "count", "runs")]],
                                                 names=["doc_id", "shard", "record", "count", "runs"])

    return run


def _reader(folder: str, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs = at = ids = off = None
        kind = "<u2" if width == 2 else "<u4"
        for batch in batches:
            if not batch.num_rows:
                continue
            if fs is None:
                fs, path = _store(folder)
            columns = [c.to_pylist() for c in batch.columns]
            upto = [r + n for r, n in zip(columns[4], columns[5])]  # end of the unbroken records from each entry on
            for i in range(len(upto) - 2, -1, -1):
                if columns[1][i] == columns[1][i + 1] and upto[i] == columns[4][i + 1]:
                    upto[i] = upto[i + 1]
            out: list[tuple] = []
            size = 0
            for doc_id, shard, tag, start, record, count, last in zip(*columns, upto):
                if (shard, tag) != at:
                    if ids is not None:
                        ids.close()
                        off.close()
                    ids, off = fs.open_input_file(f"{path}/ids-{shard}-{tag}.bin"), fs.open_input_file(f"{path}/off-{shard}-{tag}.bin")
                    at, ahead, ahead_at = (shard, tag), b"", 0
                    place, first = np.zeros(0, np.int64), 0
                for r in range(record, record + count):
                    if not first <= r < first + len(place) - 1:
                        place, first = np.frombuffer(off.read_at(8 * 4097, 8 * r), "<i8"), r
                    a, b = int(place[r - first]) * width, int(place[r - first + 1]) * width
                    if not ahead_at <= a <= b <= ahead_at + len(ahead):
                        known = place[: last - first + 1]
                        near = int(known[np.searchsorted(known, (a + READ_BYTES) // width, "right") - 1]) * width
                        ahead, ahead_at = ids.read_at(max(b, near) - a, a), a
                    raw = np.frombuffer(ahead, kind, (b - a) // width, a - ahead_at).astype("<u4").tobytes()
                    out.append((doc_id, start + a // width, (b - a) // width, raw))
                    size += len(raw)
                    if size > READ_BYTES:
                        yield _records(out, batch.column(0).type)
                        out, size = [], 0
            if out:
                yield _records(out, batch.column(0).type)

    return run


def _records(out: list[tuple], id_type: pa.DataType) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (id_type, pa.int64(), pa.int64(), pa.binary()))], names=["doc_id", "start", "n_tokens", "id_bytes"])
