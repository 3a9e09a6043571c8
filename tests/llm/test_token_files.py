"""Token files against the library, and the perfect hash against a dictionary."""

from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from llm_data import SCHEMA, words
from pyspark.sql import functions as F

PATH = public_tokenizers.path("byte_bpe_50k.json")


def _library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


def _brute(rows, end=2):
    """(id, start, tokens, crc32) of rows in order of their id, without the order among equal ids."""
    library, out, start = _library(), [], 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, end]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def _read(files, docs):
    rows = files.fetch(files.lookup(docs)).withColumn("crc", F.crc32("id_bytes")).collect()
    return sorted(((r["doc_id"], r["start"], r["n_tokens"], r["crc"]) for r in rows), key=lambda r: r[1])


@pytest.mark.parametrize("seed", range(4))
def test_encoder_equals_library(seed):
    from burstframe.llm.token_files import Encoder

    rng, library, encoder = random.Random(seed), _library(), Encoder(PATH)
    parts = ["a", "don't", " ", "  ", "\n", "\t", "\r\n", "12", "½", "é", "Ω", "日本", " ", " ", "\x1c", "\x85", "᠎", "😀", "é", "!?", "'s", "Ünd", "x" * 60, "<|endoftext|>", "\x00", "\xad", "_"]
    for _ in range(400):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))
        assert np.frombuffer(encoder.encode(text), encoder.kind).tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_memory_is_bounded(monkeypatch):
    from burstframe.llm import token_files as T

    monkeypatch.setattr(T, "REMEMBERED", 50)
    encoder, library, rng = T.Encoder(PATH), _library(), random.Random(9)
    for _ in range(20):
        text = words(rng, "xx", 100)
        assert np.frombuffer(encoder.encode(text), encoder.kind).tolist() == library.encode(text, add_special_tokens=False).ids
        assert len(encoder.chunks) + len(encoder.chunks.old) <= 50


def test_word_with_mark_is_not_tokenized_again():
    from burstframe.llm.token_files import Encoder

    encoder, library, met = Encoder(PATH), _library(), []
    model = encoder.chunks.model
    encoder.chunks.model = lambda name: met.append(name) or model(name)
    texts = ["x strange añejo", "x strange, añejo. strange; strange,\nañejo! 漢字, ²,"]
    for text in texts:
        assert encoder.encode(text) == np.array(library.encode(text, add_special_tokens=False).ids, encoder.kind).tobytes()
    assert sum("strange" in n for n in met) == 1 and sum(n.endswith("ejo") for n in met if n.startswith("Ġ")) == 1


@pytest.mark.parametrize("n", [0, 1, 2, 63, 1000, 20000])
def test_perfect_hash(n):
    from burstframe.llm.token_files import SLOT, PerfectHash, _pack, _unpack

    rng = np.random.default_rng(n)
    h1, h2 = rng.integers(0, 2**64, (2, n), dtype=np.uint64)
    h1[: n // 3] = 5  # equal first halves
    table = PerfectHash.build(h1, h2)
    assert sorted(table.slots(h1, h2).tolist()) == list(range(n))
    values = np.zeros(n, SLOT)
    values["record"] = np.arange(n)
    table, slots = _unpack(_pack(h1, h2, values))
    at = table.slots(h1, h2)
    assert (slots["record"][at] == np.arange(n)).all() and (slots["print"][at] == h2).all()
    other = rng.integers(0, 2**64, (2, 500), dtype=np.uint64)
    at = table.slots(*other)
    assert (at < n).all() and not (slots["print"][at[at >= 0]] == other[1][at >= 0]).any()


def test_equal_keys_are_refused():
    from burstframe.llm.token_files import PerfectHash

    with pytest.raises(ValueError):
        PerfectHash.build(np.array([1, 1], np.uint64), np.array([2, 2], np.uint64))


@pytest.mark.parametrize("shard_bytes,bucket_keys", [(16 << 20, 200_000), (600, 7)])
def test_token_files(spark, docs, shard_bytes, bucket_keys):
    """One and many shards; one id holds a third of all rows."""
    from burstframe.llm.token_files import TokenFiles

    rng = random.Random(4)
    hot = spark.createDataFrame([(1000, words(rng, "yy", 30), None, None, None, 1, "", "") for _ in range(40)], SCHEMA)
    docs = docs.unionByName(hot)
    files = TokenFiles.write(docs, PATH, 2, shard_bytes=shard_bytes, bucket_keys=bucket_keys)
    got = _read(files, docs)
    want = _brute([(r["doc_id"], r["text"]) for r in docs.collect()])
    ends = {s + n for _, s, n, _ in got}
    assert {s for _, s, _, _ in got} - ends == {0} and len(ends) == len(got)  # no gap, no overlap
    assert [r[0] for r in got] == [r[0] for r in want]
    assert sorted((str(a), c, d) for a, _, c, d in got) == sorted((str(a), c, d) for a, _, c, d in want)
    alone = {r[0] for r in want if sum(x[0] == r[0] for x in want) == 1}
    assert [r for r in got if r[0] in alone] == [r for r in want if r[0] in alone]
    assert got == _read(TokenFiles.write(docs.repartition(3), PATH, 2, shard_bytes=shard_bytes, bucket_keys=bucket_keys), docs)
    some = spark.createDataFrame([(7,), (1000,), (7,), (-5,), (None,), (10**12,)], "doc_id long")
    assert _read(TokenFiles(spark, files.folder), some) == [r for r in got if r[0] in (7, 1000, None)]


def test_token_files_empty(spark, empty):
    from burstframe.llm.token_files import TokenFiles

    files = TokenFiles.write(empty, PATH, 2)
    assert _read(files, empty) == []
    assert _read(files, spark.createDataFrame([(1,)], "doc_id long")) == []


def test_query_on_documents(spark):
    from burstframe.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted(tuple(r) for r in QUERIES["op11_token_files"](spark, sf).collect())
    assert got == sorted(_brute(rows))
