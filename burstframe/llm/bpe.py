"""BPE encoding and decoding with a pair occurrence index.

The texts of a batch are normalised and cut into words; the words that the worker has not met yet are encoded together.  All their
symbols lie in one linked array, and an index maps each mergeable pair to every position where it stands.  The active
ranks are taken in ascending order: all positions of a pair are merged at once, and the lists of the pairs that appear beside
them are extended.  A merge can only make pairs of higher rank (checked when the vocabulary is read), so one ascending sweep is exact.

Files follow the JSON of word-level BPE: NFC, white space, lower case; words with an end mark; special tokens are found in the raw text.
The vocabulary is read once on the driver and broadcast: its size is that of the file, whatever the data.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from burstframe.llm.common import blocks

#: Chunks whose codes a worker remembers (those not met lately go first), and the longest chunk that it remembers: together some 80 MB at most.
REMEMBERED, LONGEST = 400_000, 64
#: Characters of text that are encoded and handed on at once (a longer text by itself), so that results do not pile up in the worker.
AT_ONCE = 1 << 20
#: Control characters that Python's split takes for white space but the tokenizer does not.
NOT_WHITE = ("\x1c", "\x1d", "\x1e", "\x1f")
SPACES = re.compile(r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")
PAIR = 20  # bits of an id in a pair's key


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: itself where it is printable, else the next ones from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


class PairIndexBpe:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, suffix = spec["model"]["vocab"], spec["model"]["end_of_word_suffix"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.pieces = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        names = {i: s for s, i in vocab.items()} | {i: s for s, i in self.special.items()}
        self.names = [names.get(i, "") for i in range(max(names, default=-1) + 1)]
        symbols = byte_symbols()
        self.inner = [vocab[s] for s in symbols]
        self.last = [vocab[s + suffix] for s in symbols]
        self.merges = []  # by rank: left, right, merged
        self.ranks: dict[int, int] = {}
        made: dict[int, int] = {}
        for rank, (a, b) in enumerate(spec["model"]["merges"]):
            left, right, merged = vocab[a], vocab[b], vocab[a + b]
            if max(made.get(left, -1), made.get(right, -1)) >= rank:
                raise ValueError("a merge uses a symbol that a later merge makes")
            made.setdefault(merged, rank)
            self.merges.append((left, right, merged))
            self.ranks[left << PAIR | right] = rank

    def normal(self, text: str) -> str:
        if not text.isascii():
            text = unicodedata.normalize("NFC", text)
            if "Σ" in text:
                text = text.replace("Σ", "σ")  # lower-cased by itself, not by its place in the word
        return text.lower()

    def chunks(self, text: str) -> list[str]:
        """Parts without white space, lower-cased; special tokens whole."""
        if "<|" in text and (found := [s for s in self.special if s in text]):
            parts = re.split("(" + "|".join(map(re.escape, sorted(found, key=len, reverse=True))) + ")", text)
            return [c for i, part in enumerate(parts) for c in ([part] if i % 2 else self._split(self.normal(part)))]
        return self._split(self.normal(text))

    def _split(self, text: str) -> list[str]:
        if any(c in text for c in NOT_WHITE):
            return [c for c in SPACES.split(text) if c]
        return text.split()

    def encode_words(self, words: list[str]) -> list[list[int]]:
        """Ids of each word, all words in one sweep over the ranks."""
        inner, last, ranks = self.inner, self.last, self.ranks
        sym: list[int] = []
        starts = []
        for w in words:
            raw = w.encode()
            starts.append(len(sym))
            sym.extend([inner[b] for b in raw[:-1]])
            sym.append(last[raw[-1]])
        n = len(sym)
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        for s in starts:
            before[s] = -1
            if s:
                after[s - 1] = -1
        if n:
            after[n - 1] = -1
        where: dict[int, list[int]] = {}
        for i in range(n - 1):
            if after[i] == i + 1 and (r := ranks.get(sym[i] << PAIR | sym[i + 1])) is not None:
                where.setdefault(r, []).append(i)
        heap = list(where)
        heapq.heapify(heap)
        while heap:
            rank = heapq.heappop(heap)
            left, right, merged = self.merges[rank]
            places = where.pop(rank)
            if left == right:
                places.sort()  # overlapping runs merge from the left
            for i in places:
                j = after[i]
                if sym[i] != left or j < 0 or sym[j] != right:
                    continue
                sym[i], sym[j] = merged, -1
                k = after[i] = after[j]
                if k >= 0:
                    before[k] = i
                    if (r := ranks.get(merged << PAIR | sym[k])) is not None:
                        if r not in where:
                            where[r] = []
                            heapq.heappush(heap, r)
                        where[r].append(i)
                if (p := before[i]) >= 0 and (r := ranks.get(sym[p] << PAIR | merged)) is not None:
                    if r not in where:
                        where[r] = []
                        heapq.heappush(heap, r)
                    where[r].append(p)
        ends = [*starts[1:], n]
        return [[x for x in sym[a:b] if x >= 0] for a, b in zip(starts, ends)]

    def remember(self, chunks: set[str], memory: dict) -> None:
        """Put the little-endian ids of new chunks into ``memory``."""
        parts = {}
        for c in chunks:
            parts[c] = None if c in self.special else [c] if c.isalpha() else self.pieces.findall(c)
        words = list({w for p in parts.values() if p for w in p})
        codes = dict(zip(words, self.encode_words(words)))
        for c, p in parts.items():
            memory[c] = np.array([self.special[c]] if p is None else [x for w in p for x in codes[w]], "<u4").tobytes()

    def decode(self, ids: np.ndarray) -> str:
        """Names of the ids joined by spaces, as there is no decoder in the file; special tokens are kept."""
        return " ".join(map(self.names.__getitem__, ids.tolist()))


class Memory:
    """Ids of the chunks met lately, in two halves: the older half goes when the younger is full."""

    def __init__(self):
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def encode(self, bpe: PairIndexBpe, texts: list[str]) -> list[bytes]:
        if len(self.young) > REMEMBERED // 2:
            self.old, self.young = self.young, {}
        cut = [bpe.chunks(t) for t in texts]
        new = set().union(*cut).difference(self.young)
        for c in [c for c in new if c in self.old]:
            self.young[c] = self.old.pop(c)
            new.remove(c)
        if new:
            bpe.remember(new, self.young)
        ids = [b"".join(map(self.young.__getitem__, chunks)) for chunks in cut]
        for c in new:
            if len(c) > LONGEST:
                del self.young[c]
        return ids


_MEMORY: dict[str, Memory] = {}


def encode(docs: DataFrame, path: str, text: str = "text", arrays: bool = False) -> DataFrame:
    """Documents with ``n_tokens``, ``id_bytes`` (ids as little-endian unsigned 32-bit integers) and ``decoded``, the text of these ids.

    Null text counts as empty and has no tokens; every row is encoded by itself, so repeats give equal results.  Special tokens are not added,
    but their strings in a text are their ids.  Very long texts and chunks are encoded whole; chunks over ``LONGEST`` characters are not remembered.
    An empty table gives an empty result.  Input columns with the names of results are replaced.  ``arrays`` adds ``ids`` as an array.
    """
    made = ("n_tokens", "id_bytes", "decoded", *(["ids"] if arrays else []))
    shared = docs.sparkSession.sparkContext.broadcast(PairIndexBpe(path))

    @F.pandas_udf("n_tokens long, id_bytes binary, decoded string" + (", ids array<int>" if arrays else ""))
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        bpe, memory = shared.value, _MEMORY.setdefault(path, Memory())
        for batch in batches:
            texts = [t or "" for t in batch]
            for a, b in blocks([len(t) for t in texts], AT_ONCE):
                raw = memory.encode(bpe, texts[a:b])
                out = {"n_tokens": [len(x) // 4 for x in raw], "id_bytes": raw, "decoded": [bpe.decode(np.frombuffer(x, "<u4")) for x in raw]}
                if arrays:
                    out["ids"] = [np.frombuffer(x, "<i4") for x in raw]
                yield pd.DataFrame(out)

    keep = [c for c in docs.columns if c not in made or c == text]
    rows = docs.select(*keep, run(F.col(text).cast("string")).alias("__bpe"))
    return rows.select(*[c for c in keep if c not in made], *[F.col(f"__bpe.{c}").alias(c) for c in made])


def id_array(id_bytes: Column) -> Column:
    """Ids of ``id_bytes`` as an array."""

    @F.pandas_udf("array<int>")
    def run(column: pd.Series) -> pd.Series:
        return pd.Series([None if x is None else np.frombuffer(x, "<i4") for x in column], dtype=object)

    return run(id_bytes)


def decode(rows: DataFrame, path: str, ids: str = "id_bytes", out: str = "decoded") -> DataFrame:
    """Rows with the text of their ids (a null gives a null)."""
    shared = rows.sparkSession.sparkContext.broadcast(PairIndexBpe(path))

    @F.pandas_udf("string")
    def run(column: pd.Series) -> pd.Series:
        return pd.Series([None if x is None else shared.value.decode(np.frombuffer(x, "<u4")) for x in column], dtype=object)

    return rows.withColumn(out, run(F.col(ids)))
