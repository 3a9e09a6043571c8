"""Operators on single texts and lines against brute-force versions."""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
from llm_data import ASCII, WORD
from pyspark.sql import functions as F


def _texts(df):
    return [(r["doc_id"], r["text"]) for r in df.collect()]


def test_bpe_equals_the_library(spark, docs, empty):
    import public_tokenizers as P
    from tokenizers import Tokenizer

    from burstframe.llm.bpe import decode, encode, id_array

    path = P.path("word_bpe_49k.json")
    lib = Tokenizer.from_file(path)
    out = encode(docs, path)
    got = sorted((str(r["doc_id"]), r["ids"], r["decoded"], r["again"]) for r in decode(out, path, out="again").withColumn("ids", id_array(F.col("id_bytes"))).collect())
    want = []
    for i, t in _texts(docs):
        ids = lib.encode(t or "", add_special_tokens=False).ids
        text = lib.decode(ids, skip_special_tokens=False)
        want.append((str(i), ids, text, text))
    assert got == sorted(want)
    assert set(docs.columns) < set(out.columns) and encode(empty, path).count() == 0


def test_bpe_odd_characters(spark):
    import public_tokenizers as P
    from tokenizers import Tokenizer

    from burstframe.llm.bpe import PairIndexBpe

    path = P.path("word_bpe_49k.json")
    lib, mine = Tokenizer.from_file(path), PairIndexBpe(path)
    for t in ("a\x1cb\x1d", "x\x85y\xa0z", "ΑΣ Σ", "İ ǅ ẞ", "aaaaaaa aaaa", "<|startoftext|>x<|endoftext|", "1½²Ⅷ٣", "é ̈", "'s't're DON'T", "　x​z", "\x00 \x7f"):
        memory = {}
        mine.remember(set(mine.chunks(t)), memory)
        ids = np.frombuffer(b"".join(memory[c] for c in mine.chunks(t)), "<u4").tolist()
        assert ids == lib.encode(t, add_special_tokens=False).ids, t


def test_repetition(docs, empty):
    from burstframe.llm.repetition import SYMBOLS, judge

    def brute(t, least=10):
        w = WORD.findall(t)
        n = len(w)
        three = Counter(tuple(w[i : i + 3]) for i in range(n - 2))
        m, c, longest, k = [0] * n, [0] * n, 0, least
        for i in range(n - 2):
            if three[tuple(w[i : i + 3])] > 1:
                m[i] = m[i + 1] = m[i + 2] = 1
        while True:
            g = Counter(tuple(w[i : i + k]) for i in range(n - k + 1))
            at = [i for i in range(n - k + 1) if g[tuple(w[i : i + k])] > 1]
            if not at:
                break
            longest = k
            for i in at:
                c[i : i + k] = [1] * k
            k += 1
        seen, dup = set(), 0
        for line in t.split("\n"):
            if WORD.search(line):
                dup += line in seen
                seen.add(line)
        failed = n < 50 or 100 * sum(m) > 50 * n
        return n, sum(map(len, w)), sum(x in SYMBOLS for x in t), dup, sum(m), sum(c), longest, failed, not failed and sum(c) <= 0.5 * n and longest <= 0.4 * n

    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "covered_words", "longest_repeat", "base_failed", "kept")
    rows = judge(docs).collect()
    assert len(rows) == docs.count() and judge(empty).count() == 0
    for r in rows:
        assert tuple(r[c] for c in names) == brute(r["text"] or ""), r["text"]
        assert sum(s["end"] - s["start"] for s in r["repeat_spans"]) == r["covered_words"]


def test_language_id(docs, empty):
    from burstframe.llm.language_id import LanguageId

    held = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(4)) == 2
    model = LanguageId.train(docs.where(~held))
    rows = model.predict(docs).collect()
    assert len(rows) == docs.count()
    for r in rows:
        if r["text"] is None or not any(map(str.isalpha, r["text"])):
            assert (r["lang_pred"], r["score"], r["rejected"]) == ("und", 0.0, True)
        else:
            assert r["lang_pred"] in ("xx", "yy") and 0 <= r["score"] <= 1
            if r["doc_id"] is not None and r["doc_id"] < 60:
                assert r["lang_pred"] == r["lang"] and not r["rejected"]
    nothing = LanguageId.train(empty)
    assert {r["lang_pred"] for r in nothing.predict(docs).collect()} == {"und"}
    assert model.predict(empty).count() == 0


def test_language_models_keep_all_ngrams(docs):
    """What is in memory does not change the models: rarer n-grams are joined."""
    from burstframe.llm.language_id import LanguageId

    some = docs.where("doc_id IS NOT NULL AND coalesce(n_chars, 0) < 3000").dropDuplicates(["doc_id"])
    train = some.where("doc_id % 5 != 1")
    rows = []
    for n in (1_500_000, 300, 0):
        model = LanguageId.train(train, max_entries=n)
        rows.append({r["doc_id"]: r for r in model.predict(some).collect()})
        rows[-1]["limits"] = model.limits
    want = rows[0]
    for got in rows[1:]:
        assert set(got) == set(want) and all(abs(got["limits"][k] - v) < 1e-4 for k, v in want["limits"].items())
        for i in set(want) - {"limits"}:
            assert (got[i]["lang_pred"], got[i]["rejected"]) == (want[i]["lang_pred"], want[i]["rejected"])
            assert abs((got[i]["cross_entropy"] or 0) - (want[i]["cross_entropy"] or 0)) < 1e-4


def test_kneser_ney_is_a_distribution():
    import pandas as pd

    from burstframe.llm.language_id import CharacterModels, _ngram_batch

    parts = [pd.DataFrame({k: v.to_pylist() if hasattr(v, "to_pylist") else v for k, v in b.items()})
             for lang, c in (("p", Counter(["ab", "ab", "aab", "ba"])), ("q", Counter(["bb", "ab"]))) for b in _ngram_batch(lang, c, 3)]
    model = CharacterModels(pd.concat(parts), 3)
    words = [""]
    total = np.zeros(2)
    for _ in range(9):  # all words over the alphabet up to a length; what is left is the share of longer ones and other letters
        total += np.exp(model.word_scores(words)).sum(0) if words != [""] else 0
        words = [w + x for w in words for x in "ab"]
    assert (total < 1).all() and (total > 0.5).all()


def test_line_dedup(spark, docs, empty):
    from burstframe.llm.line_dedup import LineDedup, drop_frequent_lines

    def brute(df, threshold):
        def key(line):
            return line.strip(" \t\n\x0b\x0c\r").translate(ASCII)

        n = Counter(k for _, t in _texts(df) for k in {key(x) for x in (t or "").split("\n")})
        out = []
        for i, t in _texts(df):
            lines = (t or "").split("\n")
            kept = [x for x in lines if not key(x) or n[key(x)] < threshold]
            out.append((str(i), len(lines), len(lines) - len(kept), "\n".join(kept)))
        return sorted(out)

    def got(df):
        return sorted((str(r["doc_id"]), r["n_lines"], r["n_dropped"], r["text"]) for r in df.collect())

    assert got(drop_frequent_lines(docs, 3)) == brute(docs, 3)
    assert drop_frequent_lines(empty, 3).count() == 0
    part = docs.where("doc_id < 30")
    state = LineDedup(spark, 20).insert(docs)
    assert got(state.apply(docs)) == brute(docs, 20)
    state.delete(docs.where("doc_id >= 5"))  # below the threshold again
    assert got(state.apply(docs)) == sorted((i, n, 0, t) for (i, n, _, t) in [(str(i), (t or "").count("\n") + 1, 0, t or "") for i, t in _texts(docs)])
    state.insert(docs.where("doc_id >= 5 AND doc_id < 30"))
    assert got(state.apply(part)) == brute(part, 20)


def test_cuckoo_filter():
    from burstframe.llm.line_dedup import Cuckoo

    keys = np.random.default_rng(0).integers(-(2**62), 2**62, 50_000)
    c = Cuckoo(len(keys))
    c.insert(keys)
    c = Cuckoo.from_bytes(c.to_bytes())
    assert c.contains(keys).all() and c.contains(keys + 1).mean() < 0.01
    c.delete(keys[:20_000])
    assert c.contains(keys[20_000:]).all() and c.contains(keys[:20_000]).mean() < 0.01


def test_lm_scores(docs, empty, monkeypatch):
    import math

    import public_tokenizers as P

    from burstframe.llm import lm_scoring as S

    monkeypatch.setattr(S, "TOP", 50)
    path = P.path("byte_bpe_50k.tiktoken")
    held = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(5)) == 1
    rows = S.score(docs, ~held, path).collect()
    tokens = [[*WORD.findall((t or "").translate(ASCII)), None] for _, t in _texts(docs)]
    ids = [i for i, _ in _texts(docs)]
    c = Counter(x for i, w in zip(ids, tokens) if zlib.crc32(b"" if i is None else str(i).encode()) % 5 != 1 for x in w)
    total, kinds = sum(c.values()), len(c)
    want = sorted((len(w), sum(c[x] > 0 for x in w), total, round(sum(math.log10((c[x] + 0.5) / (total + 0.5 * (kinds + 1))) for x in w), 6)) for w in tokens)
    assert sorted((r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in rows) == want
    assert all(r["score"] < 0 for r in rows)
    assert S.score(empty, ~held, path).count() == 0


def test_rare_word_beginnings_keep_their_counts(docs, monkeypatch):
    """Beginnings beyond those in memory meet their counts in a join: the scores do not depend on how many are in memory."""
    import public_tokenizers

    from burstframe.llm import lm_scoring as S

    path, train = public_tokenizers.path("byte_bpe_50k.tiktoken"), F.coalesce(F.col("doc_id"), F.lit(0)) % 3 != 1
    some = docs.where("coalesce(n_chars, 0) < 3000").coalesce(1)
    rows = []
    for n in (400_000, 40, 5):
        monkeypatch.setattr(S, "NODES", n)
        rows.append({(r["doc_id"], r["n_tokens"], round(r["base_score"], 6)): r["score"] for r in S.score(some, train, path).collect()})
    assert rows[0] and all(set(r) == set(rows[0]) for r in rows)
    assert all(abs(r[k] - rows[0][k]) < 1e-2 + 1e-4 * abs(v) for r in rows[1:] for k, v in rows[0].items())


def test_all_training_texts_reach_the_model(spark, monkeypatch):
    """At any size, the statistics of kinds and the training of the attention take every text."""
    import public_tokenizers

    from burstframe.llm import lm_scoring as S

    seen, made = [], []
    init, fit = S.Inner.__init__, S.fit
    monkeypatch.setattr(S.Inner, "__init__", lambda self, counts, head, by_kind: (seen.append((counts, by_kind)), init(self, counts, head, by_kind))[1])
    monkeypatch.setattr(S, "fit", lambda *a: (made.append(fit(*a)), made[-1])[1])
    texts = [" ".join(f"{a} walks to {b}" for b in "alpha beta gamma delta".split() for _ in range(25)) for a in "one two three four five".split()] * 80
    train = spark.createDataFrame([(t,) for t in texts], "text string").repartition(4)
    assert sum(len(t.split()) for t in texts) > 100_000
    S.score(train, F.lit(True), public_tokenizers.path("byte_bpe_50k.tiktoken"))
    (counts, by_kind), = seen
    assert by_kind.sum() == counts.sum() - len(texts)
    assert made[0][0].trained == counts.sum()


def test_attention_gradients_and_windows():
    from burstframe.llm import lm_scoring as S

    rng = np.random.default_rng(0)
    model = S.Attention(50)
    at = np.array([0, 5, 40, 41])
    rows, first, place = S.windows(rng.integers(0, 49, 41), at, 49)
    assert sorted(place[place >= 0].tolist()) == list(range(41))  # each once
    target, valid = rng.integers(0, S.CLASSES, place.shape), place >= 0
    g, loss = model.gradients(rows, first, target, valid)
    for name in ("wq", "wk", "wv", "w1", "w2", "embed", "place"):
        i = np.unravel_index(np.abs(g[name]).argmax(), g[name].shape)
        model.p[name][i] += 0.01
        up = model.gradients(rows, first, target, valid)[1]
        model.p[name][i] -= 0.02
        down = model.gradients(rows, first, target, valid)[1]
        model.p[name][i] += 0.01
        assert abs((up - down) / 0.02 - g[name][i]) < 0.02 * abs(g[name][i]) + 1e-3, name
    logp, _ = model.forward(rows, first)
    one, heads = model.probabilities(rows, first, target)
    assert np.allclose(one, np.exp(np.take_along_axis(logp, target[..., None], -1))[..., 0].ravel(), atol=1e-4)
    changed = rows.copy()
    changed[:, -1] = 3  # a later subword changes nothing before it
    assert np.allclose(model.forward(changed, first)[0][:, :-1], logp[:, :-1], atol=1e-5)


def test_bpe_memory_is_bounded(monkeypatch):
    """Two halves, old chunks promoted, long chunks not remembered; ids equal the library throughout."""
    import random

    import public_tokenizers as P
    from tokenizers import Tokenizer

    from burstframe.llm import bpe as B

    monkeypatch.setattr(B, "REMEMBERED", 60)
    path = P.path("word_bpe_49k.json")
    lib, mine, memory, rng = Tokenizer.from_file(path), B.PairIndexBpe(path), B.Memory(), random.Random(3)
    words = ["".join(rng.choices("abcdeé,.1", k=rng.randint(1, 6))) for _ in range(300)]
    for _ in range(60):
        texts = [" ".join(rng.choices(words, k=5)), "z" * 70 + " a", ""]
        got = memory.encode(mine, texts)
        assert [np.frombuffer(g, "<u4").tolist() for g in got] == [lib.encode(t, add_special_tokens=False).ids for t in texts]
        assert len(memory.young) <= 30 + 20 and len(memory.old) <= 50 and not any(len(c) > B.LONGEST for c in memory.young)


def test_bpe_arrays(spark, docs):
    import public_tokenizers as P

    from burstframe.llm.bpe import encode

    for r in encode(docs, P.path("word_bpe_49k.json"), arrays=True).collect():
        assert r["ids"] == np.frombuffer(r["id_bytes"], "<i4").tolist() and r["n_tokens"] == len(r["ids"])


def test_ngram_counting_is_bounded(spark, monkeypatch):
    """Words of all languages together are bounded, and cut into n-grams in small blocks; each block's counts are summed before they leave."""
    from burstframe.llm import language_id as L

    counts = Counter({"".join(chr(97 + (i * j) % 26) for j in range(1, 9)): i + 1 for i in range(500)})
    cut, grams = [], L.grams
    monkeypatch.setattr(L, "grams", lambda words, order: (cut.append(sum(map(len, words))), grams(words, order))[1])
    whole = list(L._ngram_batch("x", counts, 3))
    monkeypatch.setattr(L, "CHARACTERS", 100)
    cut.clear()
    parts = list(L._ngram_batch("x", counts, 3))
    assert max(cut) <= 100 and [p["k"].tolist() for p in parts] == [w["k"].tolist() for w in whole]
    assert all((p[c] == w[c]).all() for p, w in zip(parts, whole) for c in ("n", "x", "s", "b", "c"))

    rows = [(lang, f"{lang}a{i} b{i % 7} c") for i in range(60) for lang in ("aa", "bb", "cc")]
    docs = spark.createDataFrame([(a, "".join(chr(97 + int(c)) if c.isdigit() else c for c in t)) for a, t in rows], "lang string, text string").coalesce(1)
    want = sorted(map(tuple, L.ngram_counts(docs, "lang", "text", 3).collect()))
    monkeypatch.setattr(L, "WORDS", 20)
    assert sorted(map(tuple, L.ngram_counts(docs, "lang", "text", 3).collect())) == want


def test_words_encoded_together():
    """Many words as one text give the subwords of each by itself, also where words hold other white space."""
    import random

    import public_tokenizers

    from burstframe.llm import lm_scoring as S

    subwords, rng = S.Subwords.read(public_tokenizers.path("byte_bpe_50k.tiktoken")), random.Random(2)
    plain = ["".join(rng.choices("abé'sx1.-日_", k=rng.randint(1, 7))).encode() for _ in range(1500)]
    odd = ["".join(rng.choices("a's\xa0\x85\x1c　", k=rng.randint(1, 4))).encode() for _ in range(300)]
    for words in (plain, [*odd, b"\xff", b"'s"], [w for pair in zip(plain, odd) for w in pair], []):
        assert subwords.encode(words) == [c for w in words for c in subwords.encode([w])]
        assert [b"".join(subwords._encoding.decode_single_token_bytes(i) for i in c) for c in subwords.encode(words)] == [
            b" " + w.decode("utf-8", "replace").encode() for w in words]


def test_scoring_deletes_its_tables(spark, docs, monkeypatch):
    """Counts, beginnings and histograms go before the result is read; it needs three small tables."""
    import os

    import public_tokenizers

    from burstframe.llm import lm_scoring as S
    from burstframe.operators import reuse

    monkeypatch.setattr(S, "NODES", 40)
    made = []
    monkeypatch.setattr(S, "keep", lambda df, *a: (made.append(reuse.keep(df, *a)), made[-1])[1])
    out = S.score(docs.limit(200), F.lit(True), public_tokenizers.path("byte_bpe_50k.tiktoken"))
    assert sum(os.path.isdir(t.kept_at.removeprefix("file:")) for t in made) == 3 and len(made) == 6
    assert out.count() == docs.limit(200).count()
