"""Language ID by interpolated Kneser-Ney character models, one per language, in sorted hash arrays.

A model predicts the characters of a word and its end from up to ``order - 1`` characters before them in the word, so a word has the
same probability wherever it stands and each distinct word of a block is scored once.  N-gram counts cover all training
texts: distinct words are counted in the task and their n-grams are summed by Spark.  Up to ``max_entries`` distinct n-grams reach the driver whole;
of a larger table Spark computes continuation counts, discounts and probabilities, the most frequent entries are broadcast, and words that need others meet
them in a join (``WholeModels``), so no n-gram is lost.  Per order the models share one sorted array of 64-bit n-gram hashes with a column of
log probabilities for each language (n-grams that a language lacks hold its backed-off value), and one of contexts with back-off weights.

The language with the lowest cross-entropy per predicted character wins.  A share of the training texts is kept out of the counts
to calibrate rejection: they show the cross-entropy of a language's own texts and of texts in the other languages, and a text goes when its lowest
cross-entropy lies most of the way from the one to the other, so that it resembles no learned language.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from burstframe.llm.common import arrow_map, blocks, mix64
from burstframe.operators.reuse import keep

LETTERS = re.compile(r"[^\W\d_]+")
BASE = 0x9E3779B97F4A7C15
#: Distinct words, of all languages together, that a task counts before it hands over their n-grams, and that a worker remembers scores of;
#: characters of words that are cut into n-grams at once.
WORDS, CHARACTERS = 300_000, 1 << 18
#: One text in so many calibrates.
CALIBRATE = 32
#: Rejection begins this far on the way from a language's own texts to those of the others, plus this many nats over the root of the length.
WAY, SLACK = 0.75, 4.0
NGRAMS = "lang string, n int, k long, x long, s long, b boolean, c long"


def letter_words(text: str) -> list[str]:
    return LETTERS.findall(text.lower())


def grams(words: list[str], order: int):
    """Per order n: hash, context hash, suffix hash, whether it begins the word, index of its word, for each predicted character."""
    codes = np.frombuffer((" " + "  ".join(words) + " ").encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64) + np.uint64(1)
    size = np.fromiter(map(len, words), np.int64, len(words)) + 2
    start = np.cumsum(size) - size
    word = np.repeat(np.arange(len(words)), size)
    place = np.arange(len(codes)) - start[word]
    raw = np.zeros(len(codes), np.uint64)
    power = 1
    for n in range(1, order + 1):
        at = np.flatnonzero(place >= max(1, n - 1))
        lower = raw
        raw = raw.copy()
        ok = np.arange(n - 1, len(codes))
        raw[ok] = lower[ok] + codes[ok - (n - 1)] * np.uint64(power)
        power = power * BASE % (1 << 64)
        yield n, mix64(raw[at]), mix64(lower[at - 1]), mix64(lower[at]), place[at] == n - 1, word[at], at


def _ngram_batch(lang: str, counts: Counter, order: int) -> Iterator[dict]:
    """N-grams of the words; so many words are cut at once that their arrays stay small, and equal n-grams are summed before the next ones."""
    words, whole = list(counts), {}
    for a, b in blocks([len(w) + 2 for w in words], CHARACTERS):
        times = np.fromiter((counts[w] for w in words[a:b]), np.int64, b - a)
        for n, *columns, word, _ in grams(words[a:b], order):
            part = _summed(*columns, times[word])
            whole[n] = _summed(*map(np.concatenate, zip(whole[n], part))) if n in whole else part
    for n, (k, x, s, first, c) in whole.items():
        yield {"lang": pa.array([lang] * len(k), pa.string()), "n": np.full(len(k), n, np.int32), "k": k.view(np.int64), "x": x.view(np.int64),
               "s": s.view(np.int64), "b": first, "c": c}


def _summed(k: np.ndarray, x: np.ndarray, s: np.ndarray, b: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, ...]:
    """Each n-gram once with the sum of its counts."""
    keys, first, inverse = np.unique(k, return_index=True, return_inverse=True)
    return keys, x[first], s[first], b[first], np.bincount(inverse, weights=c, minlength=len(keys)).astype(np.int64)


def ngram_counts(docs: DataFrame, lang: str, text: str, order: int) -> DataFrame:
    """Counts of all n-grams of all texts, by language."""

    def run(batches):
        kept: dict[str, Counter] = {}
        for batch in batches:
            langs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for name, t in zip(langs, texts):
                kept.setdefault(name, Counter()).update(letter_words(t or ""))
            if sum(map(len, kept.values())) > WORDS:
                while kept:
                    name, counts = kept.popitem()
                    yield from (pa.RecordBatch.from_pydict(x) for x in _ngram_batch(name, counts, order))
        for name, counts in kept.items():
            if counts:
                yield from (pa.RecordBatch.from_pydict(x) for x in _ngram_batch(name, counts, order))

    rows = docs.select(F.col(lang), F.col(text)).mapInArrow(run, NGRAMS)
    return rows.groupBy("lang", "n", "k").agg(F.first("x").alias("x"), F.first("s").alias("s"), F.first("b").alias("b"), F.sum("c").alias("c"))


def _find(sorted_keys: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.minimum(np.searchsorted(sorted_keys, keys), max(0, len(sorted_keys) - 1))
    return at, (sorted_keys[at] == keys) if len(sorted_keys) else np.zeros(len(keys), bool)


class CharacterModels:
    """Models of all languages; ``keys[n]`` and ``contexts[n]`` are the sorted hashes of order n, with a column per language beside them."""

    def __init__(self, table: pd.DataFrame, order: int):
        self.order = order
        self.langs = sorted(table["lang"].unique().tolist())
        self.keys, self.logp, self.contexts, self.back = {}, {}, {}, {}
        code = {name: i for i, name in enumerate(self.langs)}
        by = {n: part for n, part in table.groupby("n")}
        prob = None
        for n in range(1, order + 1):
            part = by.get(n, table.iloc[:0])
            k, x, s = (part[c].to_numpy(np.int64).view(np.uint64) for c in "kxs")
            lang = part["lang"].map(code).to_numpy(np.int64)
            count = part["c"].to_numpy(np.float64)
            if n < order:  # how many characters come before it, unless it begins a word
                up = by.get(n + 1, table.iloc[:0])
                pairs, times = np.unique(np.stack([up["lang"].map(code).to_numpy(np.int64).astype(np.uint64), up["s"].to_numpy(np.int64).view(np.uint64)]), axis=1, return_counts=True)
                seen = dict(zip(map(tuple, pairs.T.tolist()), times.tolist()))
                left = np.array([seen.get((a, b), 0) for a, b in zip(lang.tolist(), k.tolist())], np.float64)
                count = np.where(part["b"].to_numpy(bool), count, np.maximum(left, 1))
            keys, first = np.unique(k, return_index=True)
            contexts, where = np.unique(x, return_inverse=True)
            shape = (len(contexts), len(self.langs))
            total, kinds = np.zeros(shape), np.zeros(shape)
            np.add.at(total, (where, lang), count)
            np.add.at(kinds, (where, lang), 1)
            ones, twos = (np.array([((count == v) & (lang == i)).sum() for i in range(len(self.langs))], np.float64) for v in (1, 2))
            discount = np.clip(np.where(ones > 0, ones / np.maximum(ones + 2 * twos, 1), 0.5), 0.1, 0.95)
            back = np.where(total > 0, discount * kinds / np.maximum(total, 1e-300), 1.0)
            own = np.zeros((len(keys), len(self.langs)))
            own[np.searchsorted(keys, k), lang] = np.maximum(count - discount[lang], 0) / total[where, lang]
            weight = back[np.searchsorted(contexts, x[first])] if len(keys) else np.ones((0, len(self.langs)))
            if n == 1:
                self.floor = (back[0] if len(back) else np.ones(len(self.langs))) / (len(keys) + 1)
                p = own + self.floor
            else:
                at, ok = _find(self.keys[n - 1], s[first])
                p = own + weight * (np.where(ok[:, None], prob[at], self.floor) if len(prob) else self.floor)
            prob = p
            self.keys[n], self.logp[n] = keys, np.log(p).astype(np.float32)
            self.contexts[n], self.back[n] = contexts, np.log(back).astype(np.float32)
        self.floor = np.log(self.floor).astype(np.float32)

    def word_scores(self, words: list[str]) -> np.ndarray:
        """Log probability of each word and its end in each language."""
        found = list(grams(words, self.order))
        n_at = found[0][6]
        out = np.zeros((int(n_at[-1]) + 1, len(self.langs)), np.float32)
        open_ = np.ones(len(out), bool)
        for n, k, x, _, _, _, at in reversed(found):
            todo = open_[at]
            at, k, x = at[todo], k[todo], x[todo]
            i, ok = _find(self.keys[n], k)
            out[at[ok]] += self.logp[n][i[ok]]
            open_[at[ok]] = False
            at, x = at[~ok], x[~ok]
            if n == 1:
                out[at] += self.floor
            elif len(at):
                i, ok = _find(self.contexts[n], x)
                out[at[ok]] += self.back[n][i[ok]]
        size = np.fromiter(map(len, words), np.int64, len(words)) + 2
        return np.add.reduceat(out, np.cumsum(size) - size, axis=0)


def probabilities(table: DataFrame, order: int) -> DataFrame:
    """Written table (n, context, key, v, weight) of all n-grams and contexts of a count table.

    ``v``: (language, discounted probability of the n-gram) or, of a context, (language, back-off weight).
    """
    left = table.where("n > 1").groupBy("lang", (F.col("n") - 1).alias("n"), F.col("s").alias("k")).agg(F.count("*").alias("left"))
    count = F.when((F.col("n") < order) & ~F.col("b"), F.coalesce("left", F.lit(1))).otherwise(F.col("c")).cast("double")
    t = keep(table.join(left, ["lang", "n", "k"], "left").select("lang", "n", "k", "x", "c", count.alias("count")))
    ones, twos = (F.count(F.when(F.col("count") == v, 1)) for v in (1, 2))
    share = F.when(ones > 0, ones / F.greatest(ones + 2 * twos, F.lit(1))).otherwise(0.5)
    discounts = t.groupBy("lang", "n").agg(F.greatest(F.lit(0.1), F.least(F.lit(0.95), share)).alias("d"))
    contexts = t.groupBy("lang", "n", "x").agg(F.sum("count").alias("total"), F.count("*").alias("kinds")).join(discounts, ["lang", "n"])
    own = t.join(contexts, ["lang", "n", "x"]).select("lang", "n", F.lit(False).alias("context"), F.col("k").alias("key"),
                                                      (F.greatest(F.col("count") - F.col("d"), F.lit(0.0)) / F.col("total")).alias("p"), F.col("c").cast("double").alias("w"))
    back = contexts.select("lang", "n", F.lit(True).alias("context"), F.col("x").alias("key"), (F.col("d") * F.col("kinds") / F.col("total")).alias("p"), F.col("total").alias("w"))
    return keep(own.unionAll(back).groupBy("n", "context", "key").agg(F.collect_list(F.struct("lang", "p")).alias("v"), F.sum("w").alias("weight")))


class WholeModels:
    """Models that are too large for memory: the most frequent entries in sorted hash arrays, all of them in the written ``table``."""

    def __init__(self, top: pd.DataFrame, langs: list[str], unigrams: int, order: int):
        self.langs, self.unigrams, self.order = langs, unigrams, order
        self.code = {name: i for i, name in enumerate(langs)}
        self.keys, self.values = {}, {}
        for n in range(1, order + 1):
            for context in (False, True):
                part = top[(top["n"] == n) & (top["context"] == context)]
                self.keys[n, context], at = np.unique(part["key"].to_numpy(np.int64).view(np.uint64), return_inverse=True)
                self.values[n, context] = np.full((len(self.keys[n, context]), len(langs)), 1.0 if context else 0.0)
                self.values[n, context][at, part["lang"].map(self.code).to_numpy(np.int64)] = part["p"].to_numpy(np.float64)

    def _row(self, v, context: bool) -> np.ndarray:
        out = np.full(len(self.langs), 1.0 if context else 0.0)
        for lang, p in v:
            out[self.code[lang]] = p
        return out

    def _value(self, n: int, context: bool, keys: np.ndarray, more: dict | None) -> tuple[np.ndarray, np.ndarray]:
        at, ok = _find(self.keys[n, context], keys)
        out = np.full((len(keys), len(self.langs)), 1.0 if context else 0.0)
        out[ok] = self.values[n, context][at[ok]]
        if more is not None:
            for i in np.flatnonzero(~ok):
                if (v := more.get((n, context, int(keys[i])))) is not None:
                    out[i] = self._row(v, context)
        return out, ok

    def word_scores(self, words: list[str], more: dict | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Log probability of each word and its end in each language; whether all that it needs is in memory (or in ``more``)."""
        p = known = places = word_of = None
        for n, k, x, _, _, word, at in grams(words, self.order):
            if n == 1:
                size = int(at[-1]) + 1
                p, known, places, word_of = np.full((size, len(self.langs)), 1 / (self.unigrams + 1)), np.ones(size, bool), at, word
            own, ok = self._value(n, False, k, more)
            back, found = self._value(n, True, x, more)
            p[at] = own + back * p[at]
            known[at] &= ok & found
        out = np.zeros((len(words), len(self.langs)))
        np.add.at(out, word_of, np.log(p[places]))
        return out, np.bincount(word_of[~known[places]], minlength=len(words)) == 0

    def missing(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(index of the word, n, context, key) of what is not in memory."""
        parts = []
        for n, k, x, _, _, word, _ in grams(words, self.order):
            for context, keys in ((False, k), (True, x)):
                gone = ~_find(self.keys[n, context], keys)[1]
                parts.append((word[gone], np.full(gone.sum(), n, np.int32), np.full(gone.sum(), context), keys[gone].view(np.int64)))
        return tuple(np.concatenate(c) for c in zip(*parts))


def _verdict(langs: list[str], n: int, log: np.ndarray):
    """(best, n, h, score, each) of a text with ``n`` predicted characters."""
    if not n:
        return "und", 0, None, 0.0, None
    h = -log / n
    best = int(np.argmin(h))
    return langs[best], n, float(h[best]), float(1 / np.exp(-10 * (h - h[best])).sum()), dict(zip(langs, h.tolist()))


VERDICT = "best string, n long, h double, score double, each map<string,double>"
_MEMORY: dict = {}


class LanguageId:
    """Fitted models with the limits of rejection."""

    def __init__(self, spark, models: CharacterModels | WholeModels | None, limits: dict[str, float], table: DataFrame | None = None):
        self.models, self.limits, self.table = models, limits, table
        self.shared = spark.sparkContext.broadcast(models)

    @classmethod
    def train(cls, docs: DataFrame, lang: str = "lang", text: str = "text", order: int = 5, max_entries: int = 1_500_000) -> LanguageId:
        """Fit on the labelled rows (null labels and null texts teach nothing).

        ``max_entries`` bounds what is in memory, not the models: of a larger table the rarer entries stay in Spark and are joined.
        """
        rows = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("text"))
        aside = F.pmod(F.xxhash64("text"), F.lit(CALIBRATE)) == 0
        table = keep(ngram_counts(rows.where(~aside), "lang", "text", order))
        if table.count() > max_entries:
            langs = sorted(r["lang"] for r in table.select("lang").distinct().collect())
            unigrams = table.where("n = 1").select("k").distinct().count()
            whole = probabilities(table, order)
            sizes = whole.groupBy(F.least(F.floor("weight"), F.lit(1000)).alias("c")).count().orderBy("c").collect()
            left, least = sum(r["count"] for r in sizes), 0
            for r in sizes:
                if left <= max_entries:
                    break
                left, least = left - r["count"], r["c"] + 1
            top = whole.where(F.floor("weight") >= least if left else F.lit(False)).select("n", "context", "key", F.explode("v").alias("v")).select("n", "context", "key", "v.*").toArrow().to_pandas()
            fitted = cls(docs.sparkSession, WholeModels(top, langs, unigrams, order), {}, whole)
        else:
            frame = table.toArrow().to_pandas()
            if not len(frame):
                return cls(docs.sparkSession, None, {})
            fitted, unigrams = cls(docs.sparkSession, CharacterModels(frame, order), {}), frame.loc[frame["n"] == 1, "k"].nunique()
        held = fitted._scored(rows.where(aside), "text").where("__lid.n > 0").select("lang", F.col("__lid.n").alias("n"), F.explode("__lid.each").alias("model", "h"))
        own = F.col("lang") == F.col("model")

        def mean(which: Column) -> Column:
            return F.sum(F.when(which, F.col("h") * F.col("n"))) / F.sum(F.when(which, F.col("n")))

        levels = held.groupBy("model").agg(mean(own).alias("own"), mean(~own).alias("other")).collect()
        chance = float(np.log(unigrams + 1))  # with one language only: characters drawn at random
        fitted.limits = {r["model"]: r["own"] + WAY * ((chance if r["other"] is None else r["other"]) - r["own"]) for r in levels if r["own"] is not None}
        return fitted

    def _scored(self, rows: DataFrame, text: str) -> DataFrame:
        if self.table is not None:
            return self._joined(rows, text)
        shared, tag = self.shared, id(self)

        @F.pandas_udf(VERDICT)
        def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
            models = shared.value
            langs = models.langs
            for old in [t for t in _MEMORY if t != tag]:
                del _MEMORY[old]
            index, scores = _MEMORY.setdefault(tag, [{}, np.zeros((0, len(langs)), np.float32)])
            for batch in batches:
                texts = [t or "" for t in batch]
                out = []
                for a, b in blocks([len(t) for t in texts]):
                    words = [letter_words(t) for t in texts[a:b]]
                    if len(index) > WORDS:
                        index.clear()
                        scores = scores[:0]
                    new = list(set().union(*words).difference(index))
                    if new:
                        index.update(zip(new, range(len(scores), len(scores) + len(new))))
                        letters = np.fromiter((any(map(str.isalpha, w)) for w in new), bool, len(new))
                        made = models.word_scores(new)
                        made[~letters] = np.nan  # digits in other scripts: no letter, no evidence
                        scores = np.concatenate([scores, made])
                    for ws in words:
                        rows = scores[[index[w] for w in ws]]
                        ok = ~np.isnan(rows[:, 0])
                        n = int(sum(len(w) + 1 for w in ws)) if ok.all() else sum(len(w) + 1 for w, k in zip(ws, ok) if k)
                        out.append(_verdict(langs, n, rows[ok].sum(0, dtype=np.float64)))
                _MEMORY[tag][1] = scores
                yield pd.DataFrame(out, columns=["best", "n", "h", "score", "each"])

        return rows.withColumn("__lid", run(F.col(text).cast("string")))

    def _joined(self, rows: DataFrame, text: str) -> DataFrame:
        """As ``_scored``: words whose entries are all in memory are scored in the task, the others meet theirs in a join, each distinct word once."""
        shared, tag, langs = self.shared, id(self), self.models.langs

        @F.pandas_udf("n long, log array<double>, rest array<struct<word:string,times:long>>")
        def here(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
            models = shared.value
            for old in [t for t in _MEMORY if t != tag]:
                del _MEMORY[old]
            memory = _MEMORY.setdefault(tag, {})
            for batch in batches:
                out = []
                for t in batch:
                    words = Counter(letter_words(t or ""))
                    if len(memory) > WORDS:
                        memory.clear()
                    if new := [w for w in words if w not in memory]:
                        for w, score, known in zip(new, *models.word_scores(new)):
                            memory[w] = (score if known else None) if any(map(str.isalpha, w)) else ()
                    n, log, rest = 0, np.zeros(len(langs)), []
                    for w, times in words.items():
                        score = memory[w]
                        if isinstance(score, tuple):
                            continue  # digits in other scripts: no letter, no evidence
                        n += times * (len(w) + 1)
                        if score is None:
                            rest.append({"word": w, "times": times})
                        else:
                            log += times * score
                    out.append((n, log.tolist(), rest))
                yield pd.DataFrame(out, columns=["n", "log", "rest"])

        def missing(batch: pa.RecordBatch) -> dict:
            words = batch.column(0).to_pylist()
            of, n, context, key = shared.value.missing(words)
            return {"word": batch.column(0).take(pa.array(of)), "n": n, "context": context, "key": key}

        @F.pandas_udf("array<double>")
        def there(word: pd.Series, found: pd.Series) -> pd.Series:
            more = {(e["n"], e["context"], e["key"] % (1 << 64)): [tuple(x.values()) for x in e["v"]] for es in found for e in es}
            return pd.Series(shared.value.word_scores(word.tolist(), more)[0].tolist())

        @F.pandas_udf(VERDICT)
        def verdict(n: pd.Series, log: pd.Series) -> pd.DataFrame:
            return pd.DataFrame([_verdict(langs, int(m), np.array(x, np.float64)) for m, x in zip(n, log)], columns=["best", "n", "h", "score", "each"])

        rows = keep(rows.withColumn("__w", here(F.col(text).cast("string"))).withColumn("__id", F.monotonically_increasing_id()))
        rest = rows.select("__id", F.explode("__w.rest").alias("r")).select("__id", "r.word", "r.times")
        asked = arrow_map(rest.select("word").distinct(), "word string, n int, context boolean, key long", missing)
        found = asked.join(self.table.select("n", "context", "key", "v"), ["n", "context", "key"], "left")
        found = found.groupBy("word").agg(F.collect_list(F.when(F.col("v").isNotNull(), F.struct("n", "context", "key", "v"))).alias("found"))
        scores = found.select("word", there("word", "found").alias("log"))
        more = rest.join(scores, "word").groupBy("__id").agg(F.array(*[F.sum(F.col("times") * F.col("log")[i]) for i in range(len(langs))]).alias("__more"))
        both = F.when(F.col("__more").isNull(), F.col("__w.log")).otherwise(F.zip_with("__w.log", "__more", lambda a, b: a + b))
        return rows.join(more, "__id", "left").withColumn("__lid", verdict(F.col("__w.n"), both)).drop("__w", "__id", "__more")

    def predict(self, docs: DataFrame, text: str = "text") -> DataFrame:
        """Documents with ``lang_pred``, ``score`` (0 to 1), ``cross_entropy`` (nats per character) and ``rejected``.

        Null texts and texts without a letter are ``und``, score 0, rejected; so are all texts if nothing was learned.  Ties go to the
        first language by name.  Input columns with the names of results are replaced.
        """
        made = ("lang_pred", "score", "cross_entropy", "rejected")
        rows = docs.drop(*[c for c in made if c != text])
        if self.models is None:
            return rows.withColumns({"lang_pred": F.lit("und"), "score": F.lit(0.0), "cross_entropy": F.lit(None).cast("double"), "rejected": F.lit(True)})
        out = self._scored(rows, text)
        far: Column = F.lit(False)
        n, h = F.col("__lid.n"), F.col("__lid.h")
        for name, limit in self.limits.items():
            far = far | ((F.col("__lid.best") == name) & (h > limit + SLACK / F.sqrt(F.greatest(n, F.lit(1)))))
        return out.withColumns({"lang_pred": F.col("__lid.best"), "score": F.col("__lid.score"), "cross_entropy": h,
                                "rejected": (n == 0) | F.coalesce(far, F.lit(False))}).drop("__lid")
