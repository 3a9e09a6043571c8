"""Quality rules on repetition: suffix arrays of the words of each text.

The texts of a batch are sorted together: suffixes are ranked by text and first word, then refined by doubling (each round sorts only the suffixes
that still share a rank).  Suffixes that agree in eight words or more get their common prefix by Kasai's rule in text
order.  A suffix's longest agreement with its neighbours is the longest substring that starts there and stands elsewhere in the text;
those that the preceding word does not extend are the maximal repeated substrings, the tops of the common-prefix intervals.  The union of their
spans gives the covered fraction; the longest of them the longest repeat.  A text's work is local to its row: nothing is shuffled.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from burstframe.llm.common import WHITE, blocks

SYMBOLS = "#*$%&|<>"
#: Suffixes are compared exactly from so many common words on (a power of two).
LEAST = 8
STRIP = WHITE.encode()


def suffixes(words: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Suffix array within texts: order, and for each place whether it agrees with the place before in two words' and in LEAST words' length.

    ``words`` are ids, ``text`` the ascending number of each word's text; suffixes end with their text.
    """
    n = len(words)
    key = text.astype(np.int64) * (int(words.max(initial=0)) + 1) + words
    order = np.argsort(key, kind="stable")
    s = key[order]
    new = np.ones(n, bool)
    new[1:] = s[1:] != s[:-1]
    rank = np.empty(n, np.int64)
    start = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    rank[order] = start
    end_of = np.searchsorted(text, text, "right")
    pairs = None
    h = 1
    while True:
        alone = new & np.append(new[1:], True)
        at = np.flatnonzero(~alone)  # places in groups of several
        if pairs is None and h == 2:
            pairs = rank.copy()
        if h == LEAST:
            same = ~new
        if not len(at):
            break
        i = order[at]
        nxt = i + h
        second = np.where(nxt < end_of[i], rank[np.minimum(nxt, n - 1)], -1)
        first = rank[i]
        by = np.lexsort((second, first))
        order[at] = i[by]
        f, s2 = first[by], second[by]
        split = np.ones(len(at), bool)
        split[1:] = (f[1:] != f[:-1]) | (s2[1:] != s2[:-1])
        new[at] = split
        start = np.maximum.accumulate(np.where(new, np.arange(n), 0))
        rank[order[at]] = start[at]
        h *= 2
    if pairs is None:
        pairs = rank
    if h < LEAST:
        same = np.zeros(n, bool)
    elif h == LEAST and not len(at):
        same = ~new
    return order, pairs, same


def common_prefixes(words: np.ndarray, text: np.ndarray, order: np.ndarray, same: np.ndarray) -> np.ndarray:
    """Common prefix with the place before, for places marked in ``same`` (0 elsewhere), by Kasai's rule."""
    out = np.zeros(len(words), np.int64)
    at = np.flatnonzero(same)
    if not len(at):
        return out
    by = np.argsort(order[at])
    at = at[by]
    mine, before = order[at].tolist(), order[at - 1].tolist()
    ends = np.searchsorted(text, text[order[at]], "right").tolist()
    w = words.tolist() if len(at) * 20 > len(words) else words
    length, last, found = 0, -2, []
    for i, j, end in zip(mine, before, ends):
        length = max(LEAST, length - 1) if i == last + 1 else LEAST
        most = end - max(i, j)
        while length < most and w[i + length] == w[j + length]:
            length += 1
        found.append(length)
        last = i
    out[at] = found
    return out


def repeats(order: np.ndarray, lcp: np.ndarray, text: np.ndarray, least: int) -> pd.DataFrame:
    """Maximal repeated substrings of ``least`` words or more: start (in the whole array), length, text."""
    n = len(order)
    longest = np.zeros(n, np.int64)
    longest[order] = np.maximum(lcp, np.append(lcp[1:], 0))
    at = np.flatnonzero(longest >= least)
    before = np.where(at > 0, longest[at - 1], 0)
    inner = (at > 0) & (text[at] == text[np.maximum(at - 1, 0)]) & (before >= longest[at] + 1)
    at = at[~inner]
    return pd.DataFrame({"start": at, "length": longest[at], "text": text[at]})


def _third(words, pairs, end_of, n_ids):
    """Marks of words in three-word windows that stand twice or more in their text."""
    n = len(words)
    i = np.arange(n)
    fits = np.flatnonzero(i + 2 < end_of)
    k = pairs[fits] * n_ids + words[fits + 2]
    _, inverse, times = np.unique(k, return_inverse=True, return_counts=True)
    at = fits[times[inverse] >= 2]
    marked = np.zeros(n + 3, np.int64)
    for d in range(3):
        marked[at + d] = 1
    return marked[:n]


def measure(texts: list[str], least: int) -> list[tuple]:
    """Per text: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, covered_words, longest_repeat, spans."""
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    split = [r.split() for r in raw]  # bytes: exactly the six white characters
    sizes = np.fromiter(map(len, split), np.int64, len(split))
    n = int(sizes.sum())
    starts = np.cumsum(sizes) - sizes
    third = covered = np.zeros(n, np.int64)
    longest = np.zeros(len(texts), np.int64)
    spans: list[list] = [[] for _ in texts]
    if n:
        ids: dict[bytes, int] = {}
        words = np.fromiter((ids.setdefault(w, len(ids)) for ws in split for w in ws), np.int64, n)
        text = np.repeat(np.arange(len(texts)), sizes)
        order, pairs, same = suffixes(words, text)
        third = _third(words, pairs, np.repeat(starts + sizes, sizes), len(ids))
        found = repeats(order, common_prefixes(words, text, order, same), text, least)
        edge = np.zeros(n + 1, np.int64)
        np.add.at(edge, found["start"].to_numpy(), 1)
        np.add.at(edge, (found["start"] + found["length"]).to_numpy(), -1)
        covered = (np.cumsum(edge[:n]) > 0).astype(np.int64)
        np.maximum.at(longest, found["text"].to_numpy(), found["length"].to_numpy())
        change = np.flatnonzero(np.diff(covered, prepend=0, append=0) | np.isin(np.arange(n + 1), starts))
        for a, b in zip(change, change[1:]):
            if covered[a]:
                t = text[a]
                spans[t].append((int(a - starts[t]), int(b - starts[t])))
    add = np.concatenate([[0], np.cumsum(third)]), np.concatenate([[0], np.cumsum(covered)])
    out = []
    for i, t in enumerate(texts):
        a, b = starts[i], starts[i] + sizes[i]
        lines = Counter(line for line in raw[i].split(b"\n") if line.strip(STRIP))
        out.append((int(sizes[i]), len(t) - sum(map(t.count, WHITE)), sum(map(t.count, SYMBOLS)), sum(lines.values()) - len(lines), int(add[0][b] - add[0][a]),
                    int(add[1][b] - add[1][a]), int(longest[i]), spans[i]))
    return out


MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "covered_words", "longest_repeat", "repeat_spans")


def judge(docs: DataFrame, least: int = 10, max_covered: float = 0.5, max_longest: float = 0.4, text: str = "text") -> DataFrame:
    """Documents with the measures, ``base_failed`` and ``kept``.

    ``repeat_spans`` are the unions of maximal repeated substrings of at least ``least`` words (``least`` >= 8), as word ranges [start, end).  The base rule fails
    texts of fewer than 50 words or with more than half of the words in repeated three-word windows; the method fails texts of which more
    than ``max_covered`` is covered, or whose longest repeat is more than ``max_longest`` of the words.  Null texts have no words.
    Input columns with the names of results are replaced.
    """
    if least < LEAST:
        raise ValueError(f"least must be {LEAST} or more")

    @F.pandas_udf("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, covered_words long, longest_repeat long, "
                  "repeat_spans array<struct<start:int,end:int>>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [t or "" for t in batch]
            out = []
            for a, b in blocks([len(t) for t in texts]):
                out += measure(texts[a:b], least)
            frame = pd.DataFrame(out, columns=list(MEASURES))
            frame["repeat_spans"] = [[{"start": a, "end": b} for a, b in s] for s in frame["repeat_spans"]]
            yield frame

    made = (*MEASURES, "base_failed", "kept")
    rows = docs.select(*[c for c in docs.columns if c not in made or c == text], run(F.col(text).cast("string")).alias("__rep"))
    rows = rows.select(*[c for c in rows.columns if c != "__rep" and c not in made], *[F.col(f"__rep.{c}").alias(c) for c in MEASURES])
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    good = (F.col("covered_words") <= max_covered * F.col("n_words")) & (F.col("longest_repeat") <= max_longest * F.col("n_words"))
    return rows.withColumn("base_failed", failed).withColumn("kept", ~failed & good)
