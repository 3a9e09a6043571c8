"""Made-up documents for the tests of this folder."""

from __future__ import annotations

import random
import re

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n int, id string, t1 string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
ASCII = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SYLLABLES = {"xx": "ka lo mi tu re na so vi pe du".split(), "yy": "sch ung eich ver zu ter gen über ach ent".split()}


def words(rng: random.Random, lang: str, n: int) -> str:
    return " ".join("".join(rng.choices(SYLLABLES[lang], k=rng.randint(1, 3))) for _ in range(n))


def rows(seed: int = 1, n: int = 60):
    """Documents with nulls in every column, empty and long texts, copies, near copies, repeated rows and clashing column names."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        lang = rng.choice(["xx", "yy"])
        text = "\n".join(words(rng, lang, rng.randint(3, 40)).capitalize() for _ in range(rng.randint(1, 8)))
        out.append([i, text + "\nthe SAME line\r\n", lang, rng.choice(["a", "b", "Ä", None])])
    long = words(rng, "xx", 4000)
    half = words(rng, "yy", 120)
    out += [[n, None, "xx", "a"], [n + 1, "", None, None], [n + 2, " \n\t\n", "yy", "b"], [n + 3, long, "xx", "b"], [n + 4, half, "yy", "a"], [n + 5, half, "yy", "a"],
            [n + 6, half + " more", "yy", "b"], [n + 7, half.upper(), "yy", "b"], [n + 8, "12 34 !? ½", "xx", "a"], [None, half + " without id", "yy", "a"],
            [n + 9, "ab " * 300, "xx", None], [n + 10, "é" * 200 + half[:150] + "\x00😀", "yy", "a"], [n + 11, "<|endoftext|>Aß Σ don't 1234 日本", None, "a"]]
    out += [list(out[3]), list(out[3])]  # repeated rows
    return [(*r, None if r[1] is None else len(r[1]), 7, "clash", "clash") for r in out]
