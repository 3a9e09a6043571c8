"""Operators on many documents, pages and vectors against brute-force versions, and the pipeline."""

from __future__ import annotations

from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_data import ASCII, SCHEMA, WORD, words
from pyspark.sql import functions as F


def _smallest_reachable(n, links):
    parent = list(range(n))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return [root(i) for i in range(n)]


def _jaccard(rows, k, num, den):
    """Brute force: (id, set size, smallest id of the component) per row."""
    sets = []
    for _, t in rows:
        w = WORD.findall((t or "").translate(ASCII))
        sets.append({tuple(w)} if 0 < len(w) < k else {tuple(w[i : i + k]) for i in range(len(w) - k + 1)})
    links = [(i, j) for i in range(len(rows)) for j in range(i) if sets[i] and den * len(sets[i] & sets[j]) >= num * len(sets[i] | sets[j])]
    root = _smallest_reachable(len(rows), links)
    least = defaultdict(list)
    for (i, _), r in zip(rows, root):
        if i is not None:
            least[r].append(i)
    return [(i, len(s), i if not s else min(least[r], default=None)) for (i, _), s, r in zip(rows, sets, root)]


def _order(rows):
    return sorted(rows, key=str)


@pytest.mark.parametrize("k,num,den", [(3, 90, 100), (5, 80, 100), (2, 50, 100)])
def test_jaccard_components(docs, empty, k, num, den, monkeypatch):
    from burstframe.llm import jaccard_tree as J

    monkeypatch.setattr(J, "BLOCK", 2000)  # several blocks
    got = [(r["id"], r["n_shingles"], r["component_id"]) for r in J.JaccardJoin(k, num, den).classes(docs).collect()]
    assert _order(got) == _order(_jaccard([(r["doc_id"], r["text"]) for r in docs.collect()], k, num, den))
    assert J.JaccardJoin(k, num, den).classes(empty).count() == 0


def test_jaccard_chains(spark):
    """Chains of near copies and unlinked relatives in one family."""
    from burstframe.llm.jaccard_tree import JaccardJoin

    import random

    rng = random.Random(4)
    base = words(rng, "xx", 200).split()
    rows = []
    for i in range(120):
        if i % 10 == 0:
            base = words(rng, "xx", 200).split() if i % 30 == 0 else base
        base = list(base)
        for _ in range(rng.choice([1, 2, 6])):
            base[rng.randrange(len(base))] = words(rng, "yy", 1)
        rows.append((i * 3 % 120, " ".join(base)))
    got = [(r["id"], r["n_shingles"], r["component_id"]) for r in JaccardJoin(3, 90, 100).classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    want = _jaccard(rows, 3, 90, 100)
    assert sorted(got) == sorted(want) and 1 < len({c for *_, c in want}) < 110


def test_signature_tree_finds_all_links():
    from burstframe.llm.jaccard_tree import Tree

    rng = np.random.default_rng(2)
    base = [rng.choice(10**9, 60, replace=False) for _ in range(12)]
    members = [np.unique(np.concatenate([b[rng.random(60) < p], rng.choice(10**9, 4)])).astype(np.uint64) for b in base for p in (1, 1, 0.97, 0.9, 0.8, 0.7)]
    links = [(i, j) for i in range(len(members)) for j in range(i) if 100 * len(np.intersect1d(members[i], members[j])) >= 80 * len(np.union1d(members[i], members[j]))]
    found = Tree(members, np.arange(len(members)), 80, 100).join()
    assert _smallest_reachable(len(members), found) == _smallest_reachable(len(members), links)


def test_representatives(docs):
    from burstframe.llm.jaccard_tree import JaccardJoin

    got = JaccardJoin(5, 80, 100).representatives(docs)
    want = {c if c is not None else i for i, _, c in _jaccard([(r["doc_id"], r["text"]) for r in docs.collect()], 5, 80, 100)}
    assert got.columns == docs.columns and sorted(r["doc_id"] for r in got.collect()) == sorted(want)


def test_representatives_of_repeated_ids(spark):
    from burstframe.llm.jaccard_tree import JaccardJoin

    a, b = " ".join(f"a{i}" for i in range(30)), " ".join(f"b{i}" for i in range(30))
    docs = spark.createDataFrame([(1, b), (5, a), (5, b), (5, a)], "doc_id long, text string")
    assert sorted(tuple(r) for r in JaccardJoin(3, 90, 100).representatives(docs).collect()) == [(1, b), (5, a)]
    both = docs.where("doc_id = 5")
    assert sorted(tuple(r) for r in JaccardJoin(3, 90, 100).representatives(both).collect()) == [(5, a), (5, b)]


def test_components(spark):
    from burstframe.llm.graph import components

    rng = np.random.default_rng(3)
    links = [(int(a), int(b)) for a, b in rng.integers(0, 300, (220, 2))] + [(i, i + 1) for i in range(400, 460)] + [(500, 500 + i) for i in range(1, 80)]
    want = _smallest_reachable(600, links)
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {n: want[n] for a, b in links for n in (a, b) if a != b}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def _mix_checks(rows, cap=2.0):
    by = defaultdict(list)
    for r in rows:
        by[r["source"]].append(r)
    total = sum(r["size"] for r in rows)
    assert abs(sum(v[0]["target"] for v in by.values()) - 1.5 * total) < 1e-6 * total
    for v in by.values():
        assert v[0]["source_size"] == sum(r["size"] for r in v) and v[0]["target"] <= cap * v[0]["source_size"] + 1e-9
        taken = sum(r["size"] * r["copies"] for r in v)
        assert abs(taken - v[0]["target"]) <= max([r["size"] for r in v]) and all(r["copies"] <= cap for r in v)
    return by


def test_mixing(spark, docs, empty):
    from burstframe.llm.mixing import mix

    rows = mix(docs).collect()
    assert len(rows) == docs.count() and mix(empty).count() == 0
    assert all(r["size"] == len(WORD.findall(r["text"] or "")) for r in rows)
    _mix_checks(rows)
    assert sorted(map(str, rows)) == sorted(map(str, mix(docs.repartition(3)).collect()))


def test_mixing_targets(spark):
    from burstframe.llm.mixing import targets

    sizes = {"a": 10.0, "b": 500.0, "c": 7.0, None: 300.0}
    got = {r["source"]: r["target"] for r in targets(spark.createDataFrame(list(sizes.items()), "source string, size double")).collect()}
    weight, left, goal = {"a": 3.0, "b": 1.0, "c": 2.0, None: 3.0}, 1.5 * sum(sizes.values()), {}
    free = set(sizes)
    while free:  # reshare what is above the caps until none is
        share = left / sum(weight[s] for s in free)
        over = {s for s in free if share * weight[s] > 2 * sizes[s]}
        if not over:
            goal |= {s: share * weight[s] for s in free}
            break
        goal |= {s: 2 * sizes[s] for s in over}
        left -= sum(2 * sizes[s] for s in over)
        free -= over
    assert got.keys() == goal.keys() and all(abs(got[s] - goal[s]) < 1e-9 for s in goal)


def test_mixing_weights_change_the_odds(spark):
    from burstframe.llm.mixing import mix

    rows = [(i, "w " * (1 + i % 9), "s", float(1 + 9 * (i % 2))) for i in range(4000)]
    out = mix(spark.createDataFrame(rows, "doc_id long, text string, source string, quality double"), share=0.5, weight="quality").collect()
    size = sum(r["size"] for r in out)
    assert abs(sum(r["size"] * r["copies"] for r in out) - 0.5 * size) <= 9
    light, heavy = (np.mean([r["copies"] for r in out if r["quality"] == q]) for q in (1.0, 10.0))
    assert 8 < heavy / light < 12


def test_suffix_dedup(spark, docs, empty, monkeypatch):
    from burstframe.llm import suffix_dedup as S

    def brute(rows, length=100):
        out, seen = {}, {}
        for i, t in sorted({(2**62 if i is None else i, t or "") for i, t in rows}):
            b, spans = t.encode(), []
            for s in range(len(b) - length + 1):
                w = b[s : s + length]
                if seen.setdefault(w, (i, s)) != (i, s):
                    if spans and s <= spans[-1][1]:
                        spans[-1][1] = s + length
                    else:
                        spans.append([s, s + length])
            gone = {x for s, e in spans for x in range(s, e)}
            out[i, t] = len(b), [tuple(x) for x in spans], bytes(x for j, x in enumerate(b) if j not in gone)
        return out

    for part, shard in ((20_000, 2 << 20), (3, 4000)):  # the second cuts groups into shards and merges them
        monkeypatch.setattr(S, "PART", part)
        monkeypatch.setattr(S, "SHARD", shard)
        want = brute([(r["doc_id"], r["text"]) for r in docs.collect()])
        rows = S.remove_repeats(docs).collect()
        assert len(rows) == docs.count()
        for r in rows:
            assert (r["n_bytes"], [(x["s"], x["e"]) for x in r["removed_spans"]], bytes(r["kept"])) == want[2**62 if r["doc_id"] is None else r["doc_id"], r["text"] or ""]
    assert S.remove_repeats(empty).count() == 0


def test_anchors_cover_every_window_of_cut_texts(monkeypatch):
    from burstframe.llm import suffix_dedup as S

    rng = np.random.default_rng(0)
    text = bytes(rng.integers(97, 100, 5000, dtype=np.uint8))
    whole = S._all_anchors([text], 100)
    monkeypatch.setattr(S, "PIECE", 700)
    assert all((a == b).all() for a, b in zip(S._all_anchors([text], 100), whole))
    assert np.diff(np.sort(whole[1])).max() <= 100 - S.GRAM + 1


RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]


def test_url_rules_and_list(spark):
    from burstframe.llm.url_filter import judge, on_list

    urls = {None: ("", "", None, "allow"), "": ("", "", None, "allow"), "http://a.NET/x?y=://z": ("a.net", "/x", "net/", "block"), "net/x": ("", "", None, "allow"),
            "https://www.example.net/en/1": ("www.example.net", "/en/1", "example.net/en/", "allow"), "http://example.net": ("example.net", "", None, "allow"),
            "http://notexample.com/de/": ("notexample.com", "/de/", None, "allow"), "http://x.example.com/de/#f": ("x.example.com", "/de/", "example.com/de/", "block"),
            "x.example.com/de": ("", "", None, "block"), "ftp://b.org/fr/?q": ("b.org", "/fr/", "org/fr/", "allow"), "http://b.org#/fr/": ("b.org", "", None, "allow")}
    rows = [(i, u, "extra") for i, u in enumerate(urls)] * 2
    out = judge(spark.createDataFrame(rows, "page_id long, url string, host string"), RULES).collect()
    assert len(out) == len(rows) and {r["url"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in out} == urls
    none = spark.createDataFrame([], "page_id long, url string, host string")
    assert judge(none, RULES).count() == 0
    pages = spark.range(3000).select(F.concat(F.lit("http://h"), "id", F.lit(".com/p")).alias("url"), "id")
    listed = pages.where("id % 3 = 0").select(F.concat("url", F.lit("/#x")))
    assert {r["id"] for r in on_list(pages, "url", listed).where("listed").collect()} == set(range(0, 3000, 3))


def test_nearest_neighbours(spark):
    from burstframe.llm.permutation_index import search

    rng = np.random.default_rng(5)
    x = rng.normal(size=(3000, 16)).astype(np.float32)
    x[100:400] = x[100]  # a very common vector
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(3000, None), (3050, [0.0] * 16), (3100, [float("nan")] + [1.0] * 15), (3150, [None] + [1.0] * 15), (None, x[0].tolist()), (3200, [1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    out = search(df, F.col("vec_id") % 50 == 0, k=5).collect()
    d = x.astype(float)
    norms = np.linalg.norm(d, axis=1)
    hits = 0
    by = defaultdict(list)
    for r in sorted(out, key=lambda r: (r["query_id"], r["rank"])):
        by[r["query_id"]].append(r)
    assert set(by) == set(range(0, 3000, 50)) and all([r["rank"] for r in v] == [1, 2, 3, 4, 5] for v in by.values())
    for q, v in by.items():
        s = d @ d[q] / (norms * norms[q])
        assert all(abs(s[r["vec_id"]] - r["score"]) < 1e-12 for r in v)
        s[q] = -9
        hits += len(set(np.lexsort((np.arange(3000), -s.round(12)))[:5]) & {r["vec_id"] for r in v})
    assert hits >= 0.9 * 5 * len(by)
    assert search(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0
    few = search(df.where("vec_id < 3"), F.col("vec_id") == 0).collect()
    assert sorted(r["vec_id"] for r in few) == [1, 2]


def test_pipeline_stages(spark, docs, tmp_path):
    import corpus_pipeline as P

    path = str(tmp_path)
    docs.drop("n", "id", "t1").write.parquet(f"{path}/documents.parquet")
    frame, counts = spark.read.parquet(f"{path}/documents.parquet"), []
    for i, (name, stage) in enumerate(P.STAGES):
        out = stage(spark, frame, path)
        assert name == P.STAGES[-1][0] or out.columns == list(P.COLUMNS)
        out.write.parquet(f"{path}/{i}")
        frame = spark.read.parquet(f"{path}/{i}")
        counts.append(frame.count())
    assert counts[0] >= 70 and counts[1] == counts[0] and counts[2] < counts[1]
    lines = Counter(x for r in spark.read.parquet(f"{path}/1").collect() for x in set(r["text"].lower().split("\n")))
    assert "the same line" not in {x.strip() for x in lines}
    assert sorted(r["ids_sha256"] for r in frame.collect()) == sorted(r["ids_sha256"] for r in P.run(spark, path).collect())
    none = spark.createDataFrame([], SCHEMA).select(*P.COLUMNS)
    for _, stage in P.STAGES:
        out = stage(spark, none, path)
        assert out.count() == 0


def test_registered(spark):
    import __spark_entry__ as entry

    names = entry.queries()
    assert sum(n.startswith("op") for n in names if n[2].isdigit()) == 13 and "pipeline" in names


def test_repetition_verdict_has_an_effect(spark, tmp_path):
    """A text that passes the base rule but repeats a long passage is not kept; the same words without the repeat are."""
    from burstframe.llm.queries import QUERIES

    words = [f"w{i}" for i in range(200)]
    rows = [(0, " ".join(words)), (1, " ".join(words + words[:20])), (2, " ".join(words[:40]))]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    out = {r["doc_id"]: r for r in QUERIES["op6_repetition"](spark, str(tmp_path)).collect()}
    assert [out[k]["base_failed"] for k in range(3)] == [False, False, True]
    assert [out[k]["kept"] for k in range(3)] == [True, False, False]
