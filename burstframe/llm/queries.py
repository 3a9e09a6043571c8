"""Registered queries of this subpackage and, where SQL can say the same, their DuckDB text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from burstframe.llm.common import crc_of_id, table
from burstframe.session import tune

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def wrap(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(tune(spark), sf_dir)

        run.__name__, run.__doc__ = name, fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return wrap


MIX_SQL = """
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size,
         (('0x' || substr(md5('mix|' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE AS u
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS sid FROM d GROUP BY source),
w AS (SELECT *, [3.0::DOUBLE, 1.0, 2.0][((sid - 1) % 3 + 1)::INT] AS w, source_size * 2.0::DOUBLE AS cap,
             (sum(source_size) OVER ())::DOUBLE * 1.5::DOUBLE AS goal FROM s),
l AS (SELECT *, row_number() OVER f AS k,
             (goal - coalesce(sum(cap) OVER (f ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
             / (sum(w) OVER () - coalesce(sum(w) OVER (f ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS level
      FROM w WINDOW f AS (ORDER BY cap / w, sid)),
g AS (SELECT sid, source, source_size,
             least(cap, coalesce((SELECT arg_min(level, k) FROM l WHERE level <= cap / w) * w, cap)) AS target FROM l),
c AS (SELECT d.*, sid, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS c
      FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source),
p AS (SELECT *, floor(c) AS whole, c - floor(c) AS p FROM c),
o AS (SELECT *, CASE WHEN p > 0 THEN u / (1.0::DOUBLE - u) * (1.0::DOUBLE - p) / p END AS odds FROM p),
v AS (SELECT *, odds / (1.0::DOUBLE + odds) AS v FROM o),
r AS (SELECT sid, max(target) - sum(whole * size) AS rest FROM v GROUP BY sid),
t AS (SELECT sid, v, sum(size) AS n FROM v WHERE v IS NOT NULL AND size > 0 GROUP BY sid, v),
u AS (SELECT t.*, rest, sum(n) OVER (PARTITION BY sid ORDER BY v) AS upto FROM t JOIN r USING (sid)),
k AS (SELECT sid, coalesce(max(CASE WHEN upto <= rest THEN v END), -1) AS cut,
             max(rest) - coalesce(max(CASE WHEN upto <= rest THEN upto END), 0) AS missing FROM u GROUP BY sid),
z AS (SELECT u.sid, arg_min(u.v, {a: abs(n - missing), b: u.v}) AS last FROM u JOIN k USING (sid)
      WHERE u.v > cut AND abs(n - missing) < missing GROUP BY u.sid)
SELECT doc_id, size::BIGINT AS size, source_size, target,
       (size * (whole + CASE WHEN v <= cut OR v = last THEN 1 ELSE 0 END))::BIGINT AS taken
FROM v LEFT JOIN k USING (sid) LEFT JOIN z USING (sid)
"""


@query("op1_mixing", MIX_SQL)
def op1_mixing(spark, sf_dir):
    """All documents mixed to 150 % of their words by source weights 3, 1, 2."""
    from burstframe.llm.mixing import mix

    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


LINES_SQL = """
WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                  generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i, row_number() OVER () AS u FROM documents),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
f AS (SELECT key FROM k WHERE length(key) > 0 GROUP BY key HAVING count(DISTINCT doc_id) >= 10),
m AS (SELECT k.*, f.key IS NOT NULL AS gone FROM k LEFT JOIN f ON k.key = f.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""


@query("op2_line_dedup", LINES_SQL)
def op2_line_dedup(spark, sf_dir):
    """Lines that stand in ten documents or more go from all documents."""
    from burstframe.llm.line_dedup import drop_frequent_lines

    out = drop_frequent_lines(table(spark, sf_dir, "documents"), threshold=10, min_chars=1)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


URL_RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]

URL_SQL = r"""
WITH a AS (SELECT page_id, url, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                  regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path,
                  regexp_replace(regexp_replace(url, '(?s)#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS bare FROM pages),
b AS (SELECT *, CASE WHEN (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/de/%' THEN 'example.com/de/'
                     WHEN (host = 'example.net' OR host LIKE '%.example.net') AND path LIKE '/en/%' THEN 'example.net/en/'
                     WHEN (host = 'org' OR host LIKE '%.org') AND path LIKE '/fr/%' THEN 'org/fr/'
                     WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/%' THEN 'net/' END AS rule,
             nullif(regexp_replace(regexp_replace(regexp_replace(translate(regexp_extract(bare, '^([^/?]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '^www[.]', ''), ':(80|443)$', '')
                    || regexp_extract(bare, '(?s)^[^/?]*(.*)$', 1), '/$', ''), '') AS canon FROM a),
l AS (SELECT DISTINCT canon FROM b WHERE rule IN ('net/', 'example.com/de/') AND canon IS NOT NULL)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
       WHEN canon IN (SELECT canon FROM l) THEN 'block' ELSE 'allow' END AS verdict
FROM b
"""


@query("op8_url_filters", URL_SQL)
def op8_url_filters(spark, sf_dir):
    """Rule or canonical-list verdict of every page."""
    from burstframe.llm.url_filter import judge

    return judge(table(spark, sf_dir, "pages"), URL_RULES).select("page_id", "host", "path", "rule", "verdict")


@query("op5_language_id")
def op5_language_id(spark, sf_dir):
    """Language of every document, learned from those that are not held out."""
    from burstframe.llm.language_id import LanguageId

    docs = table(spark, sf_dir, "documents").withColumn("held_out", F.pmod(crc_of_id(), F.lit(4)) == 2)
    model = LanguageId.train(docs.where(~F.col("held_out")))
    return model.predict(docs.select("doc_id", "held_out", "text")).select("doc_id", "held_out", "lang_pred", "score", "cross_entropy", "rejected")


@query("op10_bpe")
def op10_bpe(spark, sf_dir):
    """Ids and decoded text of every document under the public word-level vocabulary."""
    import public_tokenizers

    from burstframe.llm.bpe import encode

    out = encode(table(spark, sf_dir, "documents").select("doc_id", "text"), public_tokenizers.path("word_bpe_49k.json"))
    return out.select("doc_id", "n_tokens", F.sha2("id_bytes", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@query("op6_repetition")
def op6_repetition(spark, sf_dir):
    """Repetition measures and verdict of every document.

    The base rule fails every text with more than half of its words in repeats, so the method's limits lie below that: a tenth of the words in repeats of ten words
    or more (the Gopher rule for ten words), or a twentieth in one repeat.
    """
    from burstframe.llm.repetition import judge

    return judge(table(spark, sf_dir, "documents").select("doc_id", "text"), max_covered=0.1, max_longest=0.05).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "covered_words", "longest_repeat")


@query("op9_permutation_index")
def op9_permutation_index(spark, sf_dir):
    """Five nearest vectors of every fiftieth vector."""
    from burstframe.llm.permutation_index import search

    return search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


@query("op4_jaccard_tree")
def op4_jaccard_tree(spark, sf_dir):
    """Components of documents at 90 % Jaccard similarity of three-word shingles."""
    from burstframe.llm.jaccard_tree import JaccardJoin

    return JaccardJoin(3, 90, 100).classes(table(spark, sf_dir, "documents")).select(F.col("id").alias("doc_id"), "n_shingles", "component_id")


@query("op7_suffix_dedup")
def op7_suffix_dedup(spark, sf_dir):
    """Every document without the bytes of 100-byte strings that start earlier."""
    from burstframe.llm.suffix_dedup import remove_repeats

    out = remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"), length=100)
    size = F.aggregate("removed_spans", F.lit(0).cast("long"), lambda n, x: n + x["e"] - x["s"])
    return out.select("doc_id", "n_bytes", size.alias("n_removed"), F.size("removed_spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


@query("op3_lm_scoring")
def op3_lm_scoring(spark, sf_dir):
    """Base and model log10 probability of every document."""
    import public_tokenizers

    from burstframe.llm.lm_scoring import score

    docs = table(spark, sf_dir, "documents").select("doc_id", "text", (F.pmod(crc_of_id(), F.lit(5)) == 1).alias("held_out"))
    return score(docs, ~F.col("held_out"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


@query("op11_token_files")
def op11_token_files(spark, sf_dir):
    """Ids of every document written to token files in order of doc_id, found again by key and read back."""
    import public_tokenizers

    from burstframe.llm.token_files import TokenFiles

    docs = table(spark, sf_dir, "documents")
    files = TokenFiles.write(docs, public_tokenizers.path("byte_bpe_50k.json"), end=2)
    return files.fetch(files.lookup(docs)).select("doc_id", "start", "n_tokens", F.crc32("id_bytes").alias("ids_crc32"))


MERKLE_SQL = """
WITH RECURSIVE d AS (
  SELECT doc_id, source, text, row_number() OVER () AS u,
         coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-')
         || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS front,
         -- crc32, bit by bit, of the decimal id
         xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(coalesce(doc_id::VARCHAR, ''), ''), lambda c: coalesce(ascii(nullif(c, '')), 0)::BIGINT)),
             lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
                                        lambda x, bit: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::BIGINT) ELSE x >> 1 END)), 4294967295::BIGINT) AS crc
  FROM documents),
h AS (SELECT *, sha256(front || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
             sha256(front || coalesce(strlen(replace(text, chr(10), '')) || ':' || replace(text, chr(10), ''), '-')) AS cut FROM d),
l AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf, u) - 1 AS pos FROM h),
t AS (SELECT source, 0 AS level, pos AS i, leaf AS node, count(*) OVER (PARTITION BY source) AS n FROM l
      UNION ALL
      SELECT source, level + 1, i // 3, sha256(string_agg(node, '' ORDER BY i)), (any_value(n) + 2) // 3 FROM t WHERE n > 1 GROUP BY source, level, i // 3),
s AS (SELECT source, node AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS spos FROM t WHERE n = 1),
v AS (SELECT 0 AS level, spos AS i, subroot AS node, count(*) OVER () AS n FROM s
      UNION ALL
      SELECT level + 1, i // 3, sha256(string_agg(node, '' ORDER BY i)), (any_value(n) + 2) // 3 FROM v WHERE n > 1 GROUP BY level, i // 3),
p AS (SELECT l.u, t.level, coalesce(string_agg(t.node, '' ORDER BY t.i) FILTER (t.i < pos // (3 ** t.level)::BIGINT), '') AS a,
             coalesce(string_agg(t.node, '' ORDER BY t.i) FILTER (t.i > pos // (3 ** t.level)::BIGINT), '') AS b
      FROM l JOIN t ON l.source IS NOT DISTINCT FROM t.source AND t.n > 1 AND t.i // 3 = pos // (3 ** (t.level + 1))::BIGINT GROUP BY l.u, t.level),
w AS (SELECT source, v.level, coalesce(string_agg(v.node, '' ORDER BY v.i) FILTER (v.i < spos // (3 ** v.level)::BIGINT), '') AS a,
             coalesce(string_agg(v.node, '' ORDER BY v.i) FILTER (v.i > spos // (3 ** v.level)::BIGINT), '') AS b
      FROM s JOIN v ON v.n > 1 AND v.i // 3 = spos // (3 ** (v.level + 1))::BIGINT GROUP BY source, v.level),
x AS (SELECT u, level, a, b FROM p UNION ALL SELECT l.u, 100 + w.level, a, b FROM l JOIN w ON l.source IS NOT DISTINCT FROM w.source),
y AS (SELECT u, list({'a': a, 'b': b} ORDER BY level) AS steps, string_agg(a || b, '' ORDER BY level) AS proof FROM x GROUP BY u),
z AS (SELECT l.*, subroot, (SELECT node FROM v WHERE n = 1) AS root, sha256(coalesce(proof, '')) AS proof_sha256,
             list_reduce(list_prepend({'a': CASE WHEN crc % 2 = 0 THEN cut ELSE leaf END, 'b': ''}, coalesce(steps, [])),
                         lambda x, y: {'a': sha256(y.a || x.a || y.b), 'b': ''}).a AS folded_root
      FROM l JOIN s ON l.source IS NOT DISTINCT FROM s.source LEFT JOIN y USING (u))
SELECT doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root AS verified FROM z
"""


@query("op12_merkle_manifest", MERKLE_SQL)
def op12_merkle_manifest(spark, sf_dir):
    """Merkle proof of every document, folded again after some texts lose their line breaks."""
    from burstframe.llm.merkle import fold, leaf_hash, manifest, proof_hash

    def leaf(text):
        return leaf_hash(F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), text)

    cut = F.when((F.pmod(crc_of_id(), F.lit(2)) == 0) & F.contains("text", F.lit("\n")), leaf(F.replace("text", F.lit("\n"), F.lit(""))))
    rows = manifest(table(spark, sf_dir, "documents"), leaf(F.col("text")), carry=[cut.alias("tampered")])
    rows = rows.withColumns({"proof_sha256": proof_hash(F.col("lefts"), F.col("rights")),
                             "folded_root": fold(F.coalesce("tampered", "leaf"), F.col("lefts"), F.col("rights"))})
    return rows.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


@query("op13_whitening")
def op13_whitening(spark, sf_dir):
    """All embeddings on up to 32 whitened components."""
    from burstframe.llm.whitening import whiten

    return whiten(table(spark, sf_dir, "embeddings"))
