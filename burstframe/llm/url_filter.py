"""URL filters: host and path rules, then a list of canonical URLs behind a blocked Bloom filter.

Everything is column expressions and joins.  The filter is a table with one row for each block of 256 bits (four longs); a URL
touches one block only, so a probe is one equi-join on the block number, and only possible hits go on to the exact hash join
with the list, which removes the false positives.  The number of blocks follows the list, so nothing is broadcast by force:
Spark picks the join by the filter's measured size, and AQE splits the blocks of very frequent URLs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from burstframe.llm.common import LOWER, UPPER
from burstframe.operators.reuse import keep

#: Listed URLs per block of 256 bits: one bit in each of four words, about 0.3 % false positives.
PER_BLOCK = 16
SPLIT = "(?s)^.*?://([^/?#]*)([^?#]*)"


def host(url: Column) -> Column:
    """After the first :// up to / ? # or the end, A-Z lower-cased; empty without ://."""
    return F.translate(F.coalesce(F.regexp_extract(url, SPLIT, 1), F.lit("")), UPPER, LOWER)


def path(url: Column) -> Column:
    """After the host up to ? # or the end."""
    return F.coalesce(F.regexp_extract(url, SPLIT, 2), F.lit(""))


def canonical(url: Column) -> Column:
    """Without scheme, fragment, leading www., ports 80 and 443 and final slash, host lower-cased; null where nothing is left."""
    bare = F.regexp_replace(F.regexp_replace(url, "(?s)#.*$", ""), "^[A-Za-z][A-Za-z0-9+.-]*://", "")
    name = F.translate(F.regexp_extract(bare, "^([^/?]*)", 1), UPPER, LOWER)
    name = F.regexp_replace(F.regexp_replace(name, "^www[.]", ""), ":(80|443)$", "")
    return F.nullif(F.regexp_replace(F.concat(name, F.regexp_extract(bare, "(?s)^[^/?]*(.*)$", 1)), "/$", ""), F.lit(""))


def matching_rule(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """Struct (rule, verdict) of the longest rule (verdict, host, path) that fits the host or a parent of it and begins the path."""
    out = None
    for verdict, h, p in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1:])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        value = F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))
        out = F.when(fits, value) if out is None else out.when(fits, value)
    return out if out is not None else F.lit(None).cast("struct<rule:string,verdict:string>")


def _bits(url: Column) -> list[Column]:
    h = F.xxhash64(F.lit(1), url)
    return [F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(h, 6 * i).bitwiseAND(63).cast("int")).alias(f"m{i}") for i in range(4)]


def bloom_blocks(listed: DataFrame, n_blocks: int) -> DataFrame:
    """The filter of the column ``canon``: block number and its four words."""
    return (listed.select(F.pmod(F.xxhash64("canon"), F.lit(n_blocks)).alias("block"), *_bits(F.col("canon")))
            .groupBy("block").agg(*[F.bit_or(f"m{i}").alias(f"w{i}") for i in range(4)]))


def on_list(df: DataFrame, url: str, listed: DataFrame, flag: str = "listed") -> DataFrame:
    """Every row of ``df`` with a boolean that says whether its canonical URL is in ``listed`` (a column of URLs).

    Null and empty URLs are never listed; repeats in either table change nothing; an empty list lists nothing.
    An input column named as the flag is replaced.
    """
    listed = keep(listed.select(canonical(F.col(listed.columns[0])).alias("canon")).where("canon IS NOT NULL").distinct())
    n_blocks = max(1, -(-listed.count() // PER_BLOCK))
    words = bloom_blocks(listed, n_blocks)
    rows = df.drop(flag).select(F.struct("*").alias("r"), canonical(F.col(url)).alias("canon"))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("canon"), F.lit(n_blocks)))
    probed = rows.join(words, "block", "left")
    every = F.lit(True)
    for i, m in enumerate(_bits(F.col("canon"))):
        every = every & (F.col(f"w{i}").bitwiseAND(m) == m)
    hit = F.coalesce(every & F.col("canon").isNotNull(), F.lit(False))
    exact = listed.select("canon", F.lit(True).alias("found")).hint("shuffle_hash")
    maybe = probed.where(hit).select("r", "canon").join(exact, "canon", "left").select("r", F.coalesce("found", F.lit(False)).alias("__on"))
    rest = probed.where(~hit).select("r", F.lit(False).alias("__on"))
    return maybe.unionAll(rest).select("r.*", F.col("__on").alias(flag))


def judge(pages: DataFrame, rules: list[tuple[str, str, str]], listed: DataFrame | None = None, url: str = "url") -> DataFrame:
    """Pages with host, path, rule and verdict: the rule's, else block for listed canonical URLs and allow for all others.

    ``listed`` is a frame whose first column holds URLs; by default the URLs that a blocking rule fits, so that other spellings
    of a blocked page are blocked too.  A null URL or one without :// has an empty host and path.  Input columns
    named host, path, rule or verdict are replaced.
    """
    rows = pages.drop(*[c for c in ("host", "path", "rule", "verdict") if c != url])
    rows = rows.withColumns({"__host": host(F.col(url)), "__path": path(F.col(url))})
    rows = rows.withColumn("__rule", matching_rule(F.col("__host"), F.col("__path"), rules))
    if listed is None:
        listed = rows.where("__rule.verdict = 'block'").select(url)
    out = on_list(rows, url, listed, "__listed")
    return out.select(*[c for c in pages.columns if c in rows.columns], F.col("__host").alias("host"), F.col("__path").alias("path"),
                      F.col("__rule.rule").alias("rule"),
                      F.coalesce(F.col("__rule.verdict"), F.when(F.col("__listed"), "block").otherwise("allow")).alias("verdict"))
