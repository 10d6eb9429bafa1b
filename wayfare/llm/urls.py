"""URL verdicts: prefix rules first, then a list of canonical URLs.

The list is probed through a blocked Bloom filter: each URL has one block of eight 32-bit words and
one bit in each word. Only URLs that pass are joined with the list itself, which removes the false
positives. Everything is a DataFrame expression.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfare.llm.tables import columns
from wayfare.session import cut_lineage

ALLOW, BLOCK = "allow", "block"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Query parameters that do not change a page.
TRACKING = "utm_[^=&]*|ref|fbclid|gclid"
#: Odd 31-bit factors, one for each word of a block, derived by a rule from the golden ratio.
FACTORS = [(0x9E3779B1 * (2 * word + 1)) & 0x7FFFFFFF | 1 for word in range(8)]
#: Listed URLs for each block: 256 bits for 16 URLs, some 0.1 % false positives.
URLS_A_BLOCK = 16
#: Most blocks: 65,536 x 72 bytes, below 5 MB, is what may be broadcast. A longer list fills the
#: blocks more and sends more URLs to the join, which stays exact.
MOST_BLOCKS = 1 << 16


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, "://([^/?#]*)", 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(url: Column) -> Column:
    """Host without ``www.`` or ``m.``, path without a final ``/`` or ``.html``, query without tracking.

    Scheme and fragment are left out. Null for a null url or one without a host.
    """
    host = F.regexp_replace(host_of(url), "^(www|m)\\.", "")
    path = F.regexp_replace(F.regexp_replace(path_of(url), "/+$", ""), "\\.html?$", "")
    query = F.regexp_extract(url, "^[^?#]*\\?([^#]*)", 1)
    kept = F.regexp_replace(F.concat(F.lit("&"), query), f"&({TRACKING})(=[^&]*)?(?=&|$)", "")
    rest = F.regexp_replace(kept, "^&+", "")
    whole = F.concat(host, path, F.when(rest != "", F.concat(F.lit("?"), rest)).otherwise(""))
    return F.when(host != "", whole)


def rule_of(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule (verdict, host, path) that fits; null where none does.

    A rule fits its host and all subdomains if the path starts with the rule's. Rules are a short
    setting and become one expression.
    """
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for say, name, start in sorted(rules, key=lambda r: (len(r[1] + r[2]), r)):
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(start)
        rule = F.when(fits, F.lit(name + start)).otherwise(rule)
        verdict = F.when(fits, F.lit(say)).otherwise(verdict)
    return rule, verdict


def _hash(url: Column) -> Column:
    return F.xxhash64(url)


def _block(url: Column, blocks: int) -> Column:
    return F.pmod(F.shiftright(_hash(url), 32), F.lit(blocks))


def _bits(url: Column) -> list[Column]:
    """One bit for each word of the block: the five highest of a 32-bit product, without overflow."""
    low = _hash(url).bitwiseAND(F.lit(0x7FFFFFFF))
    return [
        F.call_function("shiftleft", F.lit(1), F.shiftright((low * F.lit(factor)).bitwiseAND(F.lit(0xFFFFFFFF)), 27).cast("int"))
        for factor in FACTORS
    ]


def bloom(listed: DataFrame, blocks: int) -> DataFrame:
    """(block, w0 .. w7) of the distinct urls ``listed`` (canonical_url)."""
    named = [bit.alias(f"w{i}") for i, bit in enumerate(_bits(F.col("canonical_url")))]
    rows = listed.select(_block(F.col("canonical_url"), blocks).alias("block"), *named)
    return rows.groupBy("block").agg(*(F.bit_or(f"w{i}").alias(f"w{i}") for i in range(8)))


def judge(pages: DataFrame, listed: DataFrame, rules: list[tuple[str, str, str]]) -> DataFrame:
    """(page_id, host, path, rule, verdict, canonical_url, listed) of every row of ``pages`` (page_id, url).

    ``listed`` (canonical_url) are blocked URLs; nulls in it are passed over. The verdict is the
    rule's, else ``block`` for a listed URL, else ``allow``. A null url, or one without ``://``, has
    empty host and path, no rule and ``allow``. Repeated rows give repeated results. Either table
    may be empty.
    """
    unique = cut_lineage(columns(listed, "canonical_url").where("canonical_url IS NOT NULL").distinct())
    blocks = 1 << max(0, min(MOST_BLOCKS, -(-unique.count() // URLS_A_BLOCK)) - 1).bit_length()
    rows = columns(pages, "page_id", "url").select(
        F.col("page_id").cast("long").alias("page_id"),
        host_of(F.col("url")).alias("host"),
        path_of(F.col("url")).alias("path"),
        canonical(F.col("url")).alias("canonical_url"),
    )
    # At most MOST_BLOCKS rows, so every task may have them all.
    blocked = F.broadcast(bloom(unique, blocks).withColumnRenamed("block", "__block"))
    probed = rows.withColumn("__at", _block(F.col("canonical_url"), blocks)).join(blocked, F.col("__at") == F.col("__block"), "left")
    passes = F.lit(True)
    for i, bit in enumerate(_bits(F.col("canonical_url"))):
        passes = passes & (F.col(f"w{i}").bitwiseAND(bit) == bit)
    probed = probed.select("page_id", "host", "path", "canonical_url", F.coalesce(passes, F.lit(False)).alias("__maybe"))
    exact = unique.select(F.col("canonical_url"), F.lit(True).alias("listed"))
    hits = probed.where("__maybe").join(exact, "canonical_url", "left").withColumn("listed", F.coalesce("listed", F.lit(False)))
    misses = probed.where("NOT __maybe").withColumn("listed", F.lit(False))
    both = hits.unionByName(misses)
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    return both.select(
        "page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, F.when(F.col("listed"), BLOCK).otherwise(ALLOW)).alias("verdict"), "canonical_url", "listed"
    )
