"""URL filters: a blocked Bloom filter of listed prefixes passes possible hits on to an exact join.

A listed entry is a host and a path; it fits a URL whose host is the entry's host or a subdomain of it and whose path
starts with the entry's path. The candidates of a URL are its host suffixes, with as many labels as some entry has,
joined with its path prefixes, as long as some entry's. Each candidate is probed in the filter; only URLs with a
positive candidate reach the join, which removes false positives. Everything is built-in expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import LOWER, UPPER

URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
#: Bits that a key sets in its block, and 64-bit words of a block.
PROBES, BLOCK_WORDS = 6, 8


def url_host(url: Column) -> Column:
    """Host, A-Z lower-cased; empty for null and without `://`."""
    return F.coalesce(F.translate(F.regexp_extract(url, URL, 1), UPPER, LOWER), F.lit(""))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, URL, 2), F.lit(""))


def _unescaped(part: Column) -> Column:
    """Percent escapes decoded once; a % that begins none, and +, stay as they are."""
    plain = F.regexp_replace(F.regexp_replace(part, "%(?![0-9A-Fa-f]{2})", "%25"), r"\+", "%2B")
    return F.coalesce(F.try_url_decode(plain), part)


def canonical_host(host: Column) -> Column:
    """Host without user part, port and trailing dots, escapes decoded, A-Z lower-cased."""
    name = _unescaped(F.regexp_replace(F.regexp_replace(host, "(?s)^.*@", ""), ":[0-9]*$", ""))
    return F.regexp_replace(F.translate(name, UPPER, LOWER), r"\.+$", "")


def canonical_path(path: Column) -> Column:
    """Path with its escapes decoded."""
    return _unescaped(path)


def _bit(key: Column, i: int) -> Column:
    """The i-th bit of a key inside its block of 512 bits."""
    return F.shiftrightunsigned(F.xxhash64(key, F.lit("bits")), 9 * i).bitwiseAND(511).cast("int")


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int")


def bloom_filter(keys: DataFrame, column: str, blocks: int) -> DataFrame:
    """One row with the array `words` of `blocks * 8` longs, aggregated from partial ORs."""
    key = F.col(column)
    position = F.explode(F.array([_block(key, blocks) * 512 + _bit(key, i) for i in range(PROBES)]))
    bits = keys.select(position.alias("at")).groupBy(F.shiftright("at", 6).alias("word")).agg(F.expr("bit_or(shiftleft(1L, at & 63))").alias("bits"))
    every = keys.sparkSession.range(blocks * BLOCK_WORDS).select(F.col("id").cast("int").alias("word"))
    filled = every.join(bits, "word", "left").select(F.struct("word", F.coalesce("bits", F.lit(0)).alias("bits")).alias("w"))
    return filled.agg(F.transform(F.array_sort(F.collect_list("w")), lambda w: w["bits"]).alias("words"))


def may_hold(words: Column, key: Column, blocks: int) -> Column:
    """Whether all bits of the key are set; false answers are always right."""
    found = F.lit(True)
    for i in range(PROBES):
        at = _block(key, blocks) * 512 + _bit(key, i)
        found = found & (F.expr("1L") == F.call_function("shiftright", F.element_at(words, F.shiftright(at, 6) + 1), at.bitwiseAND(63)).bitwiseAND(1))
    return found


def with_listing(urls: DataFrame, url: str, listed: DataFrame, bits_per_key: int = 16, most_blocks: int = 2048, canonical: bool = False) -> DataFrame:
    """Distinct (host, path) of `urls` with the longest fitting entry of `listed` (host, path, verdict).

    Returns host, path, rule, verdict; rule and verdict are null where nothing fits. The longest entry is that with
    the longest host and path together, then the longer host; an entry listed with two verdicts blocks. Null URLs and
    URLs without `://` have empty host and path, which no entry fits. With `canonical`, entries are fitted to the
    canonical host and path (user part, port and trailing dots left out, escapes decoded); those returned are as written. Entries with a null host or path are ignored.
    An empty list fits nothing. The filter has at most `most_blocks` blocks of 64 bytes (128 KiB by default): a longer
    list only makes it less selective. The number of distinct label counts and path lengths of the list (both bounded
    by the length of a URL) is read on the driver; its entries are not.
    """
    entries = (
        listed.where(F.col("host").isNotNull() & F.col("path").isNotNull())
        .select(F.concat("host", "path").alias("rule"), F.size(F.split("host", r"\.")).alias("labels"), F.length("path").alias("size"), F.length("host").alias("wide"), "verdict")
        .groupBy("rule", "labels", "size", "wide")
        .agg(F.max("verdict").alias("verdict"))
    )
    shape = entries.agg(F.count("*").alias("n"), F.collect_set(F.struct("labels", "size")).alias("kinds")).first()
    kinds = sorted((k["labels"], k["size"]) for k in shape["kinds"]) or [(1, 1)]
    blocks = min(most_blocks, max(1, -(-shape["n"] * bits_per_key // 512)))
    words = bloom_filter(entries, "rule", blocks).scalar()
    parts = urls.select(url_host(F.col(url)).alias("host"), url_path(F.col(url)).alias("path")).distinct()
    parts = parts.withColumns({"probe": canonical_host(F.col("host")), "route": canonical_path(F.col("path"))} if canonical else {"probe": F.col("host"), "route": F.col("path")})
    label = F.split("probe", r"\.")
    kind = F.array([F.struct(F.lit(a).alias("labels"), F.lit(b).alias("size")) for a, b in kinds])
    candidates = F.transform(
        F.filter(kind, lambda k: (F.size("label") >= k["labels"]) & (F.length("route") >= k["size"])),
        lambda k: F.struct(
            F.concat(F.array_join(F.slice("label", F.size("label") - k["labels"] + 1, k["labels"]), "."), F.substring(F.col("route"), F.lit(1), k["size"])).alias("key"),
            k["labels"].alias("labels"),
            k["size"].alias("size"),
        ),
    )
    hits = (
        parts.withColumn("label", label)
        .select("host", "path", F.explode(candidates).alias("c"))
        .select("host", "path", F.col("c.key").alias("rule"), F.col("c.labels").alias("labels"), F.col("c.size").alias("size"))
        .where(may_hold(words, F.col("rule"), blocks))
    )
    best = F.max_by(F.struct("rule", "verdict"), F.struct(F.length("rule"), F.col("wide")))
    return (
        hits.join(entries, ["rule", "labels", "size"])
        .groupBy("host", "path")
        .agg(best.alias("best"))
        .select("host", "path", "best.rule", "best.verdict")
    )


def judge_urls(pages: DataFrame, rules: DataFrame, listed: DataFrame, default: str = "allow") -> DataFrame:
    """Every row of pages (page_id, url) with host, path, the longest fitting rule and a verdict.

    The verdict is the rule's, else that of the longest entry of `listed` that fits its canonical form, else `default`.
    Repeated rows stay.
    """
    first = with_listing(pages, "url", rules)
    second = with_listing(pages, "url", listed, canonical=True).select("host", "path", F.col("verdict").alias("listed_verdict"))
    return (
        pages.select("page_id", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
        .join(first, ["host", "path"], "left")
        .join(second, ["host", "path"], "left")
        .select("page_id", "host", "path", "rule", F.coalesce("verdict", "listed_verdict", F.lit(default)).alias("verdict"))
    )
