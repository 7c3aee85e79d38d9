"""Phrase collocations by SON partitioning.

A phrase that occurs `support` times in a language occurs at least support / shards times in one of the shards. Every
shard is mined completely, level by level, at that lowered support; the union of what is frequent in some shard are the
candidates, and a last pass counts all of them exactly over all documents.

A shard is a set of input partitions and is mined by many tasks: these count hashed phrases in numpy, the counts are
summed by shard and hash, and the hashes that reach the local support set bits of a blocked filter. Its size follows the
text up to a stated bound, so it can be broadcast; false hits of hashes or bits only add candidates, which the exact
count on the words themselves removes. Scores are exact decimals.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.common import mix64, text_bytes, text_slices
from starloom.session import materialize

#: Kinds of bytes: 0 in a word, 1 between words, 2 between pieces.
KIND = np.zeros(256, np.uint8)
KIND[[0x20, 0x09]] = 1
KIND[[*b".,;:!?", *range(0x0A, 0x0E)]] = 2
#: Bits of one block of a filter, and bits that a hash sets in its block.
BLOCK_BITS, PROBES = 8192, 2
#: A filter has at most so many bits (128 MiB), which bounds what is broadcast.
MOST_BITS = 1 << 30
#: Counters that a task keeps before it passes them on.
KEPT_KEYS = 1_500_000
#: Bytes of text that a task looks at together.
SLICE = 3 << 20


@dataclass(frozen=True)
class Settings:
    """Least count, longest phrase in words, share in percent at which a longer phrase absorbs a part, rows per language."""

    support: int = 10
    longest: int = 3
    absorbed: int = 50
    top: int = 2000
    shards: int = 3

    @property
    def local_support(self) -> int:
        """support / shards, rounded up: who stays below it in every shard stays below `support` in all."""
        return -(-self.support // self.shards)


def _string_hashes(words: pa.Array) -> np.ndarray:
    """64-bit hashes of strings, the same wherever the string lies."""
    flat, ends = text_bytes(words)
    starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
    base, inverse = np.uint64(0x9E3779B97F4A7C15), np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
    with np.errstate(over="ignore"):
        power = np.cumprod(np.concatenate([[np.uint64(1)], np.full(len(flat), base)]), dtype=np.uint64)
        prefix = np.concatenate([[np.uint64(0)], np.cumsum((flat.astype(np.uint64) + np.uint64(1)) * power[:-1], dtype=np.uint64)])
        undo = np.cumprod(np.concatenate([[np.uint64(1)], np.full(len(flat), inverse)]), dtype=np.uint64)
        return mix64((prefix[ends] - prefix[starts]) * undo[starts] + (ends - starts).astype(np.uint64))


@dataclass
class _Words:
    """The words of some texts in order: codes into `names`, the piece and the language of each, hashes by word."""

    names: pa.Array
    codes: np.ndarray
    pieces: np.ndarray
    langs: list[str]
    lang: np.ndarray
    hashes: np.ndarray
    salts: np.ndarray

    def holds(self, size: int) -> np.ndarray:
        """Where a phrase of `size` words of one piece starts."""
        n = max(len(self.codes) - size + 1, 0)
        return self.pieces[:n] == self.pieces[size - 1 : size - 1 + n]

    def keys(self, size: int) -> np.ndarray:
        """Hashes of the phrases of `size` words that start at each word, with their language."""
        n = max(len(self.codes) - size + 1, 0)
        odd = mix64(np.arange(1, size + 2, dtype=np.uint64)) | np.uint64(1)
        with np.errstate(over="ignore"):
            total = self.salts[:n] * odd[size]
            for i in range(size):
                total = total + self.hashes[i : i + n] * odd[i]
        return mix64(total)


def _words(batch: pa.RecordBatch) -> _Words:
    """Words of a batch (lang, text), its texts ordered by language; A-Z are lower-cased, null texts are empty."""
    coded = batch.column("lang").dictionary_encode()
    order = np.argsort(coded.indices.to_numpy(zero_copy_only=False), kind="stable")
    doc_lang = coded.indices.to_numpy(zero_copy_only=False)[order]
    flat, ends = text_bytes(batch.column("text").take(pa.array(order)))
    lower = np.arange(256, dtype=np.uint8)
    lower[65:91] += 32
    flat = lower[flat]
    kind = KIND[flat]
    inside = kind == 0
    first, last = inside.copy(), inside.copy()
    if len(flat):
        first[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
        cut = ends[(ends > 0) & (ends < len(flat))]
        first[cut], last[cut - 1] = inside[cut], inside[cut - 1]
    begin, stop = np.flatnonzero(first), np.flatnonzero(last) + 1
    offsets = np.concatenate([[0], np.cumsum(stop - begin)]).astype(np.int32)
    joined = pa.StringArray.from_buffers(len(begin), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(flat[inside])))
    named = joined.dictionary_encode()
    codes = named.indices.to_numpy(zero_copy_only=False)
    docs = np.searchsorted(ends, begin, side="right")
    pieces = np.cumsum(kind == 2, dtype=np.int32)[begin].astype(np.int64) + docs
    langs = coded.dictionary
    lang = doc_lang[docs].astype(np.int64) if len(docs) else np.zeros(0, np.int64)
    salts = _string_hashes(langs)[lang] if len(lang) else np.zeros(0, np.uint64)
    return _Words(named.dictionary, codes, pieces, langs.to_pylist(), lang, _string_hashes(named.dictionary)[codes] if len(codes) else np.zeros(0, np.uint64), salts)


def _block(keys: np.ndarray, bits: int) -> np.ndarray:
    return (keys % np.uint64(bits // BLOCK_BITS)).astype(np.int64)


def _probes(keys: np.ndarray, kind: int) -> list[np.ndarray]:
    """Bits of the keys in their blocks; `kind` tells the shards and their union apart."""
    with np.errstate(over="ignore"):
        mixed = mix64(keys + np.uint64(kind + 1) * np.uint64(0x9E3779B97F4A7C15))
    return [(mixed >> np.uint64(13 * i)).astype(np.int64) & (BLOCK_BITS - 1) for i in range(PROBES)]


def _may_hold(bits: np.ndarray, keys: np.ndarray, kind: int) -> np.ndarray:
    """Whether the filter may hold each key; never false for a key that was put in."""
    at, found = _block(keys, len(bits) * 8) * BLOCK_BITS, np.ones(len(keys), bool)
    for probe in _probes(keys, kind):
        place = at + probe
        found &= (bits[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1
    return found


def _summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys with their counts."""
    keys, counts = np.concatenate([k for k, _ in parts]), np.concatenate([c for _, c in parts])
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[starts], np.add.reduceat(counts[order], starts) if len(starts) else counts


def _mined(texts: DataFrame, size: int, bits: int, s: Settings, below) -> DataFrame:
    """union, block, bits: filters of the phrases of `size` words that are frequent in a shard, and of their union.

    `below` broadcasts the first filter for phrases one word shorter; a phrase is counted in a shard only if both its
    parts of that size may be frequent there.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, held, parts = TaskContext.get().partitionId() % s.shards, 0, []

        def out(keys: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
            columns = [_block(keys, bits).astype(np.int32), np.full(len(keys), shard, np.int32), keys.view(np.int64), counts]
            return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["block", "shard", "key", "n"])

        for batch in text_slices(batches, limit=SLICE):
            words = _words(batch)
            ok = words.holds(size)
            if below is not None:
                fit = _may_hold(below.value, words.keys(size - 1), shard)
                ok &= fit[: len(ok)] & fit[1 : 1 + len(ok)]
            keys, counts = np.unique(words.keys(size)[ok], return_counts=True)
            parts.append((keys, counts.astype(np.int64)))
            held += len(keys)
            if held > KEPT_KEYS:
                parts = [_summed(parts)]
                held = len(parts[0][0])
                if held > KEPT_KEYS // 2:
                    yield out(*parts[0])
                    held, parts = 0, []
        if parts:
            yield out(*_summed(parts))

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks: dict[tuple[bool, int], np.ndarray] = {}
        for batch in batches:
            shards, places = batch.column("shard").to_numpy(), batch.column("block").to_numpy().astype(np.int64)
            keys = batch.column("key").to_numpy().view(np.uint64)
            for kind in [*np.unique(shards).tolist(), s.shards]:
                mine = slice(None) if kind == s.shards else shards == kind
                hits = np.unique(np.concatenate([places[mine] * BLOCK_BITS + p for p in _probes(keys[mine], kind)]))
                found, starts = np.unique(hits // BLOCK_BITS, return_index=True)
                for block, bits_set in zip(found.tolist(), np.split(hits % BLOCK_BITS, starts[1:]), strict=True):
                    blocks.setdefault((kind == s.shards, block), np.zeros(BLOCK_BITS, bool))[bits_set] = True
        if blocks:
            unions, numbers = zip(*blocks, strict=True)
            packed = [np.packbits(b, bitorder="little").tobytes() for b in blocks.values()]
            yield pa.RecordBatch.from_arrays([pa.array(unions), pa.array(numbers, pa.int32()), pa.array(packed, pa.binary())], ["union", "block", "bits"])

    counted = texts.mapInArrow(count, "block int, shard int, key bigint, n bigint").repartition("block")
    frequent = counted.groupBy("block", "shard", "key").agg(F.sum("n").alias("n")).where(F.col("n") >= s.local_support)
    return frequent.drop("n").mapInArrow(fill, "`union` boolean, block int, bits binary")


def _exact(texts: DataFrame, filters: dict[int, object], s: Settings) -> DataFrame:
    """lang, size, phrase, n: counts of all words and of all candidates, by the words themselves.

    Size 0 holds the number of words of a language.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, limit=SLICE):
            w = _words(batch)
            starts = np.searchsorted(w.lang, np.arange(len(w.langs) + 1))
            fits = {size: w.holds(size) & _may_hold(f.value, w.keys(size), s.shards) for size, f in filters.items()}
            n_names = len(w.names)
            for lang, a, b in zip(w.langs, starts[:-1].tolist(), starts[1:].tolist(), strict=True):
                if a == b:
                    continue
                found, counts = np.unique(w.codes[a:b], return_counts=True)
                yield _rows(lang, 1, w.names.take(pa.array(found)), counts)
                yield _rows(lang, 0, pa.array([""]), np.array([b - a]))
                for size, fit in fits.items():
                    at = a + np.flatnonzero(fit[a:b])
                    # Codes of prefixes, one word longer each time, stay below the square of the number of words.
                    prefix = w.codes[at].astype(np.int64)
                    columns = [w.codes[at + i] for i in range(size)]
                    for following in columns[1:]:
                        _, prefix = np.unique(prefix * n_names + following, return_inverse=True)
                    _, one, counts = np.unique(prefix, return_index=True, return_counts=True)
                    if len(one):
                        names = [w.names.take(pa.array(c[one])) for c in columns]
                        yield _rows(lang, size, pc.binary_join_element_wise(*names, " "), counts)

    def _rows(lang: str, size: int, phrases: pa.Array, counts: np.ndarray) -> pa.RecordBatch:
        n = len(phrases)
        columns = [pa.repeat(lang, n), pa.array(np.full(n, size, np.int32)), phrases, pa.array(counts.astype(np.int64))]
        return pa.RecordBatch.from_arrays(columns, ["lang", "size", "phrase", "n"])

    rows = texts.mapInArrow(count, "lang string, size int, phrase string, n bigint")
    return rows.groupBy("lang", "size", "phrase").agg(F.sum("n").alias("n"))


def phrase_counts(documents: DataFrame, s: Settings = Settings()) -> DataFrame:
    """lang, size, phrase, n: every word and every phrase of up to `longest` words that occurs `support` times or more.

    Size 0 holds the number of all words of a language. Null texts are empty, null languages are `und`, repeated rows
    count again. The counts are written to the shared folder.
    """
    texts = documents.select(F.coalesce(documents["lang"], F.lit("und")).alias("lang"), F.coalesce(documents["text"], F.lit("")).alias("text"))
    size = texts.agg(F.sum(F.length("text"))).first()[0] or 0
    # About one bit for eight characters, a power of two up to the bound.
    bits = min(MOST_BITS, max(1 << 20, 1 << (max(size, 8) // 8 - 1).bit_length()))
    context, filters, below = documents.sparkSession.sparkContext, {}, None
    for level in range(2, s.longest + 1):
        per_shard, union = np.zeros(bits // 8, np.uint8), np.zeros(bits // 8, np.uint8)
        # A block comes from one task; what is gathered are two filters of `bits` bits.
        for row in _mined(texts, level, bits, s, below).collect():
            (union if row.union else per_shard)[row.block * BLOCK_BITS // 8 : (row.block + 1) * BLOCK_BITS // 8] = np.frombuffer(row.bits, np.uint8)
        below, filters[level] = context.broadcast(per_shard), context.broadcast(union)
    counts = _exact(texts, filters, s).where((F.col("size") == 0) | (F.col("n") >= s.support))
    return materialize(counts)


def scored(counts: DataFrame, s: Settings = Settings()) -> DataFrame:
    """lang, phrase, a, l, r, score of the candidates that no longer candidate absorbs.

    Products are decimals of 38 digits, so scores are exact for counts below 10^16.
    """
    candidates = counts.where("size >= 2").select("lang", "size", "phrase", F.col("n").alias("a"), F.split("phrase", " ").alias("w"))
    cuts = F.flatten(F.transform(F.sequence(F.lit(1), F.col("size") - 1), lambda k: F.array(
        F.struct(k.alias("k"), F.lit(True).alias("left"), F.array_join(F.slice("w", 1, k), " ").alias("part")),
        F.struct(k.alias("k"), F.lit(False).alias("left"), F.array_join(F.slice("w", k + 1, F.col("size")), " ").alias("part")),
    )))
    parts = candidates.select("lang", "size", "phrase", "a", F.inline(cuts))
    known = counts.where("size >= 1").select("lang", F.col("phrase").alias("part"), F.col("n").alias("f"))
    found = parts.join(known, ["lang", "part"])
    sides = [c for k in range(1, s.longest) for c in (F.max(F.when((F.col("k") == k) & F.col("left"), F.col("f"))).alias(f"l{k}"), F.max(F.when((F.col("k") == k) & ~F.col("left"), F.col("f"))).alias(f"r{k}"))]
    cut = found.groupBy("lang", "size", "phrase", "a").agg(*sides)

    def score(k: int) -> Column:
        wide = {c: F.col(c).cast("decimal(19,0)") for c in ("a", f"l{k}", f"r{k}")}
        above = (wide["a"] * wide["a"]).cast("decimal(32,0)") * F.lit(1_000_000).cast("decimal(7,0)")
        return F.call_function("div", above.cast("decimal(38,0)"), (wide[f"l{k}"] * wide[f"r{k}"]).cast("decimal(38,0)"))

    options = F.filter(F.array(*[F.struct(score(k).alias("score"), F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r")) for k in range(1, s.longest)]), lambda x: x["score"].isNotNull())
    lowest = cut.withColumn("_cut", F.array_min(options)).select("lang", "phrase", "a", "_cut.l", "_cut.r", "_cut.score")
    within = F.flatten(F.transform(F.sequence(F.lit(2), F.col("size") - 1), lambda m: F.transform(F.sequence(F.lit(1), F.col("size") - m + 1), lambda i: F.array_join(F.slice("w", i, m), " "))))
    longer = candidates.where("size >= 3").select("lang", "a", F.explode(within).alias("phrase")).groupBy("lang", "phrase").agg(F.max("a").alias("most"))
    joined = lowest.join(longer, ["lang", "phrase"], "left")
    return joined.where(F.col("most").isNull() | (100 * F.col("most") < s.absorbed * F.col("a"))).drop("most")


def collocations(documents: DataFrame, s: Settings = Settings(), buckets: int = 64) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the first `top` phrases of each language of documents (lang, text).

    `a` is the count of the phrase, `l` and `r` are those of its parts at the cut of lowest score, `n` is the number of
    words of the language. Order: score descending, a descending, phrase in byte order. Null texts are empty, null
    languages are `und` (with those called so), repeated rows count again, an empty table gives no rows; other columns
    are not read. A language is ranked in `buckets` parts first, so its final ranking sees at most buckets * top rows.
    """
    counts = phrase_counts(documents, s)
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    rows = scored(counts, s).withColumn("_bucket", F.pmod(F.xxhash64("phrase"), F.lit(buckets)))
    rows = rows.withColumn("_place", F.row_number().over(Window.partitionBy("lang", "_bucket").orderBy(*order))).where(F.col("_place") <= s.top)
    ranked = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("bigint")).where(F.col("rank") <= s.top)
    totals = counts.where("size = 0").select("lang", "n")
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
