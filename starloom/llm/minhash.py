"""Near-duplicate documents: universal hash minima in bands, verified signatures and sets, and connected components.

Documents with the same shingle set form a class, named by its smallest doc_id, and only classes are compared. In each
bucket of a band, members are first compared with its smallest and a few others; what these links join needs no further
test. In the end all members of a bucket that are in different
components, and whose signatures allow it, are compared. So a large group of near copies costs a few tests for each
member and bucket, and no link between components is left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import mix64, text_bytes, text_slices
from starloom.llm.graph import components
from starloom.llm.urls import bloom_filter, may_hold
from starloom.session import materialize

#: Longs that hold one bit of every minimum; a signature has two such planes, so two bits of every minimum.
SKETCH_LONGS = 4
#: Longs at the begin of a long signature that are compared first, as columns of their own.
FIRST_LONGS = 32


@dataclass(frozen=True)
class Settings:
    """A pair of similarity 0.75 shares no band with probability (1 - 0.75 ** rows) ** bands = 2e-6."""

    size: int = 5
    percent: int = 75
    bands: int = 48
    rows: int = 5
    stars: int = 2
    fine: int = 4096
    seed: int = 7

    def least(self, n: int) -> int:
        """Of n minima, those with equal signature bits; a pair at the threshold has fewer with probability 3e-6 (4.5
        deviations). 240 minima tell 0.6 from 0.75, 4,096 tell 0.71 from it."""
        p = (1 + 3 * self.percent / 100) / 4
        return int(n * p - 4.5 * (n * p * (1 - p)) ** 0.5)


def shingle_sets(column: pa.Array, size: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of the shingles of each text: A-Z lower-cased, fewer than `size` words as one."""
    flat, ends = text_bytes(column)
    lower = np.arange(256, dtype=np.uint8)
    lower[65:91] += 32
    flat = lower[flat]
    word = (flat != 32) & ((flat < 9) | (flat > 13))
    n = len(flat)
    first = np.empty(n, bool)
    last = np.empty(n, bool)
    if n:
        first[0], last[-1] = True, True
        first[1:], last[:-1] = ~word[:-1], ~word[1:]
        cut = ends[(ends > 0) & (ends < n)]
        first[cut], last[cut - 1] = True, True
    begin, stop = np.flatnonzero(word & first), np.flatnonzero(word & last) + 1
    with np.errstate(over="ignore"):
        base, inverse = np.uint64(0x9E3779B97F4A7C15), np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
        power = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, base)]), dtype=np.uint64)
        prefix = np.concatenate([[np.uint64(0)], np.cumsum((flat.astype(np.uint64) + np.uint64(1)) * power[:n], dtype=np.uint64)])
        undo = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, inverse)]), dtype=np.uint64)
        words = mix64((prefix[stop] - prefix[begin]) * undo[begin] + (stop - begin).astype(np.uint64))
        odd = mix64(np.arange(1, size + 2, dtype=np.uint64)) | np.uint64(1)
        runs = len(words) - size + 1
        grams = sum((words[i : i + runs] * odd[i] for i in range(size)), np.zeros(max(runs, 0), np.uint64)) if runs > 0 else np.zeros(0, np.uint64)
        grams = mix64(grams)
        bounds = np.concatenate([[0], np.searchsorted(begin, ends)])
        out = []
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            if b - a >= size:
                out.append(np.unique(grams[a : b - size + 1]))
            elif b > a:
                out.append(mix64(np.sum(words[a:b] * odd[: b - a], keepdims=True, dtype=np.uint64) + odd[size] * np.uint64(b - a)))
            else:
                out.append(np.zeros(0, np.uint64))
    return out


def _signatures(sets: list[np.ndarray], s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Band keys and packed signature bits of non-empty sets."""
    draw = np.random.default_rng(s.seed)
    n = s.bands * s.rows
    a, b = draw.integers(0, 1 << 32, n, dtype=np.uint32) | np.uint32(1), draw.integers(0, 1 << 32, n, dtype=np.uint32)
    flat = (np.concatenate(sets) >> np.uint64(32)).astype(np.uint32)
    starts = np.concatenate([[0], np.cumsum([len(x) for x in sets])[:-1]])
    minima = np.empty((n, len(sets)), np.uint32)
    hashed = np.empty_like(flat)
    with np.errstate(over="ignore"):
        for i in range(n):
            np.multiply(flat, a[i], out=hashed)
            np.add(hashed, b[i], out=hashed)
            np.minimum.reduceat(hashed, starts, out=minima[i])
        keys = np.zeros((s.bands, len(sets)), np.uint64)
        for i in range(n):
            band = i // s.rows
            keys[band] = mix64(keys[band] * np.uint64(0x9E3779B97F4A7C15) + minima[i] + np.uint64(band + 1))
    # The lowest bits of a multiple follow those of the factor, so each minimum is mixed first.
    bits, mixed = np.zeros((2, SKETCH_LONGS * 64, len(sets)), np.uint8), mix64(minima.astype(np.uint64) + (np.arange(n, dtype=np.uint64) << np.uint64(32))[:, None])
    bits[0, :n], bits[1, :n] = mixed & np.uint64(1), (mixed >> np.uint64(1)) & np.uint64(1)
    bits = bits.reshape(2 * SKETCH_LONGS * 64, len(sets))
    return keys.T.copy(), np.packbits(bits, axis=0).T.copy().view(np.int64)


def _fine_signatures(sets: list[np.ndarray], s: Settings) -> np.ndarray:
    """Long signatures of non-empty sets: two bits of each of `fine` minima, in neighbouring bits of 64-bit numbers."""
    draw = np.random.default_rng(s.seed + 1)
    a, b = draw.integers(0, 1 << 32, s.fine, dtype=np.uint32) | np.uint32(1), draw.integers(0, 1 << 32, s.fine, dtype=np.uint32)
    flat = (np.concatenate(sets) >> np.uint64(32)).astype(np.uint32)
    starts = np.concatenate([[0], np.cumsum([len(x) for x in sets])[:-1]])
    out, hashed = np.zeros((-(-s.fine // 32), len(sets)), np.uint64), np.empty_like(flat)
    for i in range(s.fine):
        np.multiply(flat, a[i], out=hashed)
        np.add(hashed, b[i], out=hashed)
        mixed = mix64(np.minimum.reduceat(hashed, starts).astype(np.uint64) + np.uint64(i << 32))
        out[i // 32] |= (mixed & np.uint64(3)) << np.uint64(2 * (i % 32))
    return out.T.copy().view(np.int64)


def _texts_of(ids: DataFrame, documents: DataFrame) -> DataFrame:
    """(id, text) of the documents that `ids` (id) may name; an exact join must follow."""
    blocks = 4096  # 256 KiB, whatever the number of ids: beyond it only more texts pass on to the exact join
    words = bloom_filter(ids, "id", blocks).scalar()
    return documents.select(documents["doc_id"].cast("bigint").alias("id"), documents["text"]).where(may_hold(words, F.col("id"), blocks))


def fine_signatures(ids: DataFrame, documents: DataFrame, s: Settings) -> DataFrame:
    """id, fine: the long signature of each listed id; null, which agrees with all, where rows of one id differ in text."""
    texts = _texts_of(ids, documents).join(ids, "id").groupBy("id").agg(F.min("text").alias("a"), F.max("text").alias("b"))
    texts = texts.select("id", F.when(F.col("a") == F.col("b"), F.col("a")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, limit=1 << 20):
            sets = shingle_sets(batch.column("text"), s.size)
            signed, full = [None] * len(sets), [k for k, x in enumerate(sets) if len(x)]
            if full:
                for k, x in zip(full, _fine_signatures([sets[k] for k in full], s), strict=True):
                    signed[k] = x
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(signed, pa.list_(pa.int64()))], ["id", "fine"])

    return texts.mapInArrow(run, "id bigint, fine array<bigint>")


def signatures(documents: DataFrame, s: Settings) -> DataFrame:
    """doc_id, n_shingles, two hashes of the shingle set, band keys and signature bits of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, limit=1 << 20):
            sets = shingle_sets(batch.column("text"), s.size)
            full = [k for k, x in enumerate(sets) if len(x)]
            bands, bits = [None] * len(sets), [None] * len(sets)
            if full:
                keys, packed = _signatures([sets[k] for k in full], s)
                for k, x, y in zip(full, keys.view(np.int64), packed, strict=True):
                    bands[k], bits[k] = x, y
            with np.errstate(over="ignore"):
                one = [int(np.sum(mix64(x), dtype=np.uint64).astype(np.int64)) for x in sets]
                two = [int(np.sum(mix64(x ^ np.uint64(0xD6E8FEB86659FD93)), dtype=np.uint64).astype(np.int64)) for x in sets]
            columns = [batch.column("doc_id"), pa.array([len(x) for x in sets], pa.int64()), pa.array(one, pa.int64()), pa.array(two, pa.int64()), pa.array(bands, pa.list_(pa.int64())), pa.array(bits, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_shingles", "one", "two", "bands", "bits"])

    schema = "doc_id bigint, n_shingles bigint, one bigint, two bigint, bands array<bigint>, bits array<bigint>"
    return documents.select(documents["doc_id"].cast("bigint"), documents["text"]).mapInArrow(run, schema)


def _agreeing(s: Settings):
    """Whether the sizes and signatures of x and y allow the similarity."""

    def differing(i: int):
        return F.bit_count(F.col("x.bits")[i].bitwiseXOR(F.col("y.bits")[i]).bitwiseOR(F.col("x.bits")[i + SKETCH_LONGS].bitwiseXOR(F.col("y.bits")[i + SKETCH_LONGS])))

    equal = s.bands * s.rows - sum((differing(i) for i in range(SKETCH_LONGS)), F.lit(0))
    return (100 * F.least("x.n", "y.n") >= s.percent * F.greatest("x.n", "y.n")) & (equal >= s.least(s.bands * s.rows))


def _unlike(word):
    """How many minima differ in an XOR of long signatures; two neighbouring bits belong to one minimum."""
    return F.bit_count(word.bitwiseOR(F.shiftrightunsigned(word, 1)).bitwiseAND(F.lit(0x5555555555555555)))


def _finely_agreeing(s: Settings):
    """Whether the long signatures of x and y allow the similarity: their first words alone, then all of them."""
    first = sum((_unlike(F.col(f"x.w{i}").bitwiseXOR(F.col(f"y.w{i}"))) for i in range(FIRST_LONGS)), F.lit(0))
    rest = F.aggregate(F.zip_with("x.fine", "y.fine", lambda a, b: a.bitwiseXOR(b)), first, lambda total, word: total + _unlike(word))
    agree = (32 * FIRST_LONGS - first >= s.least(32 * FIRST_LONGS)) & (s.fine - rest >= s.least(s.fine))
    return F.coalesce(agree, F.lit(True))


def verified(pairs: DataFrame, documents: DataFrame, s: Settings) -> DataFrame:
    """Those of the stored `pairs` (u, v) whose full shingle sets reach the similarity; only texts named in a pair are shuffled."""
    named = pairs.select(F.col("u").alias("id")).union(pairs.select(F.col("v").alias("id"))).distinct()
    texts = _texts_of(named, documents)
    right = pairs.join(texts, F.col("v") == F.col("id")).select("u", "v", F.col("text").alias("other"))
    both = right.join(texts, F.col("u") == F.col("id")).select("u", "v", "text", "other")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, ("text", "other"), 1 << 20):
            firsts = batch.column("text").dictionary_encode()
            known, other = shingle_sets(firsts.dictionary, s.size), shingle_sets(batch.column("other"), s.size)
            same = []
            for k, y in zip(firsts.indices.to_pylist(), other, strict=True):
                x = known[k]
                common = len(x) + len(y) - len(np.union1d(x, y))
                same.append(100 * common >= s.percent * (len(x) + len(y) - common) > 0)
            yield pa.RecordBatch.from_arrays([batch.column("u"), batch.column("v")], ["u", "v"]).filter(pa.array(same, pa.bool_()))

    return materialize(both.mapInArrow(run, "u bigint, v bigint").distinct())


def near_duplicates(documents: DataFrame, s: Settings = Settings()) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of documents (doc_id, text); repeated rows stay.

    Null and empty texts have no shingles and are linked with nothing: their component_id is their doc_id. A row
    without doc_id can't name a component: if its text has no class with a doc_id, component_id is null and kept true.
    Rows with one doc_id and different texts are judged each by its text. Other columns are left out.
    """
    found = materialize(signatures(documents, s))
    full = found.where("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = materialize(full.groupBy("one", "two", "n_shingles").agg(F.min("doc_id").alias("id")))
    reps = full.join(classes.select("id", F.col("one").alias("c1"), F.col("two").alias("c2")), (F.col("doc_id") == F.col("id")) & (F.col("one") == F.col("c1")) & (F.col("two") == F.col("c2")))
    members = reps.select(F.explode("bands").alias("key"), "id")
    buckets = members.groupBy("key").agg(F.min("id").alias("lead"), F.max("id").alias("most")).where("lead < most").select("key", "lead")
    shared = materialize(members.join(buckets, "key"))
    bits = materialize(reps.select("id", F.col("n_shingles").alias("n"), "bits").dropDuplicates(["id"]))
    leads = F.array_distinct(F.array(F.first("lead"), *[F.min_by("id", F.xxhash64("id", F.lit(k))) for k in range(s.stars)]))
    stars = shared.join(shared.groupBy("key").agg(leads.alias("leads")), "key").select("id", F.explode("leads").alias("lead")).where("id != lead")
    stars = stars.select(F.least("id", "lead").alias("u"), F.greatest("id", "lead").alias("v")).distinct()
    tried = materialize(stars.join(bits.alias("x"), F.col("u") == F.col("x.id")).join(bits.alias("y"), F.col("v") == F.col("y.id")).where(_agreeing(s)).select("u", "v"))
    links = verified(tried, documents, s)
    joined = components(links)
    # Buckets whose members are not all joined by now, with what their signatures tell.
    placed = shared.select("key", "id").distinct().join(joined, "id", "left").withColumn("root", F.coalesce("root", "id"))
    mixed = placed.groupBy("key").agg(F.min("root").alias("a"), F.max("root").alias("b")).where("a < b").select("key")
    left = materialize(placed.join(mixed, "key").select("key", "id", "root"))
    fine = materialize(fine_signatures(left.select("id").distinct(), documents, s))
    words = [F.get("fine", F.lit(i)).alias(f"w{i}") for i in range(FIRST_LONGS)]
    rest = F.slice("fine", FIRST_LONGS + 1, -(-s.fine // 32)).alias("fine")
    rows = materialize(left.join(bits, "id").join(fine, "id").select("key", "id", "root", "n", "bits", *words, rest))
    x, y = rows.alias("x"), rows.alias("y")
    pairs = x.join(y, (F.col("x.key") == F.col("y.key")) & (F.col("x.root") < F.col("y.root")) & _agreeing(s) & _finely_agreeing(s))
    pairs = pairs.select(F.least("x.id", "y.id").alias("u"), F.greatest("x.id", "y.id").alias("v")).distinct()
    fresh = verified(materialize(pairs.join(tried, ["u", "v"], "left_anti")), documents, s)
    roots = joined if fresh.isEmpty() else components(links.union(fresh))
    named = classes.join(roots, "id", "left").select(F.col("one").alias("c1"), F.col("two").alias("c2"), F.col("n_shingles").alias("c3"), F.coalesce("root", "id").alias("root"))
    out = found.join(named, (F.col("one") == F.col("c1")) & (F.col("two") == F.col("c2")) & (F.col("n_shingles") == F.col("c3")) & (F.col("n_shingles") > 0), "left")
    component = F.coalesce("root", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, component.isNull()).alias("kept"))


def distinct_documents(documents: DataFrame, s: Settings = Settings()) -> DataFrame:
    """The row that stands for each group, with its own columns; rows that share a doc_id count as one document.

    Of rows that share a doc_id, the one whose text has the least hash stays. A row without a doc_id takes part with a
    number from the hash of its text above 2^62, so it gives way to every document with a smaller doc_id, and copies
    among such rows are one document.
    """
    stand_in = F.lit(1 << 62) + F.coalesce(F.xxhash64("_text"), F.lit(0)).bitwiseAND(F.lit((1 << 62) - 1))
    rows = documents.select(documents["text"].alias("_text"), documents["doc_id"].cast("bigint").alias("_own"), F.struct(*[documents[c] for c in documents.columns]).alias("_row"))
    rows = rows.withColumn("_id", F.coalesce("_own", stand_in))
    kept = near_duplicates(rows.select(F.col("_id").alias("doc_id"), F.col("_text").alias("text")), s).where("kept").select(F.col("doc_id").alias("_kept_id")).distinct()
    return rows.join(kept, F.col("_id") == F.col("_kept_id"), "left_semi").groupBy("_id").agg(F.min_by("_row", F.xxhash64("_text")).alias("_row")).select("_row.*")
