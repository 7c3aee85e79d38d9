"""Removal of repeated byte strings: sampled suffixes, range-partitioned and sorted, compared across documents.

A byte goes if a string of `span` bytes over it also starts in a document with a smaller doc_id. Two documents that
share such a string also share the suffix at its anchor, the least of the hashes of the `lead` byte strings in it, so
only suffixes at anchors are sorted. An anchor's context is all strings of `span` bytes that have this anchor.

1. Each task reduces its documents to fingerprints of anchors and contexts, and deals them out by fingerprint. Where
   contexts are equal, all but the smallest document repeat them whole. Where only anchors are equal, one document for
   each context has to be compared byte by byte.
2. Documents meet their marks. Contexts to be compared are range-partitioned by the leading bytes of their suffix, with
   splitters that Spark samples; no suffix with equal leading bytes lies across a boundary.
3. In each range the strings of the contexts are sorted by multikey quicksort, eight bytes at a time, and neighbours
   that are equal tell which document has a string first.
4. Documents with such strings are cut again with both kinds of repeats.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import mix64, text_bytes, text_slices
from starloom.llm.urls import bloom_filter, may_hold
from starloom.session import materialize

SPAN, LEAD = 50, 24
BASE = 0x9E3779B97F4A7C15
FULL, COMPARED = 1, 2
LOW = np.uint64(0xFFFFFFFF)


@dataclass(frozen=True)
class Settings:
    part_mb: int = 4  # text whose fingerprints, or which itself, one task holds, about
    slice_bytes: int = 1 << 18
    gathered: int = 1 << 18  # anchors that a task gathers before it deals them out
    contexts: int = 1 << 13  # contexts whose strings are sorted at once


@dataclass
class Anchors:
    """Of each anchor: its text, the first and last start of its strings, its own start, and two fingerprints."""

    text: np.ndarray
    first: np.ndarray
    last: np.ndarray
    at: np.ndarray
    suffix: np.ndarray
    context: np.ndarray

    @property
    def key(self) -> np.ndarray:
        return ((self.suffix & LOW) << np.uint64(32)) | (self.context & LOW)


def anchors_of(flat: np.ndarray, ends: np.ndarray) -> Anchors:
    """The anchors of texts that lie one after the other and end at `ends`."""
    n, none = len(flat), np.zeros(0, np.int64)
    if n < SPAN:
        return Anchors(none, none, none, none, none.astype(np.uint64), none.astype(np.uint64))
    with np.errstate(over="ignore"):
        runs, width = {1: flat.astype(np.uint64) + np.uint64(1)}, 1
        while width < 32:
            x = runs[width]
            runs[2 * width] = x[:-width] * np.uint64(pow(BASE, width, 1 << 64)) + x[width:]
            width *= 2
        count = n - LEAD + 1
        suffix = mix64(runs[16][:count] * np.uint64(pow(BASE, 8, 1 << 64)) + runs[8][16 : 16 + count])
        # The leftmost of the least hashes: the place breaks ties in the upper half of the hash.
        least, wide, window = (suffix & ~LOW) | np.arange(count, dtype=np.uint64), 1, SPAN - LEAD + 1
        while 2 * wide <= window:
            least, wide = np.minimum(least[:-wide], least[wide:]), 2 * wide
        starts = n - SPAN + 1
        least = np.minimum(least[:starts], least[window - wide : window - wide + starts])
        room = np.zeros(starts + SPAN, bool)
        for a, b in zip(np.concatenate([[0], ends[:-1]]).tolist(), ends.tolist(), strict=True):
            room[a : max(a, b - SPAN + 1)] = True
        place = np.flatnonzero(room[:starts])
        if not len(place):
            return Anchors(none, none, none, none, none.astype(np.uint64), none.astype(np.uint64))
        at = (least[place] & LOW).astype(np.int64)
        begin = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        first, last, at = place[begin], place[np.append(begin[1:], len(place)) - 1], at[begin]

        def whole(p: np.ndarray) -> np.ndarray:
            """Hash of the `SPAN` = 32 + 16 + 2 bytes at p."""
            return (runs[32][p] * np.uint64(pow(BASE, 16, 1 << 64)) + runs[16][p + 32]) * np.uint64(pow(BASE, 2, 1 << 64)) + runs[2][p + 48]

        # The first and the last string overlap, so they hold the whole context.
        context = mix64(mix64(whole(first)) + mix64(whole(last) + np.uint64(1)) * np.uint64(3) + ((last - first) * 64 + (at - first)).astype(np.uint64))
        return Anchors(np.searchsorted(ends, first, side="right"), first, last, at, suffix[at], context >> np.uint64(16))


def pack(x: np.ndarray) -> bytes:
    """Numbers as byte planes, in which sorted or small numbers compress well."""
    return np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.itemsize).T).tobytes()


def unpack(parts: list[bytes], kind) -> np.ndarray:
    size = np.dtype(kind).itemsize
    planes = [np.frombuffer(p, np.uint8).reshape(size, -1).T for p in parts]
    return np.ascontiguousarray(np.concatenate(planes)).view(kind).ravel() if planes else np.zeros(0, kind)


def _starts(*columns: np.ndarray) -> np.ndarray:
    """Where sorted columns change."""
    change = np.zeros(len(columns[0]), bool)
    change[:1] = True
    for c in columns:
        change[1:] |= c[1:] != c[:-1]
    return change


PACKED = pa.schema([("part", pa.int32()), ("kind", pa.int32()), ("x", pa.binary()), ("y", pa.binary()), ("z", pa.binary())])
PACKED_SQL = "part int, kind int, x binary, y binary, z binary"


def _dealt(part: np.ndarray, kind: int, x: np.ndarray, y: np.ndarray, z: np.ndarray) -> list[tuple]:
    """Rows of the packed columns for each part; x is sorted within a part."""
    order = np.lexsort((x, part))
    part, x, y, z = part[order], x[order], y[order], z[order]
    cuts = np.append(np.flatnonzero(_starts(part)), len(part)).tolist()
    return [(int(part[a]), kind, pack(x[a:b]), pack(y[a:b]), pack(z[a:b])) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def _table(rows: list[tuple]) -> pa.Table:
    return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), PACKED.types, strict=True)] if rows else [pa.array([], t) for t in PACKED.types], schema=PACKED)


def _place(doc: np.ndarray, parts: int) -> np.ndarray:
    return (mix64(doc.astype(np.int64).view(np.uint64)) % np.uint64(parts)).astype(np.int64)


def _fingerprints(documents: DataFrame, parts: int, s: Settings) -> DataFrame:
    """Packed anchors by fingerprint (parts 0 ...), and marks of documents (parts `parts` ...) known by now."""

    def dealt(gathered: list[tuple]) -> pa.Table:
        suffix, context, doc = (np.concatenate(c) for c in zip(*gathered, strict=True))
        order = np.lexsort((doc, context, suffix))
        suffix, context, doc = suffix[order], context[order], doc[order]
        one = _starts(suffix, context)
        smallest = np.repeat(doc[one], np.diff(np.append(np.flatnonzero(one), len(doc))))
        rows = _dealt(((suffix[one] >> np.uint64(32)) % np.uint64(parts)).astype(np.int64), 0, (suffix[one] & LOW).astype(np.uint32), context[one], doc[one])
        again = (doc > smallest) & _starts(suffix, context, doc)
        if again.any():
            key, doc = ((suffix[again] & LOW) << np.uint64(32)) | (context[again] & LOW), doc[again]
            rows += _dealt(parts + _place(doc, parts), 1, key, doc, np.full(len(doc), FULL, np.uint8))
        return _table(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gathered, size = [], 0
        for batch in text_slices(batches, limit=s.slice_bytes):
            a = anchors_of(*text_bytes(batch.column("text")))
            gathered.append((a.suffix, a.context, batch.column("doc_id").to_numpy(zero_copy_only=False).astype(np.int64)[a.text]))
            size += len(a.text)
            if size >= s.gathered:
                yield from dealt(gathered).to_batches()
                gathered, size = [], 0
        if size:
            yield from dealt(gathered).to_batches()

    return documents.where("doc_id IS NOT NULL").select("doc_id", "text").mapInArrow(run, PACKED_SQL)


def _marks(packed: DataFrame, parts: int) -> DataFrame:
    """Packed marks by document part: contexts that a smaller document has too, and those to be compared."""

    def run(own: pa.Table) -> pa.Table:
        kind = own.column("kind")[0].as_py()
        x, y, z = (own.column(c).to_pylist() for c in "xyz")
        if kind:
            return pa.Table.from_arrays([pa.array([p - parts for p in own.column("part").to_pylist()], pa.int32()), *own.columns[1:]], schema=PACKED)
        suffix, context, doc = unpack(x, np.uint32), unpack(y, np.uint64), unpack(z, np.int64)
        order = np.lexsort((doc, context, suffix))
        suffix, context, doc = suffix[order], context[order], doc[order]
        one, same = _starts(suffix, context), _starts(suffix)
        sizes, wide = np.diff(np.append(np.flatnonzero(one), len(doc))), np.diff(np.append(np.flatnonzero(same), len(doc)))
        full = doc > np.repeat(doc[one], sizes)
        # Suffixes with several contexts and several documents.
        contexts, low, high = (f(v, np.flatnonzero(same)) for f, v in ((np.add.reduceat, one.astype(np.int64)), (np.minimum.reduceat, doc), (np.maximum.reduceat, doc)))
        compared = one & np.repeat((contexts > 1) & (low < high), wide)
        flag = np.where(full, FULL, np.where(compared, COMPARED, 0)).astype(np.uint8)
        told = flag > 0
        key = (suffix[told].astype(np.uint64) << np.uint64(32)) | (context[told] & LOW)
        return _table(_dealt(_place(doc[told], parts), 1, key, doc[told], flag[told]))

    return packed.groupBy("part", "kind").applyInArrow(run, PACKED_SQL)


CUT = pa.schema(
    [("doc_id", pa.int64()), ("row", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("full", pa.binary()), ("lead", pa.binary()), ("context", pa.binary()), ("first", pa.int64())]
)
CUT_SQL = "doc_id bigint, row bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, full binary, lead binary, context binary, first bigint"


def cut_text(text: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What is left of a text without the stretches [start, stop), and these stretches merged."""
    if not len(starts):
        return text, starts, stops
    change = np.zeros(len(text) + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, stops, -1)
    gone = np.cumsum(change[:-1]) > 0
    edge = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(np.int8), [0]])))
    return text[~gone], edge[::2], edge[1::2]


def _result(text: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> tuple:
    left, a, b = cut_text(text, starts, stops)
    return len(text), len(text) - len(left), len(a), hashlib.sha256(left.tobytes()).hexdigest(), np.concatenate([a, b]).astype(np.int64).tobytes()


def _first_cut(documents: DataFrame, marks: DataFrame, parts: int, s: Settings) -> DataFrame:
    """A row for each document, cut by its marks, and one (with `lead`) for each context to be compared."""

    def run(own: pa.Table, marked: pa.Table) -> pa.Table:
        key, doc, flag = (unpack(marked.column(c).to_pylist(), k) for c, k in (("x", np.uint64), ("y", np.int64), ("z", np.uint8)))
        known = mix64(key ^ mix64(doc.view(np.uint64)))
        order = np.argsort(known, kind="stable")
        known, flag = known[order], flag[order]
        out = []
        for batch in text_slices(own.combine_chunks().to_batches(), limit=s.slice_bytes):
            flat, ends = text_bytes(batch.column("text"))
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            row = batch.column("row").to_numpy(zero_copy_only=False)
            a = anchors_of(flat, ends)
            begins = np.concatenate([[0], ends[:-1]])
            mine = np.zeros(len(a.text), np.uint8)
            if len(known) and len(a.text):
                number = pa.compute.fill_null(batch.column("doc_id"), 0).to_numpy(zero_copy_only=False).astype(np.int64)
                asked = mix64(a.key ^ mix64(number[a.text].view(np.uint64)))
                spot = np.minimum(np.searchsorted(known, asked), len(known) - 1)
                mine = np.where(known[spot] == asked, flag[spot], 0)
                if batch.column("doc_id").null_count:
                    mine[pa.compute.is_null(batch.column("doc_id")).to_numpy(zero_copy_only=False)[a.text]] = 0
            full = np.flatnonzero(mine == FULL)
            cuts = np.searchsorted(a.text[full], np.arange(len(ends) + 1))
            rows = []
            for k, (p, q) in enumerate(zip(begins.tolist(), ends.tolist(), strict=True)):
                f = full[cuts[k] : cuts[k + 1]]
                rows.append(_result(flat[p:q], a.first[f] - p, a.last[f] + SPAN - p))
            n_bytes, removed, spans, sha, stretches = zip(*rows, strict=True)
            empty = pa.nulls(len(rows), pa.binary())
            out.append(pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("row"), pa.array(n_bytes, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(sha), pa.array(stretches, pa.binary()), empty, empty, pa.nulls(len(rows), pa.int64())], schema=CUT))
            some = np.flatnonzero(mine == COMPARED)
            if len(some):
                data, t = flat.tobytes(), a.text[some]
                lead = [data[p : p + LEAD] for p in a.at[some].tolist()]
                context = [data[p : q + SPAN] for p, q in zip(a.first[some].tolist(), a.last[some].tolist(), strict=True)]
                blank = pa.nulls(len(some), pa.int64())
                out.append(pa.RecordBatch.from_arrays([pa.array(ids[t].astype(np.int64)), pa.array(row[t]), blank, blank, blank, pa.nulls(len(some), pa.string()), pa.nulls(len(some), pa.binary()), pa.array(lead, pa.binary()), pa.array(context, pa.binary()), pa.array(a.first[some] - begins[t])], schema=CUT))
        return pa.Table.from_batches(out, schema=CUT)

    # The same place as `_place` gives, in numpy: a part number for each row before the shuffle.
    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc = pa.compute.fill_null(batch.column("doc_id"), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(_place(doc, parts), pa.int32()), *batch.columns], ["part", *batch.schema.names])

    texts = documents.select("doc_id", "text", "row").mapInArrow(placed, "part int, doc_id bigint, text string, row bigint")
    return texts.groupBy("part").cogroup(marks.groupBy("part")).applyInArrow(run, CUT_SQL)


def multikey_ranks(words: np.ndarray) -> np.ndarray:
    """Equal numbers for equal rows of 8-byte words, and only for these.

    Rows are sorted by one word after the other; rows that differ from all others by then are left out of the rest.
    """
    n = len(words)
    rank, live = np.arange(n), np.arange(n)
    group = np.zeros(n, np.int64)
    for k in range(words.shape[1]):
        order = np.lexsort((words[live, k], group))
        live, group = live[order], group[order]
        new = _starts(group, words[live, k])
        number = np.cumsum(new) - 1
        several = np.bincount(number)[number] > 1
        live, group = live[several], number[several]
    heads = live[_starts(group)] if len(live) else live
    if len(live):
        rank[live] = heads[np.cumsum(_starts(group)) - 1]
    return rank


def _compared(contexts: DataFrame, s: Settings) -> DataFrame:
    """doc_id, row, start, stop: stretches of contexts whose strings a smaller document has too."""

    def matches(lead: list, context: list, doc: np.ndarray, row: np.ndarray, first: np.ndarray) -> pa.RecordBatch:
        sizes = np.array([len(c) for c in context])
        flat = np.frombuffer(b"".join(context) + bytes(8), np.uint8)
        begins = np.cumsum(sizes) - sizes
        counts = sizes - SPAN + 1
        owner = np.repeat(np.arange(len(sizes)), counts)
        offset = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
        at = begins[owner] + offset
        # Every eight bytes as one number; the last ones overlap, so that 50 bytes are seven numbers.
        eight = np.lib.stride_tricks.sliding_window_view(flat, 8)
        words = np.stack([np.ascontiguousarray(eight[at + k]).view(np.uint64).ravel() for k in (0, 8, 16, 24, 32, 40, SPAN - 8)], 1)
        rank, docs = multikey_ranks(words), doc[owner]
        order = np.lexsort((docs, rank))
        new = _starts(rank[order])
        smallest = np.empty(len(order), np.int64)
        smallest[order] = np.repeat(docs[order][new], np.diff(np.append(np.flatnonzero(new), len(order))))
        hit = np.flatnonzero(docs > smallest)
        apart = np.ones(len(hit), bool)
        apart[1:] = (owner[hit][1:] != owner[hit][:-1]) | (offset[hit][1:] != offset[hit][:-1] + 1)
        a = np.flatnonzero(apart)
        b = (np.append(a[1:], len(hit)) - 1)[: len(a)]
        who = owner[hit[a]]
        start, stop = first[who] + offset[hit[a]], first[who] + offset[hit[b]] + SPAN
        return pa.RecordBatch.from_arrays([pa.array(doc[who]), pa.array(row[who]), pa.array(start.astype(np.int64)), pa.array(stop.astype(np.int64))], ["doc_id", "row", "start", "stop"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []

        def flush(rows: pa.Table) -> pa.RecordBatch:
            return matches(rows["lead"].to_pylist(), rows["context"].to_pylist(), *(rows[c].to_numpy() for c in ("doc_id", "row", "first")))

        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            if sum(b.num_rows for b in held) < s.contexts:
                continue
            rows = pa.Table.from_batches(held)
            # Suffixes with the same leading bytes stay together: the last ones wait for what follows.
            lead, cut = rows["lead"], rows.num_rows
            last = lead[cut - 1]
            while cut and lead[cut - 1] == last:
                cut -= 1
            if cut:
                yield flush(rows.slice(0, cut))
            held = rows.slice(cut).to_batches()
        if held:
            yield flush(pa.Table.from_batches(held))

    parts = max(1, -(-contexts.count() // (8 * s.contexts)))
    ranged = contexts.select("lead", "context", "doc_id", "row", "first").repartitionByRange(parts, "lead").sortWithinPartitions("lead")
    return ranged.mapInArrow(run, "doc_id bigint, row bigint, start bigint, stop bigint")


def _second_cut(documents: DataFrame, cut: DataFrame, more: DataFrame) -> DataFrame:
    """Documents that have stretches in `more`, cut by both kinds."""
    named = more.groupBy("doc_id", "row").agg(F.collect_list(F.struct("start", "stop")).alias("more"))
    blocks = 4096  # 256 KiB, whatever the number of documents: beyond it only more texts pass on to the exact join
    words = bloom_filter(more.select(F.col("row").alias("id")).distinct(), "id", blocks).scalar()
    texts = documents.where(may_hold(words, F.col("row"), blocks))
    full = cut.where("lead IS NULL").groupBy(F.col("doc_id").alias("d"), F.col("row").alias("r")).agg(F.first("full").alias("full"))
    rows = texts.join(named, ["doc_id", "row"]).join(full, (F.col("doc_id") == F.col("d")) & (F.col("row") == F.col("r"))).select("doc_id", "text", "full", "more")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            flat, ends = text_bytes(batch.column("text"))
            found, begin = [], 0
            for end, own, other in zip(ends.tolist(), batch.column("full").to_pylist(), batch.column("more").to_pylist(), strict=True):
                a, b = np.frombuffer(own, np.int64).reshape(2, -1)
                starts = np.concatenate([a, [m["start"] for m in other]]).astype(np.int64)
                stops = np.concatenate([b, [m["stop"] for m in other]]).astype(np.int64)
                found.append(_result(flat[begin:end], starts, stops)[:4])
                begin = end
            n, removed, spans, sha = zip(*found, strict=True)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(sha)], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return rows.mapInArrow(run, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string")


def without_repeats(documents: DataFrame, s: Settings = Settings()) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 for every row of documents (doc_id, text).

    Null texts are empty. Rows that share a doc_id are one document as far as repeats go: none is earlier than the
    other. Rows without a doc_id lose nothing and take nothing from others. Texts of fewer than 50 bytes stay whole.
    Other columns are left out.
    """
    own = documents.select(documents["doc_id"].cast("bigint").alias("doc_id"), documents["text"], F.xxhash64(documents["text"]).alias("row"))
    size = own.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-size // (s.part_mb << 20)))
    cut = materialize(_first_cut(own, _marks(_fingerprints(own, parts, s), parts), parts, s))
    more = materialize(_compared(cut.where("lead IS NOT NULL"), s))
    again = more.select("doc_id", "row").distinct()
    columns = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    done = cut.where("lead IS NULL").join(again, ["doc_id", "row"], "left_anti").select(*columns)
    return done.union(_second_cut(own, cut, more).select(*columns))
