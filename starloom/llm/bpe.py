"""Byte-level BPE: whole texts to token ids of a public vocabulary, and back.

Each task takes Arrow batches of texts, finds the distinct words of the batch (matches of the vocabulary's pattern) that
it has not met yet, and folds ranked merges over their bytes with a broadcast rank map. A text's ids are the ids of its
words, one after the other, so nothing is shuffled. Decoding joins the byte pieces of the ids.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from starloom.llm.common import small_batches, text_bytes, text_slices

#: Vocabularies have at most so many entries, which bounds what is broadcast.
MOST_RANKS = 300_000
#: Words of a generation whose ids a task keeps at hand; a full one gives way to a new one, which takes over what it meets again.
KEPT_WORDS = 100_000
#: Bytes of texts or ids that a task works on at once; more gain no time.
SLICE = 1 << 20
#: Words of fewer bytes are merged over a list of pairs, longer ones over a heap.
SHORT = 100


def read_ranks(path: str) -> dict[bytes, int]:
    """The rank of each byte piece of a vocabulary file with lines `base64 rank`."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, lines)}
    if len(ranks) > MOST_RANKS or max(ranks.values(), default=0) >= MOST_RANKS:
        raise ValueError(f"{len(ranks)} ranks, or one of them, are more than {MOST_RANKS}")
    return ranks


def merge_word(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one word: the adjacent pair of lowest rank, the leftmost of equals, is merged until none has a rank.

    The next pair comes from a heap, so very long words take n log n steps. A word that is a piece itself is one id.
    """
    if word in ranks:
        return [ranks[word]]
    n = len(word)
    if n < SHORT:
        # Ranks of the adjacent pairs; a merge changes those on its two sides only.
        rank, none = ranks.get, MOST_RANKS
        parts, pairs = [word[i : i + 1] for i in range(n)], [rank(word[i : i + 2], none) for i in range(n - 1)]
        while pairs:
            least = min(pairs)
            if least == none:
                break
            i = pairs.index(least)
            merged = parts[i] + parts[i + 1]
            parts[i] = merged
            del parts[i + 1], pairs[i]
            if i < len(pairs):
                pairs[i] = rank(merged + parts[i + 1], none)
            if i:
                pairs[i - 1] = rank(parts[i - 1] + merged, none)
        return [ranks[p] for p in parts]
    ends = list(range(1, n + 1))  # of the part that starts here; 0 once it is merged away
    before = list(range(-1, n - 1))
    heap = [(ranks[word[i : i + 2]], i, i + 2) for i in range(n - 1) if word[i : i + 2] in ranks]
    heapq.heapify(heap)
    while heap:
        _, i, end = heapq.heappop(heap)
        middle = ends[i]
        if not middle or middle >= n or ends[middle] != end:
            continue  # one of the two parts has changed meanwhile
        ends[i], ends[middle] = end, 0
        if end < n:
            before[end] = i
            rank = ranks.get(word[i : ends[end]])
            if rank is not None:
                heapq.heappush(heap, (rank, i, ends[end]))
        left = before[i]
        if left >= 0:
            rank = ranks.get(word[left:end])
            if rank is not None:
                heapq.heappush(heap, (rank, left, end))
    out, i = [], 0
    while i < n:
        out.append(ranks[word[i : ends[i]]])
        i = ends[i]
    return out


def encode(texts: DataFrame, ranks: dict[bytes, int], pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`key` and `ids` for every row: its ids as little-endian unsigned 32-bit numbers. Null and empty texts have none.

    Repeated rows stay; other columns are left out.
    """
    small_batches(texts.sparkSession)
    shared = texts.sparkSession.sparkContext.broadcast(ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        find, ranks, known, older = regex.compile(pattern).findall, shared.value, {}, {}
        for batch in text_slices(batches, limit=SLICE):
            out = []
            for value in batch.column("text").to_pylist():
                words = find(value) if value else []
                for word in set(words).difference(known):
                    known[word] = older.get(word) or b"".join(i.to_bytes(4, "little") for i in merge_word(word.encode(), ranks))
                out.append(b"".join([known[w] for w in words]))
                if len(known) > KEPT_WORDS:
                    known, older = {}, known
            yield pa.RecordBatch.from_arrays([batch.column(key), pa.array(out, pa.binary())], [key, "ids"])

    kind = texts.schema[key].dataType.simpleString()
    return texts.select(texts[key], texts[text].alias("text")).mapInArrow(run, f"`{key}` {kind}, ids binary")


def decode(rows: DataFrame, ranks: dict[bytes, int]) -> DataFrame:
    """`rows` with `decoded`, the bytes that the `ids` stand for. Null ids decode to null."""
    import numpy as np

    table = [b""] * (max(ranks.values(), default=-1) + 1)
    for piece, rank in ranks.items():
        table[rank] = piece
    small_batches(rows.sparkSession)
    shared = rows.sparkSession.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = pa.array(shared.value, pa.binary())
        for batch in text_slices(batches, "ids", SLICE):
            flat, ends = text_bytes(batch.column("ids"))
            taken = pieces.take(pa.array(np.frombuffer(flat.tobytes(), "<u4").astype(np.int64)))
            # The pieces of a row lie one after the other: their bytes need other offsets only.
            bounds = np.frombuffer(taken.buffers()[1], np.int32)[: len(taken) + 1] if len(taken) else np.zeros(1, np.int32)
            offsets = bounds[np.concatenate([[0], ends // 4])]
            joined = pa.BinaryArray.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(np.ascontiguousarray(offsets)), taken.buffers()[2]])
            out = pc.if_else(batch.column("ids").is_valid(), joined, pa.scalar(None, pa.binary()))
            yield pa.RecordBatch.from_arrays([*batch.columns, out], [*batch.schema.names, "decoded"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(run, f"{fields}, decoded binary")
