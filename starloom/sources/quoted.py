"""Quoted CSV read by many tasks, though values may hold line breaks.

A line break ends a record only where the number of quotes before it in the file is even. One scan counts the quotes of
every split; prefix sums over the splits of a file (one row each) tell in which state each begins; a second scan cuts the
splits into records at their true ends. What lies on both sides of a border between splits is put together from at most
two pieces for each split. The records are stored, so later readers parse them without these scans.

The input follows RFC 4180: quotes stand around values, and twice inside them. Lines end with LF or CRLF.
"""

from __future__ import annotations

import csv
import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starloom.session import materialize

#: Kinds of pieces: a whole record, the rest of one begun in an earlier split, the begin of one that goes on in the next.
WHOLE, REST, BEGIN = 0, 1, 2


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, split, value): lines in the order of the file within each split, split by Spark's text reader."""
    text = spark.read.option("lineSep", "\n").text(path)
    return text.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), "value")


def runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple[str, int], pa.RecordBatch]]:
    """Parts of a batch that belong to one split."""
    files, splits = batch.column("file").dictionary_encode().indices.to_numpy(), batch.column("split").to_numpy()
    cuts = np.flatnonzero((files[1:] != files[:-1]) | (splits[1:] != splits[:-1])) + 1
    for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(files)], strict=True):
        if a < b:
            yield (batch.column("file")[a].as_py(), int(splits[a])), batch.slice(a, b - a)


def _odd(values: pa.Array) -> np.ndarray:
    """Whether each line has an odd number of quotes."""
    return pc.count_substring(values, '"').to_numpy(zero_copy_only=False) % 2 == 1


def split_states(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """file, split, inside, header: whether a split begins inside a quoted value; the first record for the first split.

    A header that goes on beyond the first split is left to the records. Blank lines before it are passed over.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        odd: dict[tuple[str, int], bool] = {}
        heads: dict[str, list[str]] = {}
        done: set[str] = set()
        for batch in batches:
            for key, part in runs(batch):
                lines = _odd(part.column("value"))
                if key[1] == 0 and key[0] not in done:
                    state = odd.get(key, False)
                    for line, flips in zip(part.column("value").to_pylist(), lines.tolist(), strict=True):
                        if key[0] not in heads and not line.rstrip("\r"):
                            continue
                        heads.setdefault(key[0], []).append(line)
                        state ^= flips
                        if not state:
                            done.add(key[0])
                            break
                odd[key] = bool(odd.get(key, False) ^ (int(lines.sum()) % 2 == 1))
        files, splits = [k[0] for k in odd], [k[1] for k in odd]
        first = ["\n".join(heads[f]) if s == 0 and f in done else None for f, s in odd]
        yield pa.RecordBatch.from_arrays([pa.array(files, pa.string()), pa.array(splits, pa.int64()), pa.array(list(odd.values()), pa.bool_()), pa.array(first, pa.string())], ["file", "split", "odd", "header"])

    counted = _lines(spark, path).mapInArrow(count, "file string, split bigint, odd boolean, header string")
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum(F.col("odd").cast("int")).over(before), F.lit(0)) % 2 == 1
    return materialize(counted.select("file", "split", inside.alias("inside"), "header"))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(file, split, kind, first, text): the records and pieces of records of the splits of a task."""
    key, state, held, kind, first = None, False, [], WHOLE, False

    def out(texts: list[str], kinds: list[int], firsts: list[bool]) -> pa.RecordBatch:
        n = len(texts)
        columns = [pa.array([key[0]] * n), pa.array([key[1]] * n, pa.int64()), pa.array(kinds, pa.int32()), pa.array(firsts, pa.bool_()), pa.array(texts, pa.string())]
        return pa.RecordBatch.from_arrays(columns, ["file", "split", "kind", "first", "text"])

    def rest() -> Iterator[pa.RecordBatch]:
        # Only an open value leaves lines behind; within a split without any end it is the rest of an earlier one.
        if held:
            yield out(["\n".join(held)], [BEGIN if kind == WHOLE else REST], [first])

    for batch in batches:
        for where, part in runs(batch):
            if where != key:
                yield from rest()
                key, held = where, []
                state = part.column("inside")[0].as_py()
                kind, first = (REST if state else WHOLE), where[1] == 0
            lines, odd = part.column("value").to_pylist(), _odd(part.column("value"))
            after = np.logical_xor.accumulate(np.concatenate([[state], odd]))[1:]
            ends, start = np.flatnonzero(~after), 0
            texts, kinds, firsts = [], [], []
            for end in ends.tolist():
                texts.append("\n".join([*held, *lines[start : end + 1]]) if held or end > start else lines[end])
                kinds.append(kind)
                firsts.append(first)
                first = first and not texts[-1].rstrip("\r")
                held, kind, start = [], WHOLE, end + 1
            held = [*held, *lines[start:]]
            state = bool(after[-1])
            if texts:
                yield out(texts, kinds, firsts)
    yield from rest()


def quoted_records(spark: SparkSession, path: str | list[str]) -> tuple[DataFrame, DataFrame]:
    """(file, first, text) of every record, stored, and the (file, header) of the files.

    `first` marks the record at the begin of a file. Blank lines are no records. A quote that is never closed makes the rest
    of its file one record, as it does for any reader.
    """
    states = split_states(spark, path)
    marked = _lines(spark, path).join(F.broadcast(states.drop("header")), ["file", "split"])  # one row a split
    pieces = materialize(marked.mapInArrow(_cut, "file string, split bigint, kind int, first boolean, text string"))
    whole = pieces.where(F.col("kind") == WHOLE).select("file", "first", "text")
    begun = F.sum((F.col("kind") == BEGIN).cast("int")).over(Window.partitionBy("file").orderBy("split", "kind"))
    parts = F.array_sort(F.collect_list(F.struct("split", "kind", "text")))
    across = pieces.where(F.col("kind") != WHOLE).withColumn("_record", begun).groupBy("file", "_record")
    joined = across.agg(F.max("first").alias("first"), F.array_join(F.transform(parts, lambda p: p["text"]), "\n").alias("text"))
    records = whole.unionByName(joined.select("file", "first", "text")).withColumn("text", F.regexp_replace("text", "\r$", ""))
    records = records.where(F.col("text") != "")
    heads = states.where(F.col("header").isNotNull()).select("file", "header")
    others = records.where("first").select("file", F.col("text").alias("header")).join(heads, "file", "left_anti")
    return records, heads.unionByName(others)


def header_names(header: str) -> list[str]:
    """Column names of a header record; unnamed columns get `_c` and their place, later ones of a name their place."""
    names = next(csv.reader(io.StringIO(header.removeprefix("﻿").rstrip("\r"), newline="")))
    named = [name or f"_c{i}" for i, name in enumerate(names)]
    return [f"{name}{i}" if named.index(name) < i else name for i, name in enumerate(named)]
