"""Helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: White space between words, in every operator.
SPACE = r"[\x20\x09-\x0D]+"

#: Rows of an Arrow batch of whole texts.
BATCH_ROWS = 500
_BATCH_CONF = "spark.sql.execution.arrow.maxRecordsPerBatch"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def words_of(text: Column) -> Column:
    """Words of a text; null has none."""
    return F.coalesce(F.filter(F.split(text, SPACE), lambda w: w != ""), F.array().cast("array<string>"))


def uniform(key: Column, seed: int) -> Column:
    """A number in (0, 1) that depends on the key and the seed alone, alike in every engine with MD5."""
    digest = F.md5(F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit(f":{seed}")))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("bigint").cast("double") + 0.5) / float(1 << 52)


def hashed_sample(rows: DataFrame, most: int, *keys: str) -> DataFrame:
    """At most `most` rows: those with the least hash of `keys`. Rows whose hash is far from the cut don't leave their
    task, so what is gathered is about twice `most`, however many tasks there are."""
    count = max(rows.count(), 1)
    hashed = rows.withColumn("_hash", F.xxhash64(*keys))
    # Bounds are in units of the whole range of the hash; four deviations make a short sample unlikely.
    share = min(1.0, (most + 4 * most**0.5 + 8) / count)
    return hashed.where(F.col("_hash") <= F.lit(min((1 << 63) - 1, int(-(1 << 63) + share * (1 << 64))))).orderBy("_hash", *keys).limit(most).drop("_hash")


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of the session get at most BATCH_ROWS rows from now on, fewer where the session asks for that.

    Each batch of whole texts lies in memory in the executor and in the worker at once, for every Python step of a task.
    """
    set_rows = int(spark.conf.get(_BATCH_CONF))
    if not 0 < set_rows <= BATCH_ROWS:
        spark.conf.set(_BATCH_CONF, BATCH_ROWS)


def text_slices(batches: Iterator[pa.RecordBatch], column: str | Sequence[str] = "text", limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Batches cut so that the texts of one slice, in one or several columns, hold about `limit` bytes (or one row), to
    bound memory in tasks."""
    columns = [column] if isinstance(column, str) else list(column)
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = sum(pc.binary_length(batch.column(c)).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64) for c in columns)
        ends, start = np.cumsum(lengths), 0
        while start < batch.num_rows:
            done = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, done + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts, one after the other, and the ends of the texts in them; null is empty."""
    if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type):
        column = column.cast(pa.binary() if pa.types.is_large_binary(column.type) else pa.string())
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) else b"")
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    flat = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return flat[offsets[0] : offsets[-1]], offsets[1:] - offsets[0]


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose output bits all depend on all input bits."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
