"""Sums of products of columns: the base of correlations and co-occurrence counts.

As built-in aggregates, k columns need hundreds of aggregate buffers, which Spark neither compiles nor fuses. Here each
task multiplies whole Arrow batches and emits one small matrix, and Spark adds the matrices.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def cross_products(
    df: DataFrame, columns: Sequence[str], expand: Callable[[np.ndarray], np.ndarray] | None = None
) -> DataFrame:
    """(i, j, value): sum over all rows of column i times column j, for every ordered pair of places.

    `expand` may add derived columns to a batch (rows x columns, missing values as NaN) before it is multiplied.
    """
    numbers = df.select(*[F.col(c).cast("double").alias(c) for c in columns])

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            rows = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns]).astype(float)
            rows = expand(rows) if expand else np.nan_to_num(rows)
            product = rows.T @ rows
            total = product if total is None else total + product
        if total is not None:
            i, j = np.indices(total.shape)
            arrays = [pa.array(i.ravel(), pa.int32()), pa.array(j.ravel(), pa.int32()), pa.array(total.ravel())]
            yield pa.RecordBatch.from_arrays(arrays, names=["i", "j", "value"])

    parts = numbers.mapInArrow(multiply, "i int, j int, value double")
    return parts.groupBy("i", "j").agg(F.sum("value").alias("value"))


def with_presence_and_squares(rows: np.ndarray) -> np.ndarray:
    """Columns of 0/1 presence, then the values (missing as 0), then their squares."""
    known = ~np.isnan(rows)
    values = np.where(known, rows, 0.0)
    return np.hstack([known, values, values * values])
