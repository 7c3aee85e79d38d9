"""Row filters that need more than one expression."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.operators.ordered import quantile


def in_range(df: DataFrame, c: str, low: float, high: float) -> DataFrame:
    """Closed range; rows with NULL are dropped."""
    return df.where(F.col(c).between(F.lit(low), F.lit(high)))


def among(df: DataFrame, c: str, values: Sequence) -> DataFrame:
    return df.where(F.col(c).isin(list(values)))


def known_and_positive(df: DataFrame, known: str, positive: str) -> DataFrame:
    return df.where(F.col(known).isNotNull() & (F.col(positive) > 0))


def other_than(df: DataFrame, c: str, sentinel) -> DataFrame:
    return df.where(F.col(c) != F.lit(sentinel))


def up_to_quantile(df: DataFrame, c: str, q: float = 0.99) -> DataFrame:
    """Rows whose value does not exceed its own q-quantile."""
    return df.where(F.col(c) <= quantile(df, c, q))


def non_empty(df: DataFrame, items: str) -> DataFrame:
    return df.where(F.size(items) > 0)
