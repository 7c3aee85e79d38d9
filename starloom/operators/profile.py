"""Null counts and table profiles; every profile is one aggregate over one scan."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.functions.numeric import rounded
from starloom.operators.project import present, split_by_type


def fill_text(df: DataFrame, columns: Sequence[str], value: str = "Unknown") -> DataFrame:
    return df.fillna(value, subset=present(df, columns))


def fill_zero(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.fillna(0, subset=present(df, columns))


def _nulls(columns: Sequence[str | Column]) -> Column:
    total = F.lit(0).cast("bigint")
    for c in columns:
        total = total + F.count_if(F.isnull(c))
    return total


def null_totals(df: DataFrame, filled: Mapping[str, Column]) -> DataFrame:
    """Null cells before and after replacing some columns, as two rows of one scan."""
    row = df.agg(
        _nulls(df.columns).alias("before"),
        _nulls([filled.get(c, F.col(c)) for c in df.columns]).alias("after"),
    )
    entries = [F.struct(F.lit(s).alias("step"), F.col(s).alias("nulls")) for s in ("before", "after")]
    return row.select(F.inline(F.array(*entries)))


def _null_counts(df: DataFrame) -> DataFrame:
    """(n_rows, column_name, nulls), one row per column."""
    row = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(F.isnull(c)).alias(f"_nulls{i}") for i, c in enumerate(df.columns)],
    )
    entries = [
        F.struct(F.lit(c).alias("column_name"), F.col(f"_nulls{i}").alias("nulls")) for i, c in enumerate(df.columns)
    ]
    return row.select(F.col("_rows").alias("n_rows"), F.inline(F.array(*entries)))


def _percent(part: Column, whole: Column) -> Column:
    return rounded(part / F.nullif(whole, F.lit(0)) * F.lit(100.0), 1)


def profile(tables: Mapping[str, DataFrame], threshold: float = 10.0) -> DataFrame:
    """Rows, columns and null percentage of every column of every table; flags columns above the threshold."""
    parts = []
    for name, df in tables.items():
        percent = _percent(F.col("nulls"), F.col("n_rows"))
        parts.append(
            _null_counts(df).select(
                F.lit(name).alias("table_name"),
                "n_rows",
                F.lit(len(df.columns)).alias("n_columns"),
                "column_name",
                percent.alias("null_pct"),
                (percent > threshold).alias("high_null"),
            )
        )
    merged = parts[0]
    for part in parts[1:]:
        merged = merged.unionByName(part)
    return merged


def overview(df: DataFrame) -> DataFrame:
    """One row: shape, numeric and other columns, null cells and their percentage."""
    numeric, other = split_by_type(df)
    cells = F.col("n_rows") * F.lit(len(df.columns))
    row = df.agg(F.count(F.lit(1)).alias("n_rows"), _nulls(df.columns).alias("nulls"))
    return row.select(
        "n_rows",
        F.lit(len(df.columns)).alias("n_columns"),
        F.lit(len(numeric)).alias("n_numeric"),
        F.lit(len(other)).alias("n_other"),
        "nulls",
        _percent(F.col("nulls"), cells).alias("null_pct"),
    )


def missing_columns(df: DataFrame) -> DataFrame:
    """Columns with missing values, most missing first."""
    counts = _null_counts(df).where(F.col("nulls") > 0)
    percent = _percent(F.col("nulls"), F.col("n_rows"))
    return counts.select("column_name", "nulls", percent.alias("null_pct")).orderBy(F.desc("nulls"), "column_name")
