"""Schema-driven projections."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import types as T

from starloom.functions.numeric import nan_as_null


def standard_names(df: DataFrame) -> DataFrame:
    """Column names stripped, lower-cased and with underscores for spaces."""
    return df.toDF(*[name.strip().lower().replace(" ", "_") for name in df.columns])


def present(df: DataFrame, names: Sequence[str]) -> list[str]:
    """Those of the requested columns that the frame has."""
    return [name for name in names if name in df.columns]


def keep_present(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.select(*present(df, names))


def prefixed_columns(df: DataFrame, prefix: str) -> list[str]:
    """Numeric and boolean columns with a name prefix (a raw text column of that prefix is no feature)."""
    kinds = (T.NumericType, T.BooleanType)
    return [f.name for f in df.schema.fields if f.name.startswith(prefix) and isinstance(f.dataType, kinds)]


def split_by_type(df: DataFrame) -> tuple[list[str], list[str]]:
    """Names of the numeric and of the other columns."""
    numeric = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    return numeric, [name for name in df.columns if name not in numeric]


def item_column(df: DataFrame, preferred: str = "skill_abr") -> str:
    """The preferred item column, else the last one."""
    return preferred if preferred in df.columns else df.columns[-1]


def key_column(df: DataFrame, preferred: str = "job_id") -> str:
    """The preferred key column, else the first one."""
    return preferred if preferred in df.columns else df.columns[0]


def add_columns(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """Put computed columns beside the existing ones."""
    return df.withColumns(dict(columns))


def nulls_for_nan(df: DataFrame) -> DataFrame:
    """Missing numbers are NULL, never NaN; applied once where data enters."""
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({name: nan_as_null(name) for name in floats}) if floats else df
