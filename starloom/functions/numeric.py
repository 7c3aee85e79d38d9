"""Null handling, numeric coercion, ratios and dates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Plain decimal and exponent notation; Java alone would also take "1d", "2f" and hex floats.
_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$|^\s*[+-]?(?i:inf|infinity)\s*$"


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def rounded(c: Column | str, digits: int) -> Column:
    """Round half to even on the scaled double, the way NumPy does; never returns -0.0."""
    scale = float(10**digits)
    return F.rint(as_col(c) * F.lit(scale)) / F.lit(scale) + F.lit(0.0)


def nan_as_null(c: Column | str) -> Column:
    c = as_col(c)
    return F.when(~F.isnan(c), c)


def to_number(c: Column | str) -> Column:
    """Parse anything as double; text that is no number and NaN become NULL."""
    text = as_col(c).cast("string")
    return F.when(text.rlike(_NUMBER), text.try_cast("double"))


def number_or_zero(df: DataFrame, c: str) -> Column:
    """A column as double with gaps as 0; only text is parsed."""
    number = F.col(c).cast("double") if isinstance(df.schema[c].dataType, (T.NumericType, T.BooleanType)) else to_number(c)
    return F.coalesce(nan_as_null(number), F.lit(0.0))


def midpoint(low: Column | str, high: Column | str) -> Column:
    """Mean of two bounds; a missing bound is replaced by the other one."""
    low, high = as_col(low), as_col(high)
    return (F.coalesce(low, high) + F.coalesce(high, low)) / F.lit(2.0)


def ratio_or_null(numerator: Column | str, denominator: Column | str, digits: int = 4) -> Column:
    """Rounded ratio, NULL for a zero denominator."""
    return rounded(as_col(numerator) / F.nullif(as_col(denominator).cast("double"), F.lit(0.0)), digits)


def ratio_over_one(numerator: Column | str, denominator: Column | str, digits: int = 4) -> Column:
    """Rounded ratio where a zero denominator counts as one."""
    denominator = as_col(denominator).cast("double")
    safe = F.when(denominator == 0.0, F.lit(1.0)).otherwise(denominator)
    return rounded(as_col(numerator) / safe, digits)


def flag(c: Column | str) -> Column:
    """Nullable flag to 0/1 (NULL counts as 0)."""
    return F.coalesce(as_col(c).cast("int"), F.lit(0))


def percentage_error(actual: Column | str, predicted: Column | str) -> Column:
    """Absolute percentage error, NULL where the actual value is zero."""
    actual = as_col(actual)
    return F.abs((actual - as_col(predicted)) / F.nullif(actual, F.lit(0.0))) * F.lit(100.0)


def within(c: Column | str, low: float, high: float) -> Column:
    """The value where it lies in the closed range, NULL elsewhere."""
    c = as_col(c)
    return F.when(c.between(F.lit(low), F.lit(high)), c)


def epoch_ms_to_timestamp(c: Column | str) -> Column:
    return F.timestamp_millis(as_col(c).try_cast("bigint"))


def month_label(ts: Column | str) -> Column:
    return F.date_format(as_col(ts), "yyyy-MM")
