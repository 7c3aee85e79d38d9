"""Targets from quantiles, z-scores and min-max scaling; statistics are one-row scalar subqueries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.operators.ordered import quantile
from starloom.operators.project import present


def top_share_flag(df: DataFrame, value: str, name: str, q: float = 0.75) -> DataFrame:
    """1 for values at or above the q-quantile of known values, 0 for all others including NULL."""
    reached = F.col(value) >= quantile(df, value, q)
    return df.withColumn(name, F.coalesce(reached.cast("int"), F.lit(0)))


def demand_flag(df: DataFrame, value: str, name: str, q: float = 0.75) -> DataFrame:
    """1.0/0.0 by the q-quantile of positive values; NULL where the value is not positive."""
    threshold = quantile(df.where(F.col(value) > 0), value, q)
    reached = (F.col(value) >= threshold).cast("double")
    return df.withColumn(name, F.when(F.col(value) > 0, reached))


def _stats(df: DataFrame, columns: Sequence[str], *functions) -> Column:
    """Struct of one struct of statistics per column, as one scalar subquery."""
    per_column = []
    for c in columns:
        filled = F.coalesce(F.col(c).cast("double"), F.lit(0.0))
        per_column.append(F.struct(*[f(filled).alias(f.__name__) for f in functions]).alias(c))
    return df.agg(F.struct(*per_column).alias("stats")).scalar()


def z_scores(df: DataFrame, columns: Sequence[str], suffix: str = "_scaled") -> DataFrame:
    """Add z-scores (missing counts as 0, population deviation, constant column gives 0)."""
    columns = present(df, columns)
    result = df.withColumn("_stats", _stats(df, columns, F.avg, F.stddev_pop))
    scaled = {}
    for c in columns:
        mean, deviation = F.col(f"_stats.{c}.avg"), F.col(f"_stats.{c}.stddev_pop")
        centred = F.coalesce(F.col(c).cast("double"), F.lit(0.0)) - mean
        scaled[f"{c}{suffix}"] = F.coalesce(centred / F.nullif(deviation, F.lit(0.0)), F.lit(0.0))
    return result.withColumns(scaled).drop("_stats")


def unit_range(df: DataFrame, columns: Sequence[str], weight: float = 1.0) -> DataFrame:
    """Replace columns by min-max scaled ones times a weight (missing counts as 0, constant column gives 0)."""
    columns = present(df, columns)
    result = df.withColumn("_stats", _stats(df, columns, F.min, F.max))
    scaled = {}
    for c in columns:
        low, high = F.col(f"_stats.{c}.min"), F.col(f"_stats.{c}.max")
        shifted = F.coalesce(F.col(c).cast("double"), F.lit(0.0)) - low
        scaled[c] = F.coalesce(shifted / F.nullif(high - low, F.lit(0.0)), F.lit(0.0)) * F.lit(weight)
    return result.withColumns(scaled).drop("_stats")


def with_scaled_target(df: DataFrame, target: str, name: str = "target_scaled") -> DataFrame:
    """Add the target on [0, 1] together with its range, so that predictions can be turned back."""
    low = df.agg(F.min(target)).scalar()
    high = df.agg(F.max(target)).scalar()
    ranged = df.withColumns({"target_low": low, "target_high": high})
    width = F.nullif(F.col("target_high") - F.col("target_low"), F.lit(0.0))
    return ranged.withColumn(name, F.coalesce((F.col(target) - F.col("target_low")) / width, F.lit(0.0)))


def unscaled(c: Column | str) -> Column:
    """Back from [0, 1] to target units, with the range columns of `with_scaled_target`."""
    c = F.col(c) if isinstance(c, str) else c
    return c * (F.col("target_high") - F.col("target_low")) + F.col("target_low")
