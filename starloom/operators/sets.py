"""Unions of metric frames."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stack(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def long_metrics(row: DataFrame, task: str, metrics: Sequence[str]) -> DataFrame:
    """One-row metric frame to (task, metric, value)."""
    entries = [F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics]
    return row.select(F.lit(task).alias("task"), F.inline(F.array(*entries)))


def with_naive_baseline(comparison: DataFrame, rows: DataFrame, target: str, name: str) -> DataFrame:
    """Model comparison (model, rmse, r2) headed by the predictor that always answers the mean."""
    baseline = rows.agg(F.stddev_pop(target).alias("rmse")).select(
        F.lit(name).alias("model"), "rmse", F.lit(0.0).alias("r2")
    )
    return baseline.unionByName(comparison)
