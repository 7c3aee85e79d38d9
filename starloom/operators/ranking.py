"""Top-k per group, shares of a selection and best-of choices."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.session import materialize


def top_per_group(df: DataFrame, group: str, order: Sequence[Column], k: int, rank: str = "place") -> DataFrame:
    """First k rows of each group; Spark cuts each partition to k rows per group before the shuffle."""
    window = Window.partitionBy(group).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).where(F.col(rank) <= k)


def share_of_selection(df: DataFrame, value: str, name: str = "share") -> DataFrame:
    """Each value divided by the sum over the frame."""
    return df.withColumn(name, F.col(value) / df.agg(F.sum(value)).scalar())


def best_by(df: DataFrame, name: str, metric: str, largest: bool = True) -> DataFrame:
    """Name and metric of the best row (first name wins a tie)."""
    ranked = df.groupBy(metric).agg(F.min(name).alias(name))
    pick, value = (F.max_by, F.max) if largest else (F.min_by, F.min)
    return ranked.agg(pick(name, metric).alias(name), value(metric).alias(metric))


def top_rows(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    return df.orderBy(*order).limit(k)


def numbered(df: DataFrame, order: Sequence[Column], name: str = "rank") -> DataFrame:
    """Rows numbered from 1 in an order of the whole table, without bringing them into one task.

    The sorted rows are stored with their task and their place in it; counts of the tasks before give the rest.
    """
    sorted_rows = df.orderBy(*order).withColumns({"_task": F.spark_partition_id(), "_id": F.monotonically_increasing_id()})
    rows = materialize(sorted_rows.withColumn("_place", F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))).drop("_id"))
    sizes = rows.groupBy("_task").agg(F.count(F.lit(1)).alias("_n"))  # one row a task
    before = F.sum("_n").over(Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.withColumn("_before", F.coalesce(before, F.lit(0))).drop("_n")
    joined = rows.join(F.broadcast(offsets), "_task")
    return joined.withColumn(name, F.col("_before") + F.col("_place") + 1).select(*df.columns, name)
