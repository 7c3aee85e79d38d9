"""Seeded samples and train/test splits that do not depend on the partitioning.

A row is placed by the hash of its key, so every reader, retry and rerun sees the same sample.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starloom.functions.hashing import HASH_RANGE, seeded_hash

_BUCKETS = 1 << 16


def sample_rows(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """min(n, rows) uniformly chosen rows: those with the smallest (hash, key).

    Row counts per power of two of the hash give the smallest power that still leaves n rows; only rows below it are
    sorted, about 2n instead of n per task.
    """
    rows = df.withColumn("_h", seeded_hash(key, seed)).withColumn("_level", F.ceil(F.log2(F.col("_h") + 1)))
    counts = rows.groupBy("_level").agg(F.count(F.lit(1)).alias("_n"))  # at most 33 rows
    upto = Window.partitionBy(F.lit(0)).orderBy("_level").rowsBetween(Window.unboundedPreceding, -1)
    needed = counts.withColumn("_before", F.coalesce(F.sum("_n").over(upto), F.lit(0))).where(F.col("_before") < n)
    limit = needed.agg(F.max("_level")).scalar()
    return rows.where(F.col("_level") <= limit).orderBy("_h", key).limit(n).drop("_h", "_level")


def split_rows(df: DataFrame, key: str, test_share: float = 0.2, seed: int = 42, name: str = "is_test") -> DataFrame:
    """Mark about `test_share` of the rows as test rows; a narrow step without any shuffle."""
    return df.withColumn(name, (seeded_hash(key, seed) < F.lit(int(test_share * HASH_RANGE))).cast("int"))


def stratified_split(
    df: DataFrame,
    key: str,
    stratum: str,
    classes: Sequence = (0, 1),
    test_share: float = 0.2,
    seed: int = 42,
    name: str = "is_test",
) -> DataFrame:
    """Mark exactly ceil(share * n) rows of every class as test rows.

    Counts per class and hash bucket locate the bucket in which the quota ends. All other rows are decided by
    comparing bucket numbers; only rows of that one bucket (about n / 65536) are ranked.
    """
    bucket = F.floor(F.col("_h") / F.lit(HASH_RANGE // _BUCKETS))
    rows = df.withColumn("_h", seeded_hash(key, seed)).withColumn("_b", bucket)
    counts = rows.where(F.col(stratum).isin(list(classes))).groupBy(stratum, "_b").agg(F.count(F.lit(1)).alias("_n"))
    group = Window.partitionBy(stratum)
    upto = group.orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)
    edges = (
        counts.withColumn("_end", F.sum("_n").over(upto))
        .withColumn("_quota", F.ceil(F.sum("_n").over(group) * F.lit(float(test_share))))
        .where((F.col("_end") >= F.col("_quota")) & (F.col("_end") - F.col("_n") < F.col("_quota")))
        .select(stratum, F.col("_b").alias("_edge"), (F.col("_quota") - F.col("_end") + F.col("_n")).alias("_left"))
    )
    # One row per listed class; a class that is not listed is an error rather than a lost row.
    joined = rows.join(F.broadcast(edges), stratum, "left")
    known = F.coalesce("_edge", F.raise_error(F.lit("class not listed for the stratified split")).cast("bigint"))
    side = F.signum(F.col("_b") - known)
    clear = joined.where(side != 0).withColumn(name, (F.col("_b") < F.col("_edge")).cast("int"))
    place = F.row_number().over(Window.partitionBy(stratum).orderBy("_h", key))
    edge = joined.where(side == 0).withColumn(name, (place <= F.col("_left")).cast("int"))
    return clear.unionByName(edge).select(*df.columns, name)
