"""Joins between the fact table, its dimensions and the category bridge.

No dimension is broadcast by hint: adaptive execution broadcasts what it measured to be small and otherwise splits
skewed partitions. Hints are used only for frames whose row count is a constant of the operator.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.operators.aggregate import group_counts, top_values
from starloom.operators.moments import cross_products


def with_dimension(fact: DataFrame, dimension: DataFrame, key: str, attributes: Sequence[str]) -> DataFrame:
    """Left join to a dimension keyed by `key`; returned unchanged if either side lacks the key.

    A hot key sits on the fact side, where adaptive execution may split the partition of a left join.
    """
    if key not in fact.columns or key not in dimension.columns:
        return fact
    return fact.join(dimension.select(key, *attributes), key, "left")


def with_details(fact: DataFrame, details: DataFrame, key: str, attributes: Sequence[str], nulls_apart: bool = False) -> DataFrame:
    """Left join to a table that may repeat the key (fan-out kept); clashing names get the suffixes _x and _y.

    With `nulls_apart` it is a plain left join of the rows that have a key, and rows without one are added to it: the form
    for stored tables that are bucketed by the key, where it needs no shuffle, but cannot be split on a hot key.

    Keys without details get one detail row of NULLs first, so that an inner join gives the result of a left join.
    Unlike a left join, an inner join may be split on both sides: a key that holds most of the detail rows does not
    end in one task. Only the key column of the fact table is read for the extra rows.
    """
    if key not in fact.columns or key not in details.columns:
        return fact
    clash = [a for a in attributes if a in fact.columns]
    left = fact.withColumnsRenamed({a: f"{a}_x" for a in clash})
    right = details.where(F.col(key).isNotNull()).select(key, *attributes)
    right = right.withColumnsRenamed({a: f"{a}_y" for a in clash})
    if nulls_apart:
        known = left.where(F.col(key).isNotNull()).join(right, key, "left")
        return known.unionByName(left.where(F.col(key).isNull()), allowMissingColumns=True).select(*left.columns, *[c for c in right.columns if c != key])
    without = left.select(key).distinct().join(right.select(key).distinct(), key, "left_anti")
    filled = right.unionByName(without, allowMissingColumns=True).withColumnRenamed(key, "_key")
    # A fact row without a key has exactly one filler row to meet.
    return left.join(filled, left[key].eqNullSafe(F.col("_key"))).drop("_key")


def with_counts(fact: DataFrame, bridge: DataFrame, key: str, name: str) -> DataFrame:
    """Left join to the number of bridge rows per key, 0 where there is none; counted before the join."""
    counts = group_counts(bridge, key, name)
    return fact.join(counts, key, "left").withColumn(name, F.coalesce(F.col(name), F.lit(0)).cast("int"))


def keep_top_items(bridge: DataFrame, item: str, k: int) -> DataFrame:
    """Bridge rows whose item is one of the k most frequent."""
    return bridge.join(F.broadcast(top_values(bridge, item, k).select(item)), item, "left_semi")


def missing_keys(keys: DataFrame, fact: DataFrame, key: str) -> DataFrame:
    """One row: keys, keys absent from the fact table and whether all are contained."""
    distinct = keys.select(key).distinct()
    known = fact.select(key).distinct().withColumn("_known", F.lit(1))
    return distinct.join(known, key, "left").agg(
        F.count(F.lit(1)).alias("n_keys"),
        F.count_if(F.col("_known").isNull()).alias("n_missing"),
        (F.count_if(F.col("_known").isNull()) == 0).alias("contained"),
    )


def lookup_rows(keys: DataFrame, fact: DataFrame, key: str, attributes: Sequence[str]) -> DataFrame:
    """Attributes of each listed key; a key repeated in the fact table contributes one row."""
    one = fact.groupBy(key).agg(F.min(F.struct(*attributes)).alias("_row")).select(key, "_row.*")
    return keys.select(key).join(one, key)


def cooccurrence(bridge: DataFrame, key: str, item: str, k: int = 15) -> DataFrame:
    """Symmetric counts of item pairs that share a key, over the k most frequent items; pairs that never meet count 0.

    Each key is reduced to one row of k counters, and all pair counts are the cross products of these counters: no
    pair of rows is ever built, so a key with very many rows costs no more than any other.
    """
    ordered = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("order"), F.col(item).alias("item"))))
    names = top_values(bridge, item, k).agg(F.transform(ordered, lambda t: t["item"]).alias("names"))
    places = names.select(F.posexplode("names").alias("_place", item))
    counted = bridge.join(F.broadcast(places), item)
    counters = [f"_m{i}" for i in range(k)]
    per_key = counted.groupBy(key).agg(*[F.expr(f"count_if(_place = {i})").alias(c) for i, c in enumerate(counters)])
    pairs = cross_products(per_key, counters).where("i <> j").withColumn("_names", names.scalar())
    # Counters beyond the number of items stay unused.
    pairs = pairs.where("greatest(i, j) < size(_names)")
    return pairs.select(
        F.get("_names", F.col("i")).alias("item_a"),
        F.get("_names", F.col("j")).alias("item_b"),
        F.col("value").cast("bigint").alias("n"),
    )
