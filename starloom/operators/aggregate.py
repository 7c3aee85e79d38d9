"""Counts, shares, lists and summaries."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.functions.encode import literal_map
from starloom.operators.ordered import exact_quantiles


def group_counts(df: DataFrame, key: str, name: str = "n") -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias(name))


def value_counts(df: DataFrame, c: str, name: str = "n") -> DataFrame:
    """Rows per value, NULL excluded, most frequent first (ties by value)."""
    return group_counts(df.where(F.col(c).isNotNull()), c, name).orderBy(F.desc(name), c)


def value_shares(df: DataFrame, c: str) -> DataFrame:
    """Rows per value with the share of all rows, in value order."""
    total = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    counts = group_counts(df.where(F.col(c).isNotNull()), c)
    return counts.withColumn("share", F.col("n") / total).orderBy(c)


def top_values(df: DataFrame, c: str, k: int, name: str = "n") -> DataFrame:
    """The k most frequent values."""
    return value_counts(df, c, name).limit(k)


def item_lists(df: DataFrame, key: str, item: str, name: str = "items") -> DataFrame:
    """Sorted list of all items of each key, repeats kept.

    Repeats travel as counts, so the shuffled state of a key grows with its distinct items, not its rows.
    """
    counted = df.where(F.col(item).isNotNull()).groupBy(key, item).agg(F.count(F.lit(1)).cast("int").alias("_n"))
    runs = counted.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(item, "_n"))).alias("_runs"))
    repeated = F.transform("_runs", lambda run: F.array_repeat(run[item], run["_n"]))
    return runs.select(key, F.flatten(repeated).alias(name))


def item_sets(df: DataFrame, key: str, item: str, name: str = "items") -> DataFrame:
    """Sorted distinct items of each key.

    Tasks put together the items that they see of a key, so its rows are shuffled once, and repeats not at all.
    """
    return df.where(F.col(item).isNotNull()).groupBy(key).agg(F.array_sort(F.collect_set(item)).alias(name))


_FLAGS = 62


def item_flags(df: DataFrame, key: str, item: str, items: Sequence[str]) -> DataFrame:
    """One 0/1 column per listed item and one row per key, keys without any listed item included.

    A key's items are bits of one integer for each 62 items, so a pivot's partial state of a row per key and item, and its
    array per key, do not arise.
    """
    words = [items[i : i + _FLAGS] for i in range(0, len(items), _FLAGS)]
    bits = [F.try_element_at(literal_map({v: 1 << i for i, v in enumerate(word)}), F.col(item)).cast("bigint") for word in words]
    held = df.groupBy(key).agg(*[F.bit_or(F.coalesce(b, F.lit(0).cast("bigint"))).alias(f"_w{w}") for w, b in enumerate(bits)])
    flags = [F.shiftright(f"_w{w}", i).bitwiseAND(F.lit(1).cast("bigint")).cast("int").alias(v) for w, word in enumerate(words) for i, v in enumerate(word)]
    return held.select(key, *flags)


def summary(df: DataFrame, c: str) -> DataFrame:
    """Count, mean, median, minimum and maximum of one column in one row."""
    middle = exact_quantiles(df, c, {"median": 0.5}).select("median").scalar()
    row = df.agg(F.count(c).alias("n"), F.avg(c).alias("mean"), F.min(c).alias("min"), F.max(c).alias("max"))
    return row.select("n", "mean", middle.alias("median"), "min", "max")


def conditional_counts(df: DataFrame, conditions: Mapping[str, Column]) -> DataFrame:
    """One row per named condition: rows that meet it and their share of all rows."""
    names = list(conditions)
    row = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count_if(conditions[n]).alias(n) for n in names])
    entries = F.array(*[F.struct(F.lit(n).alias("condition"), F.col(n).alias("n")) for n in names])
    return row.select("_rows", F.inline(entries)).select(
        "condition", "n", (F.col("n") / F.nullif(F.col("_rows"), F.lit(0))).alias("share")
    )


def class_balance(df: DataFrame, target: str) -> DataFrame:
    known = df.where(F.col(target).isNotNull())
    return value_shares(known, target)


def present_in_order(df: DataFrame, c: str, order: Sequence[str]) -> DataFrame:
    """Those values of a fixed order that occur, with their place in the order."""
    seen = df.select(c).where(F.col(c).isin(list(order))).distinct()
    place = F.array_position(F.array(*[F.lit(v) for v in order]), F.col(c)).cast("int")
    return seen.select(place.alias("place"), c).orderBy("place")
