"""Exact quantiles and running totals over a global order, without sorting everything in one task.

Both rest on `order_bucket`, a cheap, monotone map from values to a bounded number of buckets, and on equal slices of
every bucket between its own smallest and largest value, so that a column of narrow range is cut as finely as a wide
one. Counts per bucket and slice are partial aggregates with a tiny shuffle; only their prefix sums run in one task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from starloom.functions.numeric import as_col, nan_as_null

_BUCKETS_PER_E = 2048
_SMALLEST = 1e-6
_SLICES = 1024


def order_bucket(c: Column | str) -> Column:
    """Monotone bucket number: equal steps of log |v| away from zero, linear below 1e-6."""
    c = as_col(c).cast("double")
    return F.floor(F.signum(c) * F.log1p(F.abs(c) / F.lit(_SMALLEST)) * F.lit(float(_BUCKETS_PER_E)))


def _per_group(by: Sequence[str]) -> WindowSpec:
    # Used on bucket counts only, so the constant key of the ungrouped case never gathers raw rows.
    return Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))


def _slice(value: str) -> Column:
    """Place of a value between the `_low` and `_high` of its bucket."""
    width = F.nullif(F.col("_high") - F.col("_low"), F.lit(0.0))
    return F.coalesce(F.floor((F.col(value) - F.col("_low")) / width * F.lit(float(_SLICES))), F.lit(0))


def exact_quantiles(
    df: DataFrame, value: str, probs: Mapping[str, float], by: Sequence[str] = (), few_groups: bool = False
) -> DataFrame:
    """Linear-interpolated exact quantiles: one row per group with `n` and one column per named probability.

    Bucket counts locate the buckets that hold the wanted order statistics; only rows of those buckets are then
    ranked, so neither memory nor a single task grows with the data. `few_groups` promises a fixed list of groups;
    the wanted buckets are then broadcast instead of leaving the choice to adaptive execution.
    """
    by = list(by)
    keys = [*by, "_bucket"]
    rows = (
        df.select(*by, nan_as_null(F.col(value).cast("double")).alias("_v"))
        .where(F.col("_v").isNotNull())
        .withColumn("_bucket", order_bucket("_v"))
    )
    upto = _per_group(by).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0)
    counts = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_low"), F.max("_v").alias("_high")
    )
    placed = counts.select(
        *keys,
        "_low",
        "_high",
        (F.sum("_n").over(upto) - F.col("_n")).alias("_start"),
        F.sum("_n").over(upto).alias("_end"),
        F.sum("_n").over(_per_group(by)).alias("_total"),
    )

    def position(q: float) -> Column:
        return F.lit(float(q)) * (F.col("_total") - 1)

    ranks = [rank for q in probs.values() for rank in (F.floor(position(q)), F.ceil(position(q)))]

    def with_wanted_rank(df: DataFrame) -> DataFrame:
        hits = df.where(reduce(or_, [(F.col("_start") <= r) & (r < F.col("_end")) for r in ranks]))
        return F.broadcast(hits) if few_groups or not by else hits  # at most two rows per probability and group

    wanted = with_wanted_rank(placed).select(*keys, "_low", "_high", "_total", F.col("_start").alias("_before"))
    distinct = (
        rows.join(wanted, keys)
        .withColumn("_slice", _slice("_v"))
        .groupBy(*keys, "_slice", "_before", "_total", "_v")
        .agg(F.count(F.lit(1)).alias("_c"))
    )
    earlier = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, 0)
    slices = (
        distinct.groupBy(*keys, "_slice", "_before", "_total")
        .agg(F.sum("_c").alias("_n"))
        .withColumn("_end", F.col("_before") + F.sum("_n").over(earlier))
        .withColumn("_start", F.col("_end") - F.col("_n"))
    )
    offsets = with_wanted_rank(slices).select(*keys, "_slice", F.col("_start").alias("_offset"))
    inside = Window.partitionBy(*keys, "_slice").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    ranked = (
        distinct.join(offsets, [*keys, "_slice"])
        .withColumn("_end", F.col("_offset") + F.sum("_c").over(inside))
        .withColumn("_start", F.col("_end") - F.col("_c"))
    )

    def at(rank: Column) -> Column:
        return F.max(F.when((F.col("_start") <= rank) & (rank < F.col("_end")), F.col("_v")))

    picks = [F.max("_total").alias("n")]
    for i, q in enumerate(probs.values()):
        picks += [
            at(F.floor(position(q))).alias(f"_lo{i}"),
            at(F.ceil(position(q))).alias(f"_hi{i}"),
            F.max(position(q) - F.floor(position(q))).alias(f"_part{i}"),
        ]
    picked = ranked.groupBy(*by).agg(*picks)
    return picked.select(
        *by,
        "n",
        *[
            (F.col(f"_lo{i}") + F.col(f"_part{i}") * (F.col(f"_hi{i}") - F.col(f"_lo{i}"))).alias(name)
            for i, name in enumerate(probs)
        ],
    )


def quantile(df: DataFrame, value: str, q: float) -> Column:
    """One exact quantile as a scalar subquery, usable in expressions over any frame."""
    return exact_quantiles(df, value, {"q": q}).select("q").scalar()


def running_totals(
    df: DataFrame, value: str, sums: Sequence[str], by: Sequence[str] = (), descending: bool = False
) -> DataFrame:
    """Add `<s>_upto` (running sum in value order) and `<s>_total` for a frame with one row per group and value."""
    by = list(by)
    keys = [*by, "_bucket", "_slice"]
    sign = F.lit(-1 if descending else 1)
    coarse = df.withColumn("_bucket", order_bucket(value))
    spans = coarse.groupBy(*by, "_bucket").agg(
        F.min(F.col(value).cast("double")).alias("_low"), F.max(F.col(value).cast("double")).alias("_high")
    )
    rows = coarse.join(spans, [*by, "_bucket"]).withColumn("_slice", _slice(value) * sign)
    rows = rows.withColumn("_bucket", F.col("_bucket") * sign)
    order = F.desc(value) if descending else F.asc(value)
    inside = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    slices = rows.groupBy(*keys).agg(*[F.sum(s).alias(f"_sum_{s}") for s in sums])
    # Two levels of prefix sums: over the few buckets of a group, and over the slices of each bucket.
    upto = _per_group(by).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0)
    buckets = slices.groupBy(*by, "_bucket").agg(*[F.sum(f"_sum_{s}").alias(f"_all_{s}") for s in sums])
    starts = buckets.select(
        *by,
        "_bucket",
        *[(F.sum(f"_all_{s}").over(upto) - F.col(f"_all_{s}")).alias(f"_start_{s}") for s in sums],
        *[F.sum(f"_all_{s}").over(_per_group(by)).alias(f"{s}_total") for s in sums],
    )
    earlier = Window.partitionBy(*by, "_bucket").orderBy("_slice").rowsBetween(Window.unboundedPreceding, 0)
    inner = slices.withColumns({f"_upto_{s}": F.sum(f"_sum_{s}").over(earlier) for s in sums})
    offsets = inner.join(starts, [*by, "_bucket"]).select(
        *keys,
        *[(F.col(f"_start_{s}") + F.col(f"_upto_{s}") - F.col(f"_sum_{s}")).alias(f"_before_{s}") for s in sums],
        *[f"{s}_total" for s in sums],
    )
    local = rows.withColumns({f"_local_{s}": F.sum(s).over(inside) for s in sums})
    return local.join(offsets, keys).select(
        *df.columns,
        *[(F.col(f"_before_{s}") + F.col(f"_local_{s}")).alias(f"{s}_upto") for s in sums],
        *[f"{s}_total" for s in sums],
    )
