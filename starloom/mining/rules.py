"""Frequent item sets and association rules over the category bridge."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.functions.encode import RULE_LABELS, set_label
from starloom.functions.numeric import rounded
from starloom.operators.aggregate import item_sets
from starloom.operators.joins import keep_top_items
from starloom.operators.ranking import numbered
from starloom.session import materialize

_LOW_BITS = 15


def baskets(bridge: DataFrame, key: str, item: str, top: int = 30) -> DataFrame:
    """Distinct kept items per key; keys without any kept item are not baskets."""
    return item_sets(keep_top_items(bridge, item, top), key, item)


def frequent_itemsets(transactions: DataFrame, min_support: float = 0.05, items: str = "items") -> DataFrame:
    """All item sets with at least the given support: sorted items, count, support and length."""
    source = materialize(transactions.select(items))
    total = source.agg(F.count(F.lit(1)).cast("double")).scalar()
    model = FPGrowth(itemsCol=items, minSupport=min_support).fit(source)
    found = model.freqItemsets.select(F.array_sort("items").alias("items"), F.col("freq").alias("n"))
    return found.select("items", "n", (F.col("n") / total).alias("support"), F.size("items").alias("length"))


def _power(exponent: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), exponent)


def _splits(itemsets: DataFrame) -> DataFrame:
    """Every split of each item set into two non-empty sides.

    The split number is built from a high and a low part so that no single array holds all 2^length of them.
    """
    size = F.col("length")
    high = _power(F.greatest(size - _LOW_BITS, F.lit(0)))
    low = _power(F.least(size, F.lit(_LOW_BITS)))
    numbered = (
        itemsets.where(size >= 2)
        .withColumn("_high", F.explode(F.sequence(F.lit(0).cast("bigint"), high - 1)))
        .withColumn("_low", F.explode(F.sequence(F.lit(0).cast("bigint"), low - 1)))
        .withColumn("_split", F.shiftleft(F.col("_high"), _LOW_BITS).bitwiseOR(F.col("_low")))
        .where((F.col("_split") > 0) & (F.col("_split") < _power(size) - 1))
    )

    def side(bit: int) -> Column:
        # shiftright is called by name: its Python wrapper only takes a constant distance.
        chosen = lambda i: F.call_function("shiftright", F.col("_split"), i).bitwiseAND(F.lit(1).cast("bigint"))
        return F.filter("items", lambda _, i: chosen(i) == bit)

    return numbered.withColumns({"antecedents": side(1), "consequents": side(0)}).drop("_high", "_low", "_split")


def association_rules(itemsets: DataFrame, min_confidence: float = 0.3) -> DataFrame:
    """Rules from every split of every item set, with all interest measures."""
    sides = itemsets.select("items", "support")
    left = sides.select(F.col("items").alias("antecedents"), F.col("support").alias("antecedent_support"))
    right = sides.select(F.col("items").alias("consequents"), F.col("support").alias("consequent_support"))
    a, c, s = F.col("antecedent_support"), F.col("consequent_support"), F.col("support")
    # Confidence only needs the antecedent, so weak splits are dropped before the second join.
    strong = _splits(itemsets).join(left, "antecedents").withColumn("confidence", s / a)
    rules = strong.where(F.col("confidence") >= F.lit(min_confidence)).join(right, "consequents")
    leverage = s - a * c
    rest = F.greatest(s * (1 - a), a * (c - s))
    return rules.select(
        "antecedents",
        "consequents",
        "antecedent_support",
        "consequent_support",
        "support",
        "confidence",
        (F.col("confidence") / c).alias("lift"),
        leverage.alias("leverage"),
        # A rule without exceptions has no finite conviction.
        F.when(F.col("confidence") < 1.0, (1 - c) / F.nullif(1 - F.col("confidence"), F.lit(0.0)))
        .otherwise(F.lit(float("inf")))
        .alias("conviction"),
        F.coalesce(leverage / F.nullif(rest, F.lit(0.0)), F.lit(0.0)).alias("zhangs_metric"),
    )


def _rank_order() -> list[Column]:
    # Rules and their mirror images have equal lifts but for the last digits of a division.
    return [F.desc(rounded("lift", 10)), F.array_join("antecedents", ","), F.array_join("consequents", ",")]


def ranked_rules(rules: DataFrame) -> DataFrame:
    """Rules by falling lift."""
    return rules.orderBy(*_rank_order())


def numbered_rules(rules: DataFrame) -> DataFrame:
    """Rules with their `rank` from 1 by falling lift."""
    return numbered(rules, _rank_order())


def top_rules(rules: DataFrame, n: int) -> DataFrame:
    return ranked_rules(rules).limit(n)


def labelled_rules(rules: DataFrame, labels: Mapping[str, str] = RULE_LABELS) -> DataFrame:
    """Rules with display names of both sides and of the rule."""
    named = rules.withColumns({
        "antecedent_label": set_label("antecedents", labels),
        "consequent_label": set_label("consequents", labels),
    })
    arrow = F.concat(F.col("antecedent_label"), F.lit("  →  "), F.col("consequent_label"))
    return named.withColumn("rule_label", arrow)


def rule_summary(rules: DataFrame) -> DataFrame:
    """One row: number of rules, ranges of the measures and how many are strong."""
    ranges = [f(m).alias(f"{p}_{m}") for m in ("support", "confidence", "lift") for p, f in (("min", F.min), ("max", F.max))]
    return rules.agg(
        F.count(F.lit(1)).alias("total_rules"),
        *ranges,
        F.count_if(F.col("lift") > 1.5).alias("n_lift_above"),
        F.count_if(F.col("confidence") > 0.5).alias("n_confidence_above"),
        F.avg("confidence").alias("avg_confidence"),
    )
