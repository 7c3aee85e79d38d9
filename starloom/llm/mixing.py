"""Mixing sources to target weights by Pareto order sampling.

Every document is taken a certain number of whole times; what is left of its source's target is drawn without
replacement: documents are ordered by the odds of a random number over the odds of their inclusion, and the first ones
whose words fill the rest are taken once more. The cut in that order is found by counting words in ranges of the order
value, then in ranges of the one range that holds the cut, so no task ever holds a source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.common import uniform, words_of
from starloom.session import materialize

#: Ranges of the order value on each of two levels.
RANGES = 4096


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3) -> DataFrame:
    """source, source_size, target: weights by code point of the source, null last; a target stops at `most` sizes.

    Excess is shared again by weight, which ends where target = min(weight * level, most * size) for one level.
    One row for each source; the windows run over sources, never over documents.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    weight = F.element_at(F.array([F.lit(w) for w in weights]), ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    ranked = totals.withColumn("weight", weight).withColumn("cap", F.col("source_size") * most)
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), "source")
    rest = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (F.sum("source_size").over(everything) - (F.sum("cap").over(order) - F.col("cap"))) / F.sum("weight").over(rest)
    fits = F.col("weight") * F.col("level") <= F.col("cap")
    filled = ranked.withColumn("level", level).withColumn("level", F.first(F.when(fits, F.col("level")), ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    target = F.least(F.col("cap").cast("double"), F.coalesce(F.col("weight") * F.col("level"), F.col("cap").cast("double")))
    return filled.select("source", "source_size", target.alias("target"))


def _same(a: str, b: str) -> Column:
    return F.col(a).eqNullSafe(F.col(b))


def _cut(rows: DataFrame, bucket: str, start: Column) -> DataFrame:
    """By source: the range of the order in which the words drawn pass the rest, and the words before it."""
    counted = rows.groupBy("source", bucket).agg(F.sum("size").alias("n"), F.first("rest").alias("rest"), F.first(start).alias("start"))
    upto = F.col("start") + F.sum("n").over(Window.partitionBy("source").orderBy(bucket))
    passed = counted.withColumn("upto", upto).where(F.col("upto") > F.col("rest"))
    return passed.groupBy(F.col("source").alias("s")).agg(F.min_by(F.struct(F.col(bucket).alias("at"), (F.col("upto") - F.col("n")).alias("before")), bucket).alias("c")).select("s", F.col("c.at").alias(f"{bucket}_cut"), F.col("c.before").alias(f"{bucket}_before"))


def _ordered(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """Rows (source, u, ...) with the plan of their source and their place in the order of the draw."""
    odds = (F.col("u") / (1 - F.col("u"))) * ((1 - F.col("chance")) / F.col("chance"))
    placed = rows.join(plan, _same("source", "t"), "left").drop("t").withColumn("order", F.when(F.col("chance") > 0, odds / (1 + odds)).otherwise(F.lit(1.0)))
    placed = placed.withColumn("coarse", F.floor(F.col("order") * RANGES))
    return placed.withColumn("fine", F.floor((F.col("order") * RANGES - F.col("coarse")) * RANGES))


def mixing_plan(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3) -> DataFrame:
    """One row for each source of sizes (doc_id, source, size, u): its target, whole copies and where its draw ends."""
    targets = materialize(source_targets(sizes, weights, most))
    share = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    plan = targets.select(F.col("source").alias("t"), "source_size", "target", F.floor(share).alias("whole"), share.alias("share")).select(
        "*", (F.col("target") - F.col("whole") * F.col("source_size")).alias("rest"), (F.col("share") - F.col("whole")).alias("chance")
    )
    rows = _ordered(sizes, plan).where(F.col("chance") > 0)
    first = materialize(_cut(rows, "coarse", F.lit(0)))
    inside = rows.join(first, _same("source", "s") & (F.col("coarse") == F.col("coarse_cut"))).drop("s")
    second = materialize(_cut(inside, "fine", F.col("coarse_before")))
    finest = inside.join(second, _same("source", "s") & (F.col("fine") == F.col("fine_cut"))).drop("s")
    peers = finest.groupBy("source", "order", "doc_id", "size").agg(F.count("*").alias("k"), F.first("rest").alias("rest"), F.first("fine_before").alias("before"))
    upto = F.col("before") + F.sum(F.col("k") * F.col("size")).over(Window.partitionBy("source").orderBy("order", "doc_id", "size"))
    # Taken while the words before and after a document lie nearer to the rest than without it.
    last = peers.withColumn("upto", upto).where(2 * F.col("upto") - F.col("k") * F.col("size") <= 2 * F.col("rest"))
    last = last.groupBy(F.col("source").alias("s3")).agg(F.max(F.struct("order", "doc_id", "size")).alias("last"))
    cuts = plan.join(first, _same("t", "s"), "left").drop("s").join(second.withColumnRenamed("s", "s2"), _same("t", "s2"), "left").drop("s2")
    return materialize(cuts.join(last, _same("t", "s3"), "left").drop("s3"))


def copies() -> Column:
    """How often a row of `_ordered` is taken."""
    drawn = (
        F.when(F.col("chance") <= 0, F.lit(False))
        .when(F.col("coarse_cut").isNull() | (F.col("coarse") < F.col("coarse_cut")), F.lit(True))
        .when(F.col("coarse") > F.col("coarse_cut"), F.lit(False))
        .when(F.col("fine") != F.col("fine_cut"), F.col("fine") < F.col("fine_cut"))
        .otherwise(F.coalesce(F.struct("order", "doc_id", "size") <= F.col("last"), F.lit(False)))
    )
    return F.when(F.col("size") > 0, F.col("whole") + drawn.cast("bigint")).otherwise(F.lit(0)).cast("bigint")


def _measured(documents: DataFrame, seed: int) -> list[Column]:
    return [documents["doc_id"], documents["source"], F.size(words_of(documents["text"])).cast("bigint").alias("size"), uniform(documents["doc_id"], seed).alias("u")]


def mix(documents: DataFrame, seed: int = 17, weights: tuple[int, ...] = (1, 2, 3), most: int = 3) -> DataFrame:
    """doc_id, size, source_size, target, taken for every row of documents (doc_id, source, text).

    Null texts have size 0 and are never taken; a null source is a source of its own. Rows that share doc_id, size and
    source share their random number and are taken alike. An empty table gives no rows. Reruns agree, whatever the
    partitioning. Each source's taken words differ from its target by less than one document's size (or one group of
    rows alike).
    """
    sizes = materialize(documents.select(*_measured(documents, seed)))
    rows = _ordered(sizes, mixing_plan(sizes, weights, most)).withColumn("copies", copies())
    return rows.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def mixed_documents(documents: DataFrame, seed: int = 17, weights: tuple[int, ...] = (1, 2, 3), most: int = 3) -> DataFrame:
    """The rows of documents as often as the mix takes them, with their own columns; texts without a word are left out."""
    plan = mixing_plan(materialize(documents.select(*_measured(documents, seed))), weights, most)
    rows = documents.select(*_measured(documents, seed), F.struct(*[documents[c] for c in documents.columns]).alias("whole_row"))
    taken = _ordered(rows, plan).select("whole_row", copies().alias("n")).where(F.col("n") > 0)
    return taken.select("whole_row", F.explode(F.sequence(F.lit(1), F.col("n").cast("int")))).select("whole_row.*")
