"""Fitted trees as tables: one row per node, scoring by joins, and importances from the rows alone.

A tree table is as large as the model, not as the data: trees * 2^(depth + 1) nodes at most. `id` numbers the nodes of a
tree as the model does (0 is the root), `left` and `right` are ids. `node` is the path: the root is 1, the children of node k
are 2k and 2k + 1, so parents and depths follow from the number. Rows are scored by a fold over node arrays in every row, so
a table that was stored scores without the learner that made it.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.base import Model
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.session import ensure_checkpoint_dir, materialize

#: Deepest tree that a path number of 64 bits can hold.
MOST_DEPTH = 60
SCHEMA = (
    "tree int, id int, node bigint, depth int, feature string, threshold double, left int, right int, n bigint, impurity double, "
    "gain double, prediction double, stats array<double>, weight double"
)


def _saved(model: Model, spark: SparkSession) -> DataFrame:
    """(tree, weight, id, ...) rows that Spark writes when a tree model is saved."""
    path = f"{ensure_checkpoint_dir(spark)}/starloom-{uuid.uuid4().hex}"
    model.write().save(path)
    data = spark.read.parquet(f"{path}/data")
    if "treeID" not in data.columns:
        return data.select(F.lit(0).alias("tree"), F.lit(1.0).alias("weight"), "*")
    trees = spark.read.parquet(f"{path}/treesMetadata")
    weights = trees.select(F.col(trees.columns[0]).alias("treeID"), F.col(trees.columns[-1]).cast("double").alias("weight"))
    return data.join(weights, "treeID").select(F.col("treeID").alias("tree"), "weight", "nodeData.*")


def tree_table(model: Model | PipelineModel, features: Sequence[str]) -> DataFrame:
    """The nodes of a fitted tree, forest or boosted ensemble as rows of SCHEMA; leaves have no feature.

    `n` counts training rows (in a forest: drawn rows), `stats` holds the class counts, or count, sum and sum of squares of
    a regression. Thresholds of bin numbers are turned back to values of the features. `weight` is the share of the tree in the ensemble. Paths are found from the root down, one join for each level.
    """
    fitted = model.stages[-1] if isinstance(model, PipelineModel) else model
    stages = model.stages if isinstance(model, PipelineModel) else []
    bins = next((s.getSplitsArray() for s in stages if isinstance(s, Bucketizer)), None)
    spark = SparkSession.active()
    nodes = materialize(_saved(fitted, spark))
    names = F.array(*[F.lit(f) for f in features])
    level = nodes.where("id = 0").withColumn("node", F.lit(1).cast("bigint"))
    levels = [level]
    for _ in range(MOST_DEPTH):
        children = level.where("leftChild >= 0").select(
            "tree", F.inline(F.array(F.struct(F.col("leftChild").alias("id"), (F.col("node") * 2).alias("node")), F.struct(F.col("rightChild").alias("id"), (F.col("node") * 2 + 1).alias("node"))))
        )
        level = materialize(nodes.join(children, ["tree", "id"]))
        if level.isEmpty():
            break
        levels.append(level)
    rows = levels[0]
    for level in levels[1:]:
        rows = rows.unionByName(level)
    inner = F.col("leftChild") >= 0
    threshold = F.get("split.leftCategoriesOrThreshold", F.lit(0))
    # Weights of cells are numbers of rows, so the class counts add up to the rows of a node; a regression keeps their sum.
    weights = _total("impurityStats") if hasattr(fitted, "numClasses") else F.get("impurityStats", F.lit(0))
    count = weights.cast("bigint") if bins is not None else F.col("rawCount")
    if bins is not None:
        # Of bin numbers: the last value of the last bin that goes left.
        ends = F.lit([[math.nextafter(x, -math.inf) for x in splits[1:]] for splits in bins])
        threshold = F.get(F.get(ends, F.col("split.featureIndex")), F.floor(threshold).cast("int"))
    return materialize(rows.select(
        F.col("tree").cast("int").alias("tree"),
        "id",
        "node",
        F.floor(F.log2("node")).cast("int").alias("depth"),
        F.when(inner, F.get(names, F.col("split.featureIndex"))).alias("feature"),
        F.when(inner, threshold).alias("threshold"),
        F.when(inner, F.col("leftChild")).alias("left"),
        F.when(inner, F.col("rightChild")).alias("right"),
        count.alias("n"),
        "impurity",
        F.when(inner, F.col("gain")).alias("gain"),
        "prediction",
        F.col("impurityStats").alias("stats"),
        "weight",
    ))


def _forest(table: DataFrame, features: Sequence[str]) -> Column:
    """All trees as one array of structs of node arrays in order of id, a scalar as large as the model."""
    names = F.array(*[F.lit(f) for f in features])
    total = F.aggregate("stats", F.lit(0.0), lambda a, x: a + x)
    fields = {"feature": F.array_position(names, F.col("feature")).cast("int") - 1, "threshold": F.col("threshold"), "left": F.col("left"), "right": F.col("right"), "value": F.col("prediction"), "share": F.get("stats", F.lit(1)) / total}
    nodes = F.array_sort(F.collect_list(F.struct("id", *[c.alias(n) for n, c in fields.items()])))
    trees = table.groupBy("tree").agg(F.first("weight").alias("weight"), nodes.alias("nodes"))
    arrays = trees.select("tree", "weight", *[F.col("nodes")[n].alias(n) for n in fields])
    return arrays.agg(F.array_sort(F.collect_list(F.struct("tree", "weight", *fields))).alias("forest")).scalar()


def _path(tree: Column, values: Column, depth: int) -> Column:
    """Ids of the nodes that a row passes in one tree; a value at the threshold goes left, as does no value."""

    def step(path: Column, _: Column) -> Column:
        at = F.element_at(path, -1)
        right = F.coalesce(F.get(values, F.get(tree["feature"], at)) > F.get(tree["threshold"], at), F.lit(False))
        onward = F.when(right, F.get(tree["right"], at)).otherwise(F.get(tree["left"], at))
        return F.when(F.get(tree["feature"], at).isNull(), path).otherwise(F.concat(path, F.array(onward)))

    start = F.array(F.lit(0))
    return F.aggregate(F.sequence(F.lit(1), F.lit(depth)), start, step) if depth else start


def _walked(table: DataFrame, rows: DataFrame, key: str, features: Sequence[str]) -> DataFrame:
    """key, forest and the path of the row in every tree: a narrow step, whatever the number of rows."""
    depth = table.agg(F.max("depth")).first()[0] or 0
    values = rows.select(key, F.array(*[F.col(f).cast("double") for f in features]).alias("_values"), _forest(table, features).alias("_forest"))
    return values.withColumn("_paths", F.transform("_forest", lambda t: F.struct(t["tree"].alias("tree"), _path(t, F.col("_values"), depth).alias("ids"))))


def routed(table: DataFrame, rows: DataFrame, key: str, features: Sequence[str]) -> DataFrame:
    """(key, tree, id): every node that a row passes in every tree; rows with equal keys are routed each."""
    paths = _walked(table, rows, key, features).select(key, F.explode("_paths").alias("p"))
    return paths.select(key, F.col("p.tree").alias("tree"), F.explode("p.ids").alias("id"))


def _leaf(field: str) -> Column:
    """A field of the leaves that a row reaches, in order of the trees."""
    return F.zip_with("_forest", "_paths", lambda t, p: F.get(t[field], F.element_at(p["ids"], -1)))


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x)


def table_classes(table: DataFrame, rows: DataFrame, key: str, features: Sequence[str]) -> DataFrame:
    """(key, predicted, score) of two classes: the mean class share of the leaves, class 0 on a tie."""
    scored = _walked(table, rows, key, features).select(key, (_total(_leaf("share")) / F.size("_forest")).alias("score"))
    return scored.select(key, (F.col("score") > 0.5).cast("int").alias("predicted"), "score")


def table_values(table: DataFrame, rows: DataFrame, key: str, features: Sequence[str], boosted: bool = False) -> DataFrame:
    """(key, predicted) of a regression: the mean of the leaves, or their weighted sum in a boosted ensemble."""
    weights = F.transform("_forest", lambda t: t["weight"])
    value = _total(F.zip_with(_leaf("value"), weights, lambda v, w: v * w)) if boosted else _total(_leaf("value")) / F.size("_forest")
    return _walked(table, rows, key, features).select(key, value.alias("predicted"))


def table_importances(table: DataFrame, weighted: bool = False) -> DataFrame:
    """(feature, importance): gains times rows, each tree brought to sum 1, summed over trees and brought to sum 1.

    Features without a split are not listed. In a boosted ensemble trees count by their weight.
    """
    gains = table.where(F.col("feature").isNotNull()).groupBy("tree", "weight", "feature").agg(F.sum(F.col("gain") * F.col("n")).alias("g"))
    totals = gains.groupBy("tree").agg(F.sum("g").alias("total"))
    share = F.col("g") / F.nullif("total", F.lit(0.0)) * (F.col("weight") if weighted else F.lit(1.0))
    shares = gains.join(totals, "tree").groupBy("feature").agg(F.sum(share).alias("s"))
    return shares.select("feature", (F.col("s") / shares.agg(F.sum("s")).scalar()).alias("importance"))
