"""Forests grown on weighted cells, one fit for each tree.

A forest draws a Poisson number of mean 1 for each row and tree. The numbers of rows that lie in one cell of bins and label add
up to a Poisson number whose mean is the number of rows, so one draw for each cell and tree gives the same forests, and its
cost follows the cells. Spark's own draw for a weighted row would be that of one row, times the weight.

Rows of a regression that lie in one cell have unlike labels, so there every row is drawn for every tree, once and in order of the
cells: the draws of a cell add up to its weight in the tree, the drawn labels to its mean there, and no draw is kept.
"""

from __future__ import annotations

import random
from collections.abc import Iterator, Sequence
from multiprocessing.pool import ThreadPool

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import SparkContext, TaskContext, inheritable_thread_target
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressionModel, RandomForestRegressor
from pyspark.ml.wrapper import JavaWrapper
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.session import materialize

#: Trees that are grown at the same time, each a chain of short jobs, and the rows of a task in them.
AT_ONCE, TASK_ROWS = 8, 50_000
#: Trees of one fit where rows are no cells: Spark keeps the draws of all trees of a fit beside each row.
GROUP = 10

Forest = RandomForestClassifier | RandomForestRegressor
Grown = RandomForestClassificationModel | RandomForestRegressionModel


def draws(key: str, weight: str, trees: int, seed: int) -> Column:
    """A Poisson number with mean `weight` for each tree; it depends on the row's key and the seed only."""

    @F.pandas_udf("array<double>")
    def drawn(keys: pd.Series, means: pd.Series) -> pd.Series:
        mask = (1 << 64) - 1
        return pd.Series([np.random.default_rng((seed, k & mask)).poisson(m, trees).astype(float) for k, m in zip(keys.tolist(), means, strict=True)])

    return drawn(key, weight)


def drawn_rows(rows: DataFrame, names: Sequence[str], label: str, trees: int, seed: int, partitions: int) -> DataFrame:
    """(names, _draw_i, _label_i): for each cell and tree the draws of its rows, a Poisson number of mean 1 for each, and their
    mean label, null where no row was drawn.

    Each of the partitions by cell draws from a generator of its own, in order of the cells and labels, so the draws depend on
    the rows, the seed and the number of partitions only. A task holds one batch and one cell.
    """
    narrow = rows.select(*[F.col(c).cast("int").alias(c) for c in names], F.col(label).cast("double").alias("_label"))
    placed = narrow.repartition(partitions, *names).sortWithinPartitions(*names, "_label")
    columns = [*names, *[f"_draw_{i}" for i in range(trees)], *[f"_label_{i}" for i in range(trees)]]

    def drawn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        generator = np.random.default_rng((seed, TaskContext.get().partitionId()))

        def batch(cells: np.ndarray, counts: np.ndarray, sums: np.ndarray) -> pa.RecordBatch:
            means = [pa.array(s / np.maximum(n, 1), mask=n == 0) for n, s in zip(counts.T, sums.T, strict=True)]
            bins = [pa.array(c.astype(np.int32)) for c in cells.T]
            return pa.RecordBatch.from_arrays([*bins, *[pa.array(n.astype(float)) for n in counts.T], *means], names=columns)

        last = None  # the cell that the next batch may go on with
        for rows in batches:
            if not rows.num_rows:
                continue
            *bins, labels = [c.to_numpy(zero_copy_only=False) for c in rows.columns]
            cells, draws = np.column_stack(bins), generator.poisson(1.0, (rows.num_rows, trees))
            starts = np.flatnonzero(np.r_[True, (cells[1:] != cells[:-1]).any(axis=1)])
            cells, counts = cells[starts], np.add.reduceat(draws, starts)
            sums = np.add.reduceat(draws * labels[:, None], starts)
            if last is not None and (last[0] == cells[:1]).all():
                counts[0], sums[0] = counts[0] + last[1][0], sums[0] + last[2][0]
            elif last is not None:
                yield batch(*last)
            if len(cells) > 1:
                yield batch(cells[:-1], counts[:-1], sums[:-1])
            last = cells[-1:], counts[-1:], sums[-1:]
        if last is not None:
            yield batch(*last)

    numbers = ", ".join(f"{c} double" for c in columns[len(names):])
    return placed.mapInArrow(drawn, ", ".join(f"`{c}` int" for c in names) + f", {numbers}")


def grow(rows: DataFrame, key: str, weight: str, estimator: RandomForestClassifier) -> RandomForestClassificationModel:
    """The forest of `estimator` on weighted rows (`featuresCol`, `labelCol`); `key` tells the rows apart and fixes their draws.

    Sums of draws are whole numbers, so the trees do not depend on the order or the partitions of the rows.
    """
    trees, label, features = estimator.getNumTrees(), estimator.getLabelCol(), estimator.getFeaturesCol()
    parts = rows.coalesce(-(-rows.count() // TASK_ROWS)).select(features, label, draws(key, weight, trees, estimator.getSeed()).alias("_draws"))
    # A column for each tree: a fit reads its own only.
    stored = materialize(parts.select(features, label, *[F.get("_draws", F.lit(i)).alias(f"_draw_{i}") for i in range(trees)]))
    classes = int(stored.agg(F.max(label)).first()[0]) + 1
    known = {"ml_attr": {"type": "nominal", "vals": [str(c) for c in range(classes)]}}
    return grown([stored.select(features, F.col(label).alias(label, metadata=known), F.col(f"_draw_{i}").alias("_draw")) for i in range(trees)], estimator)


def grow_values(drawn: DataFrame, names: Sequence[str], estimator: RandomForestRegressor, cells: int) -> RandomForestRegressionModel:
    """The forest of `estimator` on drawn rows (`drawn_rows`) of so many cells; the bins `names` are its features."""
    label, features = estimator.getLabelCol(), estimator.getFeaturesCol()
    placed = drawn.repartition(-(-cells // TASK_ROWS), *names).sortWithinPartitions(*names)
    stored = materialize(VectorAssembler(inputCols=list(names), outputCol=features).transform(placed).drop(*names))
    frames = [stored.select(features, F.col(f"_label_{i}").alias(label), F.col(f"_draw_{i}").alias("_draw")) for i in range(estimator.getNumTrees())]
    return grown([frame.where("_draw > 0") for frame in frames], estimator)


def _subset(estimator: Forest) -> str:
    """What "auto" means in a forest, said to a fit of one tree."""
    strategy, classes = estimator.getFeatureSubsetStrategy(), isinstance(estimator, RandomForestClassifier)
    return ("sqrt" if classes else "onethird") if strategy == "auto" and estimator.getNumTrees() > 1 else strategy


def _seeds(estimator: Forest) -> Iterator[int]:
    seeds = random.Random(estimator.getSeed())
    while True:
        yield seeds.getrandbits(63)


def grown(frames: Sequence[DataFrame], estimator: Forest) -> Grown:
    """One tree for each frame of rows with a weight `_draw`, joined to the forest of `estimator`."""
    single = {
        estimator.numTrees: 1,
        estimator.bootstrap: False,
        estimator.cacheNodeIds: False,
        estimator.featureSubsetStrategy: _subset(estimator),
        estimator.weightCol: "_draw",
    }
    fits = [(estimator.copy(single | {estimator.seed: seed}), frame) for seed, frame in zip(_seeds(estimator), frames)]
    with ThreadPool(min(AT_ONCE, len(fits))) as pool:
        fit = inheritable_thread_target(frames[0].sparkSession)(lambda f: f[0].fit(f[1]))
        return joined(pool.map(fit, fits, chunksize=1), estimator)


def in_groups(rows: DataFrame, estimator: Forest, group: int = GROUP) -> Grown:
    """The forest of `estimator` on rows, with Spark's own draws, a group of trees after the other: what Spark stores beside a
    row follows from the trees of one fit, and is dropped after it."""
    trees, found = estimator.getNumTrees(), []
    for start, seed in zip(range(0, trees, group), _seeds(estimator)):
        part = {estimator.numTrees: min(group, trees - start), estimator.featureSubsetStrategy: _subset(estimator), estimator.seed: seed}
        found.append(estimator.copy(part).fit(rows))
    return joined(found, estimator)


def joined(parts: Sequence[Grown], estimator: Forest) -> Grown:
    """The trees of several forests as one forest with the parameters of `estimator`; pyspark has no constructor for it."""
    ml, first = SparkContext._active_spark_context._jvm.org.apache.spark.ml, parts[0]
    trees = [t._java_obj for model in parts for t in model.trees]
    if isinstance(estimator, RandomForestClassifier):
        array = JavaWrapper._new_java_array(trees, ml.classification.DecisionTreeClassificationModel)
        whole = RandomForestClassificationModel(ml.classification.RandomForestClassificationModel(estimator.uid, array, first.numFeatures, first.numClasses))
    else:
        array = JavaWrapper._new_java_array(trees, ml.regression.DecisionTreeRegressionModel)
        whole = RandomForestRegressionModel(ml.regression.RandomForestRegressionModel(estimator.uid, array, first.numFeatures))
    model = estimator._copyValues(whole)
    model._transfer_params_to_java()  # a mean over trees is divided by the parameter
    return model
