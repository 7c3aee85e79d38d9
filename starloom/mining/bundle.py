"""Model bundles: a fitted model with all that is needed to score and judge it later.

Beside the model stands one row: features in order, key, target and its range, the split rule with its seed, the number
of partitions it was fitted on, and the figure that it was chosen by. That row is written last, so a bundle without it is incomplete and is not loaded.
A later session reads the bundle and the prepared frame only: the same test rows come out of the stored rule.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import asdict, dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.functions.numeric import number_or_zero
from starloom.mining import scores
from starloom.mining.supervised import SEED, TEST_SHARE, Task, best_model, scored
from starloom.operators.sampling import split_rows, stratified_split

SCHEMA = (
    "name string, kind string, key string, target string, features array<string>, target_low double, target_high double, "
    "seed bigint, test_share double, metric string, value double, partitions int"
)


@dataclass(frozen=True)
class About:
    """What stands beside the model; `kind` is `classes` or `values`. The range is that of a target scaled to [0, 1]."""

    name: str
    kind: str
    key: str
    target: str
    features: list[str]
    target_low: float | None = None
    target_high: float | None = None
    seed: int = SEED
    test_share: float = TEST_SHARE
    metric: str | None = None
    value: float | None = None
    partitions: int | None = None


@dataclass(frozen=True)
class Bundle:
    model: PipelineModel
    about: About

    def frame(self, df: DataFrame) -> DataFrame:
        """(key, features..., target) of rows with a known target; a missing feature column is an error."""
        a = self.about
        absent = [c for c in (*a.features, a.target) if c not in df.columns]
        if absent:
            raise ValueError(f"the frame lacks {absent}, which the model {a.name!r} was fitted on")
        kind = "int" if a.kind == "classes" else "double"
        known = df.where(F.col(a.target).isNotNull())
        return known.select(a.key, *[number_or_zero(known, c).alias(c) for c in a.features], F.col(a.target).cast(kind).alias(a.target))

    def test_rows(self, df: DataFrame) -> DataFrame:
        """The rows of the frame that were held out when the model was fitted."""
        a, frame = self.about, self.frame(df)
        if a.kind == "classes":
            split = stratified_split(frame, a.key, a.target, test_share=a.test_share, seed=a.seed)
        else:
            split = split_rows(frame, a.key, a.test_share, a.seed)
        return split.where("is_test = 1").drop("is_test")

    def predict(self, frame: DataFrame) -> DataFrame:
        """(key, actual, predicted) of rows of `frame`; classes have a score too, values are in units of the target."""
        a, rows = self.about, scored(self.model, frame)
        actual = F.col(a.target).alias("actual")
        if a.kind == "classes":
            return rows.select(a.key, actual, F.col("prediction").cast("int").alias("predicted"), vector_to_array("probability")[1].alias("score"))
        width = F.lit(a.target_high - a.target_low)
        return rows.select(a.key, actual, (F.col("prediction") * width + F.lit(a.target_low)).alias("predicted"))

    def evaluate(self, df: DataFrame) -> DataFrame:
        """One row of test metrics with the model's name: accuracy, f1, roc_auc, or rmse, mae, r2, mape."""
        rows = self.predict(self.test_rows(df)).withColumn("model", F.lit(self.about.name))
        if self.about.kind == "classes":
            found = scores.classifier_comparison(rows, "model", "actual", "predicted", "score")
            return found.withColumnRenamed("auc", "roc_auc")
        return scores.regression_metrics(rows, "actual", "predicted", by=["model"])


def save(path: str, model: PipelineModel, about: About, spark: SparkSession) -> None:
    """Write a bundle to a folder that holds none yet, its description last."""
    model.write().save(f"{path}/model")
    spark.createDataFrame([tuple(asdict(about).values())], SCHEMA).coalesce(1).write.parquet(f"{path}/about")


def load(path: str, spark: SparkSession) -> Bundle:
    about = spark.read.schema(SCHEMA).parquet(f"{path}/about").first()
    if about is None:
        raise ValueError(f"no complete model bundle in {path}")
    return Bundle(PipelineModel.load(f"{path}/model"), About(**about.asDict()))


def about_task(task: Task, name: str, metric: str | None = None, value: float | None = None) -> About:
    """The description of a model fitted on a task; the range of a scaled target is read from its rows."""
    if task.target is None or task.target == task.label:
        return About(name, "classes", task.key, task.label, list(task.features), metric=metric, value=value, partitions=task.partitions)
    row = task.rows.select("target_low", "target_high").first()
    return About(name, "values", task.key, task.target, list(task.features), row[0], row[1], metric=metric, value=value, partitions=task.partitions)


def save_best(path: str, task: Task, models: Mapping[str, PipelineModel], comparison: DataFrame, metric: str) -> str:
    """Write the bundle of the model with the largest metric of a comparison; its name is returned."""
    name = best_model(comparison, metric)
    value = comparison.where(F.col("model") == name).agg(F.max(metric)).first()[0]
    save(path, models[name], about_task(task, name, metric, value), comparison.sparkSession)
    return name
