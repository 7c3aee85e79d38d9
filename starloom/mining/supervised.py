"""Fitted classifiers and regressors: training, predictions, selection and importances."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import partial
from threading import Lock

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import Bucketizer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.functions.encode import REGRESSION_LABELS, feature_label
from starloom.mining import cells, forests
from starloom.mining.features import classification_frame, regression_frame
from starloom.operators.ranking import best_by, share_of_selection
from starloom.operators.sampling import split_rows, stratified_split
from starloom.operators.scaling import unscaled, with_scaled_target
from starloom.operators.sets import stack
from starloom.session import FIT_PARTITIONS, fit_partitions, in_threads, materialize, scratch, stored_for_fits

SEED, TEST_SHARE = 42, 0.2
# Node numbers are kept per row instead of walking every tree again, and a whole tree level fits into one pass.
TREE_SETTINGS = {"cacheNodeIds": True, "maxMemoryInMB": 1024}
# A single tree tries every midpoint between values where a feature has at most so many, and quantiles beyond that.
EXACT_BINS = 1024
# A forest takes the rows up to so many: with one fit of all trees 0.5 million rows of classes took 28 s, 54 s with a fit for each
# tree on the cells, and 5.3 million 218 s and 81 s. Beyond that it takes the cells, or, if these hold fewer rows each than this on
# average, the rows with a few trees at a time.
FOREST_ROWS, FOREST_ROWS_A_CELL = 2_000_000, 8


@dataclass(frozen=True)
class Task:
    """A materialised train/test frame with its feature names and label column."""

    rows: DataFrame
    features: list[str]
    key: str
    label: str
    target: str | None = None  # the column that the label was made from
    partitions: int = FIT_PARTITIONS  # of the stored rows; with the seed it decides what learners draw
    kept: dict = field(default_factory=dict, compare=False, repr=False)  # cells of the training rows, see `task_cells`
    lock: object = field(default_factory=Lock, compare=False, repr=False)

    @property
    def train(self) -> DataFrame:
        return self.rows.where(F.col("is_test") == 0)

    @property
    def test(self) -> DataFrame:
        return self.rows.where(F.col("is_test") == 1)


def classification_task(
    df: DataFrame, key: str = "job_id", target: str = "high_demand", partitions: int | None = None
) -> Task:
    """Stratified 80/20 split of the classification frame, in as many partitions as its rows ask for unless they are given."""
    frame = classification_frame(df, key, target)
    partitions = partitions or fit_partitions(frame.count())
    features = [c for c in frame.columns if c not in (key, target)]
    return Task(stored_for_fits(stratified_split(frame, key, target, test_share=TEST_SHARE, seed=SEED), key, partitions), features, key, target, target, partitions)


def regression_task(
    df: DataFrame, key: str = "job_id", target: str = "salary_clean", partitions: int | None = None
) -> Task:
    """80/20 split of the regression frame, in as many partitions as its rows ask for unless they are given; the target is
    scaled to [0, 1] and keeps its range beside it."""
    frame = materialize(regression_frame(df, key, target))
    partitions = partitions or fit_partitions(frame.count())
    features = [c for c in frame.columns if c not in (key, target)]
    scaled = with_scaled_target(frame, target)
    return Task(stored_for_fits(split_rows(scaled, key, TEST_SHARE, SEED), key, partitions), features, key, "target_scaled", target, partitions)


def classifiers(n_train: int, names: Sequence[str] | None = None) -> dict:
    """The three estimators; the logistic penalty 1/(C n) equals an L2 penalty with C = 1 on the summed loss."""
    all_models = {
        "Logistic Regression": LogisticRegression(
            maxIter=1000, regParam=1.0 / n_train, elasticNetParam=0.0, standardization=False, tol=1e-14
        ),
        "Decision Tree": DecisionTreeClassifier(maxDepth=6, maxBins=EXACT_BINS, seed=SEED, **TREE_SETTINGS),
        "Random Forest": RandomForestClassifier(numTrees=100, maxDepth=8, seed=SEED, **TREE_SETTINGS),
    }
    return {name: all_models[name] for name in names or all_models}


def regressors(n_train: int, target_deviation: float, names: Sequence[str] | None = None) -> dict:
    """The four estimators; Spark divides the ridge penalty by the target deviation, which is undone here."""
    ridge = 1.0 * target_deviation / n_train
    all_models = {
        "Linear Regression": LinearRegression(solver="normal", regParam=0.0),
        "Ridge Regression": LinearRegression(
            solver="normal", regParam=ridge, elasticNetParam=0.0, standardization=False
        ),
        "Random Forest": RandomForestRegressor(
            numTrees=100, maxDepth=10, featureSubsetStrategy="all", seed=SEED, **TREE_SETTINGS
        ),
        "Gradient Boosting": GBTRegressor(maxIter=100, maxDepth=4, stepSize=0.1, seed=SEED, maxMemoryInMB=1024),
    }
    return {name: all_models[name] for name in names or all_models}


def fit_all(task: Task, estimators: Mapping[str, object], at_once: int = 1) -> dict[str, PipelineModel]:
    special = {GBTRegressor: fit_on_cells, RandomForestClassifier: fit_forest, RandomForestRegressor: fit_forest}

    def fit(estimator) -> PipelineModel:
        return special.get(type(estimator), fit_on_rows)(task, estimator)

    return dict(zip(estimators, in_threads([partial(fit, e) for e in estimators.values()], task.rows.sparkSession, at_once), strict=True))


def fit_on_rows(task: Task, estimator) -> PipelineModel:
    assembler = VectorAssembler(inputCols=task.features, outputCol="features")
    return Pipeline(stages=[assembler, estimator.copy({estimator.labelCol: task.label})]).fit(task.train)


def fit_forest(task: Task, estimator: forests.Forest, most_rows: int = FOREST_ROWS) -> PipelineModel:
    """A forest on the rows, or on their cells where these are far fewer; both draw from the same distribution."""
    n = task.train.count()
    if n <= most_rows:
        return fit_on_rows(task, estimator)
    found = task_cells(task, by_label=isinstance(estimator, RandomForestClassifier))
    if found.rows.count() * FOREST_ROWS_A_CELL <= n:
        return fit_on_cells(task, estimator)
    assembler = VectorAssembler(inputCols=task.features, outputCol="features")
    learner = estimator.copy({estimator.labelCol: task.label, estimator.cacheNodeIds: False})
    return PipelineModel([assembler, forests.in_groups(assembler.transform(task.train), learner)])


def task_cells(task: Task, by_label: bool = False) -> cells.Cells:
    """The cells of the training rows; learners of one task share them."""
    with task.lock:
        if by_label not in task.kept:
            task.kept[by_label] = cells.cells(task.train, task.features, task.label, by_label)
        return task.kept[by_label]


def fit_on_cells(task: Task, estimator: GBTRegressor | forests.Forest) -> PipelineModel:
    """Boosting or a forest on the binned rows of the task, so that its rounds or trees do not scan all rows; the bins are a
    stage of the model."""
    found = task_cells(task, by_label=isinstance(estimator, RandomForestClassifier))
    assembler = VectorAssembler(inputCols=found.names, outputCol="features")
    # The bins are cut already; the learner's own number only makes it look at up to EXACT_BINS^2 cells to find them all.
    learner = estimator.copy({estimator.labelCol: task.label, estimator.maxBins: EXACT_BINS})
    if isinstance(estimator, RandomForestRegressor):
        drawn = forests.drawn_rows(found.bins.transform(task.train), found.names, task.label, learner.getNumTrees(), learner.getSeed(), task.partitions)
        model = forests.grow_values(drawn, found.names, learner, found.rows.count())
    elif isinstance(estimator, RandomForestClassifier):
        model = forests.grow(assembler.transform(found.rows), "_cell", "weight", learner)
    else:
        model = learner.copy({learner.weightCol: "weight"}).fit(assembler.transform(found.rows))
    return PipelineModel([found.bins, assembler, model])


def detached(model: PipelineModel) -> PipelineModel:
    """The model as it is after saving and loading, without its training summary.

    Tasks receive the whole model. The summary of a two-class model holds the session, and a session in which an
    Observation was ever used cannot be serialised.
    """
    path = scratch(SparkSession.active())
    model.write().save(path)
    return PipelineModel.load(path)


def fit_classifiers(task: Task, names: Sequence[str] | None = None) -> dict[str, PipelineModel]:
    return {name: detached(model) for name, model in fit_all(task, classifiers(task.train.count(), names)).items()}


def fit_regressors(task: Task, names: Sequence[str] | None = None) -> dict[str, PipelineModel]:
    """The fits; boosting and forest side by side where cells are few, as each is then a chain of short jobs that leaves cores idle."""
    size, deviation = task.train.agg(F.count(F.lit(1)), F.stddev_pop(task.label)).first()
    estimators = regressors(size, deviation, names)
    ensembles = [e for e in estimators.values() if isinstance(e, (GBTRegressor, RandomForestRegressor))]
    few = len(ensembles) > 1 and task_cells(task).rows.count() * FOREST_ROWS_A_CELL <= size
    return fit_all(task, estimators, at_once=len(estimators) if few else 1)


def scored(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """`model.transform(rows)`, where a model on bins is asked once for each combination of bins that occurs: its answer follows
    from these alone, and a forest takes far longer for a row than a join. The answers are stored."""
    bins = model.stages[0]
    if not isinstance(bins, Bucketizer):
        return model.transform(rows)
    names, binned = bins.getOutputCols(), bins.transform(rows)
    # Few rows of much work each, which adaptive execution would put into one task.
    asked = binned.select(*names).distinct().repartition(FIT_PARTITIONS, *names)
    answers = PipelineModel(model.stages[1:]).transform(asked)
    found = materialize(answers.select(*names, *[c for c in ("prediction", "probability") if c in answers.columns]))
    return binned.join(found, names)


def class_predictions(task: Task, models: Mapping[str, PipelineModel]) -> DataFrame:
    """(model, key, actual, predicted, score) of the test rows under every model, scored once and stored."""
    return materialize(stack([
        scored(model, task.test).select(
            F.lit(name).alias("model"),
            task.key,
            F.col(task.label).alias("actual"),
            F.col("prediction").cast("int").alias("predicted"),
            vector_to_array("probability")[1].alias("score"),
        )
        for name, model in models.items()
    ]))


def value_predictions(task: Task, models: Mapping[str, PipelineModel]) -> DataFrame:
    """(model, key, actual, predicted) on [0, 1] plus both in target units, scored once and stored."""
    return materialize(stack([
        scored(model, task.test).select(
            F.lit(name).alias("model"),
            task.key,
            F.col(task.label).alias("actual"),
            F.col("prediction").alias("predicted"),
            unscaled(task.label).alias("actual_value"),
            unscaled("prediction").alias("predicted_value"),
        )
        for name, model in models.items()
    ]))


def best_model(comparison: DataFrame, metric: str) -> str:
    """Name of the model with the largest metric (one row reaches the driver)."""
    return best_by(comparison, "model", metric).first()["model"]


def coefficients(model: PipelineModel, features: Sequence[str], spark) -> DataFrame:
    """Intercept and weights of a linear model."""
    fitted = model.stages[-1]
    rows = [("(intercept)", float(fitted.intercept)), *zip(features, map(float, fitted.coefficients), strict=True)]
    return spark.createDataFrame(rows, "feature string, weight double")


def importances(
    model: PipelineModel, features: Sequence[str], spark, top: int | None = None, labels: Mapping[str, str] = REGRESSION_LABELS
) -> DataFrame:
    """Tree-model importances with display names and their share of the listed rows."""
    values = zip(features, map(float, model.stages[-1].featureImportances.toArray()), strict=True)
    rows = spark.createDataFrame(list(values), "feature string, importance double")
    rows = rows.orderBy(F.desc("importance"), "feature")
    rows = rows.limit(top) if top else rows
    return share_of_selection(rows.withColumn("label", feature_label("feature", labels)), "importance")
