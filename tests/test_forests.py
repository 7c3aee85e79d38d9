"""Forests of classes on binned cells."""

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from starloom.mining import bundle, cells, forests, supervised, trees
from starloom.session import scratch

RNG = np.random.default_rng(3)


@pytest.fixture(scope="module")
def task(spark):
    n = 4000
    views, level = RNG.integers(0, 8, n), RNG.integers(0, 5, n)
    demand = (views + 1.5 * level + RNG.normal(0, 2, n) > 8).astype(float)
    rows = [(i, float(views[i]), int(level[i]), int(i % 3 == 0), float(demand[i])) for i in range(n)]
    frame = spark.createDataFrame(rows, "job_id bigint, views double, experience_encoded int, work_PART_TIME int, high_demand double")
    return supervised.classification_task(frame)


def small_forest(**params):
    forest = supervised.classifiers(1, ["Random Forest"])["Random Forest"]
    return forest.copy({forest.getParam(k): v for k, v in {"numTrees": 10, **params}.items()})


@pytest.fixture(scope="module")
def model(task):
    return supervised.detached(supervised.fit_forest(task, small_forest(), most_rows=1000))


def test_draws_are_those_of_the_rows_of_a_cell(spark):
    """Mean and variance of a sum of Poisson numbers of mean 1; a weighted row of Spark's forest would have 50 times the variance."""
    rows = spark.range(500).select(F.xxhash64("id").alias("key"), F.lit(50.0).alias("weight"))
    drawn = lambda df: {r[0]: r[1] for r in df.select("key", forests.draws("key", "weight", 40, 42)).collect()}
    found = drawn(rows)
    x = np.array(list(found.values()))
    assert x.shape == (500, 40) and x.mean() == pytest.approx(50, abs=0.3) and x.var() == pytest.approx(50, abs=3)
    assert abs(np.corrcoef(x[:, 0], x[:, 1])[0, 1]) < 0.2 and len({tuple(v) for v in x.tolist()}) == 500
    assert drawn(rows.repartition(7)) == found


def test_large_forests_are_fitted_on_cells(task, model):
    few, many = supervised.fit_forest(task, small_forest(numTrees=2)), model
    assert [type(s).__name__ for s in few.stages][:1] == ["VectorAssembler"]
    assert [type(s).__name__ for s in many.stages] == ["Bucketizer", "VectorAssembler", "RandomForestClassificationModel"]
    assert many.stages[-1].getNumTrees == 10 and many.stages[-1].numClasses == 2 and many.stages[-1].numFeatures == 3


def test_unlike_rows_are_no_cells(spark):
    """Where cells hold a few rows each, the forest takes the rows."""
    x = RNG.normal(size=(600, 3))
    rows = [(i, *map(float, v), float(v.sum() > 0)) for i, v in enumerate(x)]
    frame = spark.createDataFrame(rows, "job_id bigint, views double, skill_count double, work_X double, high_demand double")
    fitted = supervised.fit_forest(supervised.classification_task(frame), small_forest(numTrees=2), most_rows=100)
    assert type(fitted.stages[0]).__name__ == "VectorAssembler"


def test_trees_on_cells_are_trees_on_the_drawn_rows(task):
    """Each row as often as it was drawn gives the same tree, if every split may use all features."""
    fitted = supervised.fit_on_cells(task, small_forest(numTrees=2, featureSubsetStrategy="all", maxDepth=4))
    found = cells.cells(task.train, task.features, task.label, by_label=True)
    drawn = found.rows.withColumn("n", forests.draws("_cell", "weight", 2, supervised.SEED))
    assembler = VectorAssembler(inputCols=found.names, outputCol="features")
    test = found.bins.transform(task.test)
    for i, tree in enumerate(fitted.stages[-1].trees):
        rows = drawn.select("*", F.explode(F.sequence(F.lit(1), F.get("n", F.lit(i)).cast("int"))).alias("_")).where(F.get("n", F.lit(i)) > 0)
        plain = Pipeline(stages=[assembler, DecisionTreeClassifier(maxDepth=4, labelCol=task.label)]).fit(rows).stages[-1]
        a, b = ([tuple(r.probability) for r in m.transform(assembler.transform(test)).orderBy("job_id").select("probability").collect()] for m in (tree, plain))
        assert tree.numNodes > 5 and len(a) > 500 and a == [pytest.approx(p, abs=1e-12) for p in b]


def test_forest_on_cells_is_as_good(task, model):
    plain = supervised.detached(supervised.fit_forest(task, small_forest()))
    scores = [{r[0]: r[1] for r in supervised.class_predictions(task, {"f": m}).select("job_id", "score").collect()} for m in (model, plain)]
    a, b = (np.array([s[k] for k in sorted(s)]) for s in scores)
    assert len(a) == len(b) > 500 and np.corrcoef(a, b)[0, 1] > 0.98 and np.abs(a - b).mean() < 0.05


def test_tables_and_bundles_of_the_forest(spark, task, model):
    table = trees.tree_table(model, task.features)
    expected = {r.job_id: (r.predicted, r.score) for r in supervised.class_predictions(task, {"f": model}).collect()}
    found = {r.job_id: (r.predicted, r.score) for r in trees.table_classes(table, task.test, "job_id", task.features).collect()}
    assert found.keys() == expected.keys() and all(found[k] == pytest.approx(expected[k], abs=1e-12) for k in found)
    own = dict(zip(task.features, model.stages[-1].featureImportances.toArray(), strict=True))
    assert {r.feature: r.importance for r in trees.table_importances(table).collect()} == pytest.approx({k: v for k, v in own.items() if v}, abs=1e-12)
    roots, n = [r.n for r in table.where("id = 0").collect()], task.train.count()
    assert len(roots) == 10 and len(set(roots)) > 5 and all(abs(r - n) < 6 * n**0.5 for r in roots)
    path = scratch(spark)
    bundle.save(path, model, bundle.about_task(task, "f"), spark)
    again = bundle.load(path, spark).predict(task.test.select("job_id", *task.features, "high_demand"))
    assert again.count() == len(expected)
