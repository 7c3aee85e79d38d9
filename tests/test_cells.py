"""Boosting and forests of values on binned cells."""

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor, RandomForestRegressor
from pyspark.sql import functions as F

from starloom.mining import bundle, cells, forests, supervised, trees
from starloom.session import scratch

RNG = np.random.default_rng(11)


@pytest.fixture(scope="module")
def task(spark):
    n = 3000
    applies, level = RNG.integers(0, 9, n), RNG.integers(0, 6, n)
    salary = 30_000 + 9_000.0 * level + 4_000.0 * np.sqrt(applies) * (level > 2) + RNG.normal(0, 3_000, n)
    rows = [(i, float(applies[i]), int(level[i]), int(i % 3 == 0), float(salary[i])) for i in range(n)]
    frame = spark.createDataFrame(rows, "job_id bigint, applies double, experience_encoded int, work_PART_TIME int, salary_clean double")
    return supervised.regression_task(frame)


def test_cells_hold_all_rows(task):
    found = cells.cells(task.train, task.features, task.label)
    n, total = task.train.agg(F.count(F.lit(1)), F.sum(task.label)).first()
    m, weight, labels = found.rows.agg(F.count(F.lit(1)), F.sum("weight"), F.sum(F.col("weight") * F.col(task.label))).first()
    assert m <= 9 * 6 * 2 < n and weight == n and labels == pytest.approx(total, rel=1e-12)


def test_boosting_on_cells_is_boosting_on_rows(task):
    """The learner gets the cells, and predicts what it predicts when it is given every row."""
    boosted = supervised.regressors(1, 1.0, ["Gradient Boosting"])["Gradient Boosting"]
    boosted = boosted.copy({boosted.maxIter: 4})
    ours = supervised.fit_all(task, {"g": boosted})["g"]
    assembler = VectorAssembler(inputCols=task.features, outputCol="features")
    plain = Pipeline(stages=[assembler, boosted.copy({boosted.labelCol: task.label})]).fit(task.train)
    a, b = ({r[0]: r[1] for r in m.transform(task.test).select("job_id", "prediction").collect()} for m in (ours, plain))
    assert a.keys() == b.keys() and all(a[k] == pytest.approx(b[k], abs=1e-9) for k in a)
    assert ours.stages[-1].trees[0].numNodes > 5 and type(ours.stages[0]).__name__ == "Bucketizer"


def test_bundle_keeps_the_bins(spark, task):
    boosted = supervised.regressors(1, 1.0, ["Gradient Boosting"])["Gradient Boosting"]
    model = supervised.fit_on_cells(task, boosted.copy({boosted.maxIter: 1}))
    path = scratch(spark)
    bundle.save(path, model, bundle.about_task(task, "g"), spark)
    rows = task.test.select("job_id", *task.features, "salary_clean")
    again = bundle.load(path, spark).predict(rows).select("job_id", F.col("predicted").alias("again"))
    own = supervised.value_predictions(task, {"g": model}).select("job_id", "predicted_value")
    both = [(r[1], r[2]) for r in own.join(again, "job_id").collect()]
    assert len(both) == rows.count() and all(a == pytest.approx(b, rel=1e-9) for a, b in both)


def test_cuts():
    assert cells._cuts([0.0] * 60 + [float(k) for k in range(1, 41)], 5) == [0.0, 10.0, 20.0, 30.0]
    assert cells._cuts([1.0] * 10, 4) == []


def test_thresholds_of_features(spark):
    frame = spark.range(1000).select(F.col("id").cast("double").alias("many"), (F.col("id") % 3).cast("double").alias("few"), F.lit(1.0).alias("one"))
    many, few, one = cells.feature_cuts(frame, ["many", "few", "one"])
    assert few == [0.5, 1.5] and one == [] and len(many) == 31
    out = cells.bucketizer(["few", "one"], [few, one]).transform(spark.createDataFrame([(0.5, 1.0), (0.6, 1.0), (9.0, 5.0)], "few double, one double"))
    assert [(r["_bin_few"], r["_bin_one"]) for r in out.collect()] == [(0.0, 0.0), (1.0, 0.0), (2.0, 0.0)]


def small_forest(**params):
    forest = supervised.regressors(1, 1.0, ["Random Forest"])["Random Forest"]
    return forest.copy({forest.getParam(k): v for k, v in {"numTrees": 6, "maxDepth": 5, **params}.items()})


def test_draws_of_the_rows_of_a_cell(spark, task):
    """Every row counts: weights are Poisson numbers of the rows, and means those of drawn labels; the layout does not matter."""
    rows = spark.range(40_000).select((F.col("id") % 20).cast("int").alias("_bin_a"), ((F.col("id") * 7) % 40_000 / 40_000).alias("y"))
    drawn = lambda df: sorted(tuple(r) for r in forests.drawn_rows(df, ["_bin_a"], "y", 50, 42, 4).collect())
    found = drawn(rows)
    assert len(found) == 20 and drawn(rows.repartition(7)) == found  # 2,000 rows a cell, so cells go on over batches of 10,000
    weights, means = np.array([r[1:51] for r in found]), np.array([r[51:] for r in found])
    assert weights.mean() == pytest.approx(2000, abs=6) and weights.var() == pytest.approx(2000, rel=0.2)
    plain = {r[0]: r[1] for r in rows.groupBy("_bin_a").agg(F.avg("y")).collect()}
    errors = means - np.array([plain[r[0]] for r in found])[:, None]
    assert np.abs(errors).mean() > 0 and errors.std() == pytest.approx((1 / 12 / 2000) ** 0.5, rel=0.2)  # a bootstrap's, not 0


def test_large_forests_of_values_are_fitted_on_cells(spark, task):
    """No fit sees more rows than there are cells; tree, importances and bundle agree with the forest on rows."""
    few, many = supervised.fit_forest(task, small_forest()), supervised.fit_forest(task, small_forest(), most_rows=1000)
    assert [type(s).__name__ for s in many.stages] == ["Bucketizer", "VectorAssembler", "RandomForestRegressionModel"]
    assert many.stages[-1].getNumTrees == 6 and many.stages[-1].numFeatures == 3
    a, b = ({r[0]: r[1] for r in m.transform(task.test).select("job_id", "prediction").collect()} for m in (few, many))
    x, y = np.array([a[k] for k in sorted(a)]), np.array([b[k] for k in sorted(b)])
    assert a.keys() == b.keys() and np.corrcoef(x, y)[0, 1] > 0.995 and np.abs(x - y).mean() < 0.02
    table = trees.tree_table(many, task.features)
    roots, n = [r.n for r in table.where("id = 0").collect()], task.train.count()
    assert len(set(roots)) > 3 and all(abs(r - n) < 6 * n**0.5 for r in roots)
    own = dict(zip(task.features, many.stages[-1].featureImportances.toArray(), strict=True))
    assert {r.feature: r.importance for r in trees.table_importances(table).collect()} == pytest.approx({k: v for k, v in own.items() if v}, abs=1e-12)
    path = scratch(spark)
    bundle.save(path, many, bundle.about_task(task, "f"), spark)
    again = bundle.load(path, spark).predict(task.test.select("job_id", *task.features, "salary_clean"))
    kept = {r.job_id: r.predicted for r in again.collect()}
    scored = supervised.value_predictions(task, {"f": many}).collect()
    assert len(scored) == len(kept) and all(r.predicted_value == pytest.approx(kept[r.job_id], rel=1e-9) for r in scored)


def test_trees_of_values_are_trees_on_the_drawn_rows(task):
    """The same tree as the learner grows when it is given the cells with the draws of one tree as rows."""
    fitted = supervised.fit_on_cells(task, small_forest(numTrees=2))
    found = cells.cells(task.train, task.features, task.label)
    drawn = forests.drawn_rows(found.bins.transform(task.train), found.names, task.label, 2, supervised.SEED, task.partitions)
    assembler = VectorAssembler(inputCols=found.names, outputCol="features")
    test = assembler.transform(found.bins.transform(task.test))
    for i, tree in enumerate(fitted.stages[-1].trees):
        rows = drawn.select("*", F.explode(F.sequence(F.lit(1), F.col(f"_draw_{i}").cast("int"))).alias("_")).where(f"_draw_{i} > 0")
        plain = DecisionTreeRegressor(maxDepth=5, labelCol=f"_label_{i}").fit(assembler.transform(rows))
        a, b = ([r.prediction for r in m.transform(test).orderBy("job_id").select("prediction").collect()] for m in (tree, plain))
        assert tree.numNodes > 5 and len(a) > 400 and a == pytest.approx(b, abs=1e-9)


def test_unlike_rows_take_a_few_trees_at_a_time(spark, monkeypatch):
    """Where cells hold a few rows each, no fit of a large table keeps the draws of all trees beside each row."""
    x = RNG.normal(size=(900, 3))
    rows = [(i, *map(float, v), float(30_000 + 9_000 * v.sum())) for i, v in enumerate(x)]
    frame = spark.createDataFrame(rows, "job_id bigint, views double, applies double, work_X double, salary_clean double")
    task, sizes, fit = supervised.regression_task(frame), [], RandomForestRegressor.fit
    monkeypatch.setattr(RandomForestRegressor, "fit", lambda self, *a: sizes.append(self.getNumTrees()) or fit(self, *a))
    model = supervised.fit_forest(task, small_forest(numTrees=24), most_rows=100)
    assert sizes == [10, 10, 4] and model.stages[-1].getNumTrees == 24 and model.stages[-1].getMaxDepth() == 5
    assert len({t.toDebugString for t in model.stages[-1].trees}) == 24
    r2 = model.transform(task.test).agg(F.corr("prediction", task.label)).first()[0]
    assert r2 > 0.8


def test_a_model_on_bins_answers_once_for_equal_bins(task):
    """The same predictions as row by row, repeated rows and keys included; the forest is asked for the bins that occur only."""
    model = supervised.fit_forest(task, small_forest(), most_rows=1000)
    rows = task.test.unionByName(task.test)
    found = supervised.scored(model, rows)
    a, b = (sorted((r[0], r[1]) for r in d.select("job_id", "prediction").collect()) for d in (found, model.transform(rows)))
    assert len(a) > 1000 and a == b
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "UDF(features" not in plan  # answers are read from a stored table that is as large as the model's bins allow
