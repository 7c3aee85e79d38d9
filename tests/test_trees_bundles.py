"""Fitted trees as tables, model bundles, cluster sweeps and numbered rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from starloom.mining import bundle, cluster, supervised, trees
from starloom.operators.ranking import numbered
from starloom.session import scratch

RNG = np.random.default_rng(5)


@pytest.fixture(scope="module")
def postings(spark):
    n = 900
    views, level = RNG.integers(1, 400, n).astype(float), RNG.integers(0, 6, n)
    salary = 30_000 + 12_000.0 * level + 20 * views + RNG.normal(0, 3_000, n)
    demand = (views + 30 * level + RNG.normal(0, 80, n) > 260).astype(float)
    rows = [(i, float(views[i]), int(level[i]), int(i % 3 == 0), float(salary[i]) if i % 4 else None, float(demand[i]) if i % 5 else None) for i in range(n)]
    return spark.createDataFrame(rows, "job_id bigint, views double, experience_encoded int, work_PART_TIME int, salary_clean double, high_demand double")


@pytest.fixture(scope="module")
def classes(postings):
    task = supervised.classification_task(postings)
    estimators = supervised.classifiers(task.train.count())
    forest = estimators["Random Forest"]
    models = supervised.fit_all(task, estimators | {"Random Forest": forest.copy({forest.numTrees: 6})})
    return task, {name: supervised.detached(model) for name, model in models.items()}


@pytest.fixture(scope="module")
def values(postings):
    task = supervised.regression_task(postings)
    size, deviation = task.train.agg(F.count(F.lit(1)), F.stddev_pop(task.label)).first()
    estimators = supervised.regressors(size, deviation)
    forest, boosted = estimators["Random Forest"], estimators["Gradient Boosting"]
    return task, supervised.fit_all(task, estimators | {"Random Forest": forest.copy({forest.numTrees: 4}), "Gradient Boosting": boosted.copy({boosted.maxIter: 6})})


def _numbers(df, *columns):
    return {r[0]: tuple(r[1:]) for r in df.select(*columns).collect()}


@pytest.mark.parametrize("name", ["Decision Tree", "Random Forest"])
def test_tables_score_classes_like_the_model(classes, name):
    task, models = classes
    table = trees.tree_table(models[name], task.features)
    expected = _numbers(supervised.class_predictions(task, {name: models[name]}), "job_id", "predicted", "score")
    found = _numbers(trees.table_classes(table, task.test, "job_id", task.features), "job_id", "predicted", "score")
    assert found.keys() == expected.keys() and len(found) > 100
    assert all(found[k] == pytest.approx(expected[k], abs=1e-12) for k in found)


@pytest.mark.parametrize("name", ["Random Forest", "Gradient Boosting"])
def test_tables_score_values_like_the_model(values, name):
    task, models = values
    table = trees.tree_table(models[name], task.features)
    expected = _numbers(supervised.value_predictions(task, {name: models[name]}), "job_id", "predicted")
    found = _numbers(trees.table_values(table, task.test, "job_id", task.features, boosted=name == "Gradient Boosting"), "job_id", "predicted")
    assert found.keys() == expected.keys() and all(found[k] == pytest.approx(expected[k], abs=1e-12) for k in found)


def test_importances_from_the_table(classes, values):
    for (task, models), name in ((classes, "Decision Tree"), (classes, "Random Forest"), (values, "Random Forest")):
        own = dict(zip(task.features, models[name].stages[-1].featureImportances.toArray(), strict=True))
        found = _numbers(trees.table_importances(trees.tree_table(models[name], task.features)), "feature", "importance")
        assert {k: v for k, v in own.items() if v} == {k: pytest.approx(v[0], abs=1e-12) for k, v in found.items()}


def test_rows_of_a_tree(classes):
    """Counts of a node are those of the training rows that pass it; children's counts add up."""
    task, models = classes
    table = trees.tree_table(models["Decision Tree"], task.features)
    rows = {r.id: r for r in table.collect()}
    passed = {r.id: r["count"] for r in trees.routed(table, task.train, "job_id", task.features).groupBy("id").count().collect()}
    assert {k: r.n for k, r in rows.items()} == passed and rows[0].node == 1
    for r in rows.values():
        if r.feature is None:
            assert r.left is r.right is r.threshold is r.gain is None
        else:
            assert rows[r.left].n + rows[r.right].n == r.n and rows[r.left].node == 2 * r.node and rows[r.right].node == 2 * r.node + 1
            assert rows[r.left].depth == r.depth + 1


def test_unknown_values_go_left(spark, classes):
    task, models = classes
    table = trees.tree_table(models["Decision Tree"], task.features)
    row = spark.createDataFrame([(1, None, None, None), (1, None, None, None)], "job_id int, views double, experience_encoded double, work_PART_TIME double")
    passed = trees.routed(table, row, "job_id", task.features).join(table.select("id", "node"), "id").collect()
    assert len(passed) > 2 and all(bin(r.node).count("1") == 1 for r in passed)  # left all the way
    assert trees.routed(table, row.limit(0), "job_id", task.features).count() == 0


def test_bundle_gives_the_same_metrics_as_the_fit(spark, postings, classes, values):
    task, models = classes
    compared = supervised.class_predictions(task, models)
    from starloom.mining.scores import classifier_comparison, regression_metrics

    comparison = classifier_comparison(compared, "model", "actual", "predicted", "score")
    path = scratch(spark)
    name = bundle.save_best(path, task, models, comparison, "f1")
    kept = bundle.load(path, spark)
    before, after = comparison.where(F.col("model") == name).first(), kept.evaluate(postings.repartition(5)).first()
    assert kept.about.name == name and kept.about.metric == "f1" and kept.about.value == before.f1
    assert (after.accuracy, after.f1, after.roc_auc) == pytest.approx((before.accuracy, before.f1, before.auc), abs=1e-12)

    task, models = values
    table = regression_metrics(supervised.value_predictions(task, models), "actual_value", "predicted_value", by=["model"])
    path = scratch(spark)
    name = bundle.save_best(path, task, models, table, "r2")
    before, after = table.where(F.col("model") == name).first(), bundle.load(path, spark).evaluate(postings).first()
    assert after.asDict() == {k: pytest.approx(v, rel=1e-9) if isinstance(v, float) else v for k, v in before.asDict().items()}


def test_bundles_that_cannot_be_used(spark, postings, classes):
    task, models = classes
    path = scratch(spark)
    models["Decision Tree"].write().save(f"{path}/model")  # the description was never written
    with pytest.raises(Exception, match="(?i)path|about"):
        bundle.load(path, spark)
    path = scratch(spark)
    bundle.save(path, models["Decision Tree"], bundle.about_task(task, "Decision Tree"), spark)
    kept = bundle.load(path, spark)
    with pytest.raises(ValueError, match="views"):
        kept.evaluate(postings.drop("views"))
    assert kept.predict(kept.frame(postings.limit(0))).count() == 0


def test_sweep_keeps_its_winner(spark):
    spots = [[0.0, 0.0], [9.0, 0.0], [0.0, 9.0]]
    rows = [(i, [x + float(RNG.normal(0, 0.7)) for x in spots[i % 3]]) for i in range(300)]
    swept = cluster.sweep(spark.createDataFrame(rows, "id bigint, features array<double>"), "id", (2, 3, 4), restarts=2)
    k, score, model = swept.best
    assert k == 3 and len(model.clusterCenters()) == 3 and score == max(r.silhouette for r in swept.scores().collect())
    row = cluster.decomposition(cluster.assign(model, swept.rows), model).first()
    x = np.array([r[1] for r in rows])
    assert (row.n, row.n_nearest) == (300, 300) and row.sum_of_squares == pytest.approx(((x - x.mean(axis=0)) ** 2).sum())


def test_projection_has_fixed_signs(spark):
    x = RNG.normal(size=(200, 3)) * [5, 2, 0.1]
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "id bigint, features array<double>")
    found = np.array([(r.pc1, r.pc2) for r in cluster.project(cluster.fit_projection(rows), rows).orderBy("id").collect()])
    _, _, axes = np.linalg.svd(x - x.mean(axis=0), full_matrices=False)
    axes = axes[:2] * np.sign(axes[:2][np.arange(2), np.abs(axes[:2]).argmax(axis=1)])[:, None]
    assert found == pytest.approx((x - x.mean(axis=0)) @ axes.T, abs=1e-8)


def test_numbered_rows(spark):
    rows = spark.range(0, 1000).withColumn("v", F.xxhash64("id") % 50).repartition(7)
    found = [(r.rank, r.v, r.id) for r in numbered(rows, [F.desc("v"), F.asc("id")]).collect()]
    expected = [(i, v, k) for i, (v, k) in enumerate(sorted(((v, k) for _, v, k in found), key=lambda r: (-r[0], r[1])), 1)]
    assert sorted(found) == expected
    assert numbered(rows.limit(0), [F.asc("v")]).count() == 0


def test_versions_of_the_star_are_replaced_as_a_whole(spark):
    from starloom.sources import sinks

    root = scratch(spark)
    assert sinks.star_versions(spark, root).count() == 0
    with pytest.raises(ValueError):
        sinks.published_star(spark, root)
    first = {name: spark.range(n).withColumn("part", F.col("id") % 2) for name, n in (("fact", 10), ("dim", 3))}
    assert sinks.publish_star(first, root, {"fact": ["part"]}) == 1
    # The second table of the next version fails midway: the old version is still whole.
    broken = {"fact": spark.range(20), "dim": spark.range(5).withColumn("x", F.raise_error(F.lit("lost")).cast("int"))}
    with pytest.raises(Exception, match="lost"):
        sinks.publish_star(broken, root)
    assert {n: d.count() for n, d in sinks.published_star(spark, root).items()} == {"fact": 10, "dim": 3}
    # Tables may be computed from the version that they replace, which open readers keep.
    old = sinks.published_star(spark, root)
    assert sinks.publish_star({"fact": old["fact"].where("id < 4"), "dim": old["dim"]}, root) == 2
    assert old["fact"].count() == 10 and sinks.published_star(spark, root)["fact"].count() == 4
    assert sinks.published_star(spark, root, 1)["fact"].count() == 10
    assert sinks.drop_versions(spark, root, keep=1) == 2
    assert {n: d.count() for n, d in sinks.published_star(spark, root).items()} == {"fact": 4, "dim": 3}
