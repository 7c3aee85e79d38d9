"""Mining operators against brute force and closed forms."""

import itertools
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from starloom.mining import cluster, rules, scores, supervised
from starloom.mining.features import classification_frame, regression_frame
from starloom.mining.scorecard import scorecard

RNG = np.random.default_rng(11)


@pytest.fixture(scope="module")
def baskets():
    pool = list("abcdefgh")
    weights = np.array([8, 7, 6, 5, 4, 3, 2, 1], dtype=float)
    return {
        k: set(RNG.choice(pool, size=int(RNG.integers(1, 6)), replace=False, p=weights / weights.sum()).tolist())
        for k in range(400)
    }


@pytest.fixture(scope="module")
def bridge(spark, baskets):
    rows = [(k, i) for k, items in baskets.items() for i in items] + [(0, next(iter(baskets[0])))] * 50
    return spark.createDataFrame(rows, "job_id int, item string")


def brute_itemsets(baskets, support):
    n = len(baskets)
    found = {}
    items = sorted(set().union(*baskets.values()))
    for size in range(1, len(items) + 1):
        for combo in itertools.combinations(items, size):
            count = sum(set(combo) <= b for b in baskets.values())
            if count >= support * n:
                found[combo] = count
    return found


def test_itemsets_and_rules(bridge, baskets):
    found = rules.frequent_itemsets(rules.baskets(bridge, "job_id", "item"), 0.05)
    expected = brute_itemsets(baskets, 0.05)
    got = {tuple(r["items"]): (r["n"], r["length"]) for r in found.collect()}
    assert got == {k: (v, len(k)) for k, v in expected.items()}
    n = len(baskets)
    wanted = {}
    for items, count in expected.items():
        for size in range(1, len(items)):
            for left in itertools.combinations(items, size):
                right = tuple(i for i in items if i not in left)
                confidence = count / expected[left]
                if confidence >= 0.3:
                    wanted[left, right] = (count / n, confidence, confidence / (expected[right] / n))
    table = rules.association_rules(found, 0.3).collect()
    got = {(tuple(r["antecedents"]), tuple(r["consequents"])): r for r in table}
    assert set(got) == set(wanted) and any(len(c) > 1 for _, c in got)
    for key, (support, confidence, lift) in wanted.items():
        row = got[key]
        assert (row["support"], row["confidence"], row["lift"]) == pytest.approx((support, confidence, lift))
        a, c = row["antecedent_support"], row["consequent_support"]
        assert row["leverage"] == pytest.approx(support - a * c)
        assert row["conviction"] == (pytest.approx((1 - c) / (1 - confidence)) if confidence < 1 else float("inf"))


def test_top_items_bound_the_baskets(bridge, baskets):
    counts = Counter(i for items in baskets.values() for i in items)
    extra = next(iter(baskets[0]))
    counts[extra] += 50
    kept = set(sorted(counts, key=lambda i: (-counts[i], i))[:3])
    got = {r["job_id"]: set(r["items"]) for r in rules.baskets(bridge, "job_id", "item", 3).collect()}
    assert got == {k: b & kept for k, b in baskets.items() if b & kept}


def test_splits_of_long_itemsets(spark):
    """More items than fit into one split number part."""
    items = [f"i{j:02d}" for j in range(17)]
    df = spark.createDataFrame([(items, 0.5, 17)], "items array<string>, support double, length int")
    got = rules._splits(df).agg(
        F.count(F.lit(1)), F.countDistinct("antecedents"), F.max(F.size("antecedents")), F.min(F.size("consequents"))
    )
    assert tuple(got.first()) == (2**17 - 2, 2**17 - 2, 16, 1)


def test_no_itemset_gives_no_rules(spark):
    one = spark.createDataFrame([(i, f"x{i}") for i in range(50)], "job_id int, item string")
    found = rules.frequent_itemsets(rules.baskets(one, "job_id", "item"), 0.5)
    assert found.count() == 0 and rules.association_rules(found).count() == 0
    assert rules.rule_summary(rules.association_rules(found)).first()["total_rules"] == 0


def blobs(spark, n=240, k=3, d=4):
    centres = RNG.normal(0, 10, (k, d))
    labels = RNG.integers(0, k, n)
    points = centres[labels] + RNG.normal(0, 1, (n, d))
    rows = [(i, int(c), p.tolist()) for i, (c, p) in enumerate(zip(labels, points, strict=True))]
    return spark.createDataFrame(rows, "id bigint, cluster int, features array<double>"), points, labels


def brute_silhouette(points, labels):
    distance = np.sqrt(((points[:, None] - points[None]) ** 2).sum(-1))
    values = []
    for i, own in enumerate(labels):
        same = (labels == own) & (np.arange(len(labels)) != i)
        if not same.any():
            values.append(0.0)
            continue
        a = distance[i, same].mean()
        b = min(distance[i, labels == c].mean() for c in set(labels) if c != own)
        values.append((b - a) / max(a, b))
    return float(np.mean(values))


def test_cluster_indices(spark):
    df, points, labels = blobs(spark)
    labels[0] = 9
    df = df.withColumn("cluster", F.when(F.col("id") == 0, 9).otherwise(F.col("cluster")))
    assert cluster.silhouette(df, "id").first()["silhouette"] == pytest.approx(brute_silhouette(points, labels))
    df, points, labels = blobs(spark)
    centres = np.array([points[labels == c].mean(0) for c in range(3)])
    spread = [np.sqrt(((points[labels == c] - centres[c]) ** 2).sum(1)).mean() for c in range(3)]
    ratio = [
        max((spread[i] + spread[j]) / np.linalg.norm(centres[i] - centres[j]) for j in range(3) if j != i) for i in range(3)
    ]
    assert cluster.davies_bouldin(df).first()["davies_bouldin"] == pytest.approx(np.mean(ratio))
    sizes = {r["cluster"]: (r["n"], r["share"]) for r in cluster.cluster_sizes(df).collect()}
    assert sizes == {c: (int((labels == c).sum()), pytest.approx((labels == c).mean())) for c in range(3)}


def test_kmeans_finds_blobs_and_k(spark):
    df, _, labels = blobs(spark)
    matrix = df.select("id", "features").union(df.select("id", "features").where("id < 0"))
    model = cluster.fit_kmeans(matrix, 3, restarts=4)
    got = {r["id"]: r["cluster"] for r in cluster.assign(model, matrix).collect()}
    assert len({(int(labels[i]), c) for i, c in got.items()}) == 3
    table = cluster.choose_k(matrix, "id", (2, 3, 4), restarts=3)
    assert cluster.best_k(table) == 3


def test_clusters_of_the_catalogue_have_the_best_k(spark, monkeypatch):
    from starloom.plans.catalog import clustering

    df, _, labels = blobs(spark)
    monkeypatch.setattr(clustering, "matrix", lambda t: df.select(F.col("id").alias("job_id"), "features"))
    _, model, labelled = clustering.clustered(None, restarts=2)
    assert len(model.clusterCenters()) == 3
    assert len({(int(labels[r["job_id"]]), r["cluster"]) for r in labelled.collect()}) == 3


def test_repeated_rows_weigh_in_kmeans(spark):
    rows = [(i, [0.0]) for i in range(98)] + [(98, [1.0]), (99, [10.0])]
    df = spark.createDataFrame(rows, "id bigint, features array<double>")
    centres = sorted(float(c[0]) for c in cluster.fit_kmeans(df, 2, restarts=4).clusterCenters())
    assert centres == pytest.approx([1 / 99, 10.0])


def test_projection_is_centred_and_orthogonal(spark):
    df, points, _ = blobs(spark)
    model = cluster.fit_projection(df)
    shares = [r["explained"] for r in cluster.explained_variance(model, df).orderBy("component").collect()]
    values = np.linalg.svd(points - points.mean(0), compute_uv=False) ** 2
    assert shares == pytest.approx(list(values[:2] / values.sum()))
    rows = cluster.project(model, df).agg(F.avg("pc1"), F.avg("pc2"), F.covar_pop("pc1", "pc2")).first()
    assert list(rows) == pytest.approx([0.0, 0.0, 0.0], abs=1e-8)
    kmeans = cluster.fit_kmeans(df.select("id", "features"), 3, restarts=2)
    assert cluster.project_centroids(model, kmeans, spark).count() == 3


def test_projected_centres_belong_to_their_rows(spark):
    df, points, _ = blobs(spark)
    model, rows = cluster.fit_projection(df), df.select("id", "features")
    kmeans = cluster.fit_kmeans(rows, 3, restarts=4)
    labelled = cluster.assign(kmeans, rows)
    values = np.linalg.svd(points - points.mean(0), compute_uv=False)[:2] ** 2

    def squares(frame):
        return [r["sum_of_squares"] for r in cluster.plane_decomposition(model, frame, kmeans).orderBy("component").collect()]

    assert squares(labelled) == pytest.approx(list(values))
    # Rows under the name of another cluster, even in equal numbers, don't add up.
    wrong = squares(labelled.withColumn("cluster", (F.col("cluster") + 1) % 3))
    assert all(abs(a - b) > 1e-3 * b for a, b in zip(wrong, values))


def test_cluster_names_and_profiles(spark):
    rows = [(0, ["IT", "ENG"])] * 6 + [(0, ["IT"])] * 4 + [(1, ["XX"])] + [(1, [f"t{i}"]) for i in range(10)]
    df = spark.createDataFrame(rows, "cluster int, items array<string>")
    shares = cluster.item_shares(df)
    names = {r["cluster"]: r["name"] for r in cluster.cluster_names(shares).collect()}
    assert names == {0: "Info Technology & Engineering", 1: "XX"}
    profile = cluster.cluster_profile(shares, 5).where("cluster = 1")
    assert profile.count() == 5


def test_matrix_without_complete_attributes(spark):
    bridge = spark.createDataFrame([(1, "a"), (1, "b"), (2, "a"), (3, "a")], "job_id int, item string")
    fact = spark.createDataFrame([(1, 2, 0), (2, 4, 1)], "job_id int, experience_encoded int, is_remote int")
    partial = cluster.category_matrix(bridge, fact, "job_id", "item").orderBy("job_id").collect()
    assert [r["features"] for r in partial] == [[1.0, 1.0], [1.0, 0.0], [1.0, 0.0]]
    full = cluster.category_matrix(bridge.where("job_id < 3"), fact, "job_id", "item").orderBy("job_id").collect()
    assert [r["features"] for r in full] == [[1.0, 1.0, 0.0, 0.0], [1.0, 0.0, 0.5, 0.5]]
    alone = cluster.category_matrix(bridge, None, "job_id", "item").orderBy("job_id").first()
    assert alone["features"] == [1.0, 1.0]


def test_classification_metrics(spark):
    rows = [("m", 1, 1, 0.9), ("m", 0, 1, 0.8), ("m", 0, 0, 0.1), ("m", 1, 0, 0.3), ("m", 0, 0, 0.2)]
    df = spark.createDataFrame(rows, "model string, actual int, predicted int, score double")
    cells = {(r["actual"], r["predicted"]): r["n"] for r in scores.confusion(df, "actual", "predicted").collect()}
    assert cells == {(0, 0): 2, (0, 1): 1, (1, 0): 1, (1, 1): 1}
    report = {r["label"]: r for r in scores.class_report(df, "actual", "predicted").collect()}
    assert report["1"]["precision"] == 0.5 and report["0"]["recall"] == pytest.approx(2 / 3)
    assert report["accuracy"]["f1"] == 0.6 and report["weighted avg"]["support"] == 5
    row = scores.classifier_comparison(df, "model", "actual", "predicted", "score").first()
    assert row["accuracy"] == 0.6
    assert row["f1"] == pytest.approx((3 * 2 / 3 + 2 * 0.5) / 5)
    assert row["auc"] == pytest.approx(5 / 6)
    never = scores.class_report(df.withColumn("predicted", F.lit(0)), "actual", "predicted").where("label = '1'").first()
    assert (never["precision"], never["recall"], never["f1"]) == (0.0, 0.0, 0.0)


def test_regression_metrics(spark):
    df = spark.createDataFrame([(0.0, 1.0), (2.0, 1.0), (4.0, 5.0)], "y double, p double")
    row = scores.regression_metrics(df, "y", "p").first()
    assert (row["rmse"], row["mae"]) == (1.0, 1.0)
    assert row["r2"] == pytest.approx(1 - 3 / 8) and row["mape"] == pytest.approx((50 + 25) / 2)
    assert tuple(scores.axis_limits(df, "y", "p").first()) == (0.0, 5.0)
    bins = scores.residual_histogram(df, "y", "p", 4)
    assert bins.agg(F.sum("n")).first()[0] == 3 and bins.first()["mean_residual"] == pytest.approx(-1 / 3)


@pytest.fixture(scope="module")
def postings(spark):
    n = 600
    views = RNG.integers(1, 500, n).astype(float)
    level = RNG.integers(0, 6, n)
    salary = 30_000 + 12_000.0 * level + 20 * views + RNG.normal(0, 3_000, n)
    demand = (views + RNG.normal(0, 80, n) > 260).astype(float)
    rows = [
        (i, float(views[i]), int(level[i]), int(i % 3 == 0), "text", float(salary[i]) if i % 4 else None,
         float(demand[i]) if i % 5 else None)
        for i in range(n)
    ]
    schema = (
        "job_id bigint, views double, experience_encoded int, work_PART_TIME int, work_type string, "
        "salary_clean double, high_demand double"
    )
    return spark.createDataFrame(rows, schema)


def test_feature_frames(postings):
    frame = classification_frame(postings)
    assert frame.columns == ["job_id", "views", "experience_encoded", "work_PART_TIME", "high_demand"]
    assert frame.count() == 480 and regression_frame(postings).count() == 450
    with pytest.raises(ValueError):
        classification_frame(postings.drop("high_demand"))


def test_linear_models_meet_their_closed_forms(spark, postings):
    task = supervised.regression_task(postings)
    models = supervised.fit_regressors(task, ["Linear Regression", "Ridge Regression"])
    train = task.train.select(*task.features, task.label).toPandas().to_numpy(dtype=float)
    x, y = train[:, :-1], train[:, -1]
    xc, yc = x - x.mean(0), y - y.mean()
    for name, alpha in (("Linear Regression", 0.0), ("Ridge Regression", 1.0)):
        weights = np.linalg.solve(xc.T @ xc + alpha * np.eye(x.shape[1]), xc.T @ yc)
        assert list(models[name].stages[-1].coefficients) == pytest.approx(list(weights), rel=1e-6)
    predictions = supervised.value_predictions(task, models)
    assert predictions.count() == 2 * task.test.count()
    back = predictions.select(F.max(F.abs(F.col("actual_value"))), F.min("actual_value")).first()
    assert back[0] > 30_000
    metrics = scores.regression_metrics(predictions, "actual_value", "predicted_value", by=["model"])
    assert supervised.best_model(metrics, "r2") in models
    assert all(r["r2"] > 0.9 for r in metrics.collect())


def test_classifiers(spark, postings):
    task = supervised.classification_task(postings)
    by_class = task.rows.groupBy("high_demand").agg(F.avg("is_test").alias("share")).collect()
    assert all(r["share"] == pytest.approx(0.2, abs=0.01) for r in by_class)
    models = supervised.fit_classifiers(task, ["Logistic Regression", "Decision Tree"])
    table = scores.classifier_comparison(
        supervised.class_predictions(task, models), "model", "actual", "predicted", "score"
    )
    assert all(r["auc"] > 0.8 for r in table.collect())
    # Stationarity of 1/2 |w|^2 + sum of log losses.
    fitted = models["Logistic Regression"].stages[-1]
    data = task.train.select(*task.features, task.label).toPandas().to_numpy(dtype=float)
    x, y, w = data[:, :-1], data[:, -1], fitted.coefficients.toArray()
    p = 1 / (1 + np.exp(-(x @ w + fitted.intercept)))
    assert np.abs(w + x.T @ (p - y)).max() < 0.05 * np.abs(x.T @ (0.5 - y)).max()
    shares = supervised.importances(models["Decision Tree"], task.features, spark, top=2)
    assert shares.count() == 2 and shares.agg(F.sum("share")).first()[0] == pytest.approx(1.0)


def test_classifiers_score_after_an_observation(spark, postings):
    """A session that used an Observation cannot be serialised, so no model may carry it along."""
    from pyspark.sql import Observation

    seen = Observation()
    spark.range(3).observe(seen, F.count(F.lit(1)).alias("n")).collect()
    assert seen.get["n"] == 3
    task = supervised.classification_task(postings)
    models = supervised.fit_classifiers(task)
    assert not any(m.stages[-1].hasSummary for m in models.values() if hasattr(m.stages[-1], "hasSummary"))
    assert supervised.class_predictions(task, models).count() == 3 * task.test.count()


def test_trees_and_boosting(spark, postings):
    task = supervised.regression_task(postings)
    estimators = supervised.regressors(100, 1.0, ["Random Forest", "Gradient Boosting"])
    small = {
        "Random Forest": estimators["Random Forest"].copy({estimators["Random Forest"].numTrees: 5}),
        "Gradient Boosting": estimators["Gradient Boosting"].copy({estimators["Gradient Boosting"].maxIter: 5}),
    }
    models = supervised.fit_all(task, small)
    metrics = scores.regression_metrics(supervised.value_predictions(task, models), "actual", "predicted", by=["model"])
    assert all(r["r2"] > 0.3 for r in metrics.collect())


def test_scorecard_leaves_out_missing_tasks(spark):
    row = spark.createDataFrame([(0.9, 0.8, 0.7)], "accuracy double, f1 double, roc_auc double")
    got = [tuple(r) for r in scorecard({"classification": row}).collect()]
    assert got == [("classification", "accuracy", 0.9), ("classification", "f1", 0.8), ("classification", "roc_auc", 0.7)]


def test_rule_numbers_count_all_rules(spark, small):
    from starloom.plans.catalog import QUERIES

    listed = QUERIES["arm_rules"](spark, small)
    weakest = listed.agg(F.min("confidence")).first()[0]
    numbers = QUERIES["arm_eval"](spark, small).first()
    assert numbers["total_rules"] == listed.count() and numbers["min_confidence"] == weakest < 0.3


def test_fits_have_more_partitions_with_more_rows(spark, postings, monkeypatch):
    from starloom import session

    assert [session.fit_partitions(n) for n in (0, 8_000_000, 8_000_001, 45_000_000)] == [32, 32, 33, 180]
    monkeypatch.setattr(session, "FIT_ROWS", 10)
    for task, n in ((supervised.classification_task(postings), 48), (supervised.regression_task(postings), 45)):
        assert (task.partitions, task.rows.rdd.getNumPartitions()) == (n, n)
    assert supervised.regression_task(postings, partitions=5).rows.rdd.getNumPartitions() == 5
