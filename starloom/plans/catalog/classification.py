"""Classification metrics on fixed scores, and fitted classifiers."""

from pyspark.sql import functions as F

from starloom.functions.encode import CLASSIFICATION_LABELS
from starloom.functions.numeric import rounded
from starloom.mining import bundle, scores, trees
from starloom.mining import supervised as S
from starloom.mining.features import CLASSIFICATION_FEATURES
from starloom.operators.statistics import roc_points
from starloom.plans.bindings import rnd
from starloom.plans.catalog import fits
from starloom.plans.catalog.ranks import COMPARISON_CTES
from starloom.plans.catalog.registry import query
from starloom.plans.catalog.targets import features_sql
from starloom.session import materialize, scratch


def _round(df, digits, *columns):
    return df.withColumns({c: rounded(c, digits) for c in columns})


def fitted(t, names=None):
    task = S.classification_task(t.prepared)
    return task, S.fit_classifiers(task, names)


def predicted(t, names=None):
    return S.class_predictions(*fitted(t, names))


def compared(predictions):
    return scores.classifier_comparison(predictions, "model", "actual", "predicted", "score")


_NAMES = [*CLASSIFICATION_FEATURES, "work_FULL_TIME", "work_PART_TIME"]
_SPLIT = fits.split_classes(features_sql(CLASSIFICATION_FEATURES, "high_demand", "INTEGER"), _NAMES, "high_demand")
_NEWTON = _SPLIT | fits.logistic(len(_NAMES))
_TREE = _SPLIT | fits.grown_tree(len(_NAMES), 6)


def _metrics_sql(model, ctes, rows):
    """The comparison of one model whose test predictions the expressions compute."""
    return f"SELECT model, {rnd('accuracy', 8)} AS accuracy, {rnd('f1', 8)} AS f1, {rnd('auc', 8)} AS auc FROM compared", ctes | COMPARISON_CTES | {
        "scored": f"SELECT '{model}' AS model, actual, predicted, score FROM {rows}"}


def _metrics(t, model):
    return _round(compared(predicted(t, [model])), 8, "accuracy", "f1", "auc")


@query("clf_logreg", f"SELECT feature, {rnd('w', 4)} AS weight FROM newton_weights JOIN {fits.named(_NAMES)} USING (i)", _NEWTON)
def _(t):
    """Weights of the penalised fit; the SQL finds the same optimum by Newton's method."""
    task, models = fitted(t, ["Logistic Regression"])
    return _round(S.coefficients(models["Logistic Regression"], task.features, t.spark), 4, "weight")


@query("clf_logreg_metrics", *_metrics_sql("Logistic Regression", _NEWTON, fits.NEWTON))
def _(t):
    return _metrics(t, "Logistic Regression")


@query("clf_tree", *_metrics_sql("Decision Tree", _TREE, fits.TREE))
def _(t):
    """Metrics of the fitted tree; the SQL grows the same tree level by level."""
    return _metrics(t, "Decision Tree")


@query("clf_tree_nodes", f"""SELECT node, CAST(depth AS INTEGER) AS depth, feature, threshold, n0 + n1 AS n, n1, n_test, {rnd("gain", 10)} AS gain
    FROM tree_nodes LEFT JOIN {fits.named(_NAMES)} USING (i)""", _TREE)
def _(t):
    """The fitted tree as rows, with the test rows that pass each node on their way through the table."""
    task, models = fitted(t, ["Decision Tree"])
    table = trees.tree_table(models["Decision Tree"], task.features)
    passed = trees.routed(table, task.test, task.key, task.features).groupBy("id").agg(F.count(F.lit(1)).alias("n_test"))
    rows = table.join(F.broadcast(passed), "id", "left")  # one row a node
    n1, n_test = F.get("stats", F.lit(1)).cast("bigint").alias("n1"), F.coalesce("n_test", F.lit(0)).alias("n_test")
    return rows.select("node", "depth", "feature", "threshold", "n", n1, n_test, rounded("gain", 10).alias("gain"))


@query("clf_tree_importance", f"""SELECT feature, {rnd("SUM(gain * (n0 + n1)) / (SELECT SUM(gain * (n0 + n1)) FROM tree_nodes)", 8)} AS importance
    FROM tree_nodes JOIN {fits.named(_NAMES)} USING (i) GROUP BY 1""", _TREE)
def _(t):
    """Importances recomputed from the rows of the tree."""
    task, models = fitted(t, ["Decision Tree"])
    return _round(trees.table_importances(trees.tree_table(models["Decision Tree"], task.features)), 8, "importance")


@query("clf_rf")
def _(t):
    return compared(predicted(t, ["Random Forest"]))


@query("clf_metrics", f"SELECT model, {rnd('accuracy', 8)} AS accuracy, {rnd('f1', 8)} AS f1, {rnd('auc', 8)} AS auc FROM compared", COMPARISON_CTES)
def _(t):
    return _round(compared(t.scored), 8, "accuracy", "f1", "auc")


def _kept(t, names=None):
    """The comparison of the fitted models, and the best one after it was written as a bundle and read again."""
    task, models = fitted(t, names)
    table = materialize(compared(S.class_predictions(task, models)))
    path = scratch(t.spark)
    bundle.save_best(path, task, models, table, "f1")
    return table, bundle.load(path, t.spark)


def task_metrics(t):
    """Test metrics of the best of all three models, from its bundle; stored once a session."""
    return t._stage("classification_metrics", lambda: _kept(t)[1].evaluate(t.prepared))


@query("clf_best")
def _(t):
    """Comparison of all three models; the best one is persisted, and its F1 after reloading stands beside."""
    table, best = _kept(t)
    again = best.evaluate(t.prepared).select("model", F.col("f1").alias("f1_reloaded"), F.lit(True).alias("is_best"))
    joined = table.join(F.broadcast(again), "model", "left")  # one row a model
    return joined.withColumn("is_best", F.coalesce("is_best", F.lit(False)))


@query("clf_bundle", f"SELECT model, {rnd('accuracy', 8)} AS accuracy, {rnd('f1', 8)} AS f1, {rnd('auc', 8)} AS roc_auc FROM compared ORDER BY f1 DESC, model LIMIT 1",
    _NEWTON | _TREE | COMPARISON_CTES | {"scored": f"SELECT 'Logistic Regression' AS model, actual, predicted, score FROM {fits.NEWTON} "
    f"UNION ALL SELECT 'Decision Tree', actual, predicted, score FROM {fits.TREE}"})
def _(t):
    """The better of logistic regression and tree: persisted, reloaded and judged on the test rows that its rule gives."""
    _, best = _kept(t, ["Logistic Regression", "Decision Tree"])
    return _round(best.evaluate(t.prepared), 8, "accuracy", "f1", "roc_auc")


_ONE = "FROM scored WHERE model = 'length'"


def _class(c, kind):
    hit = f"COUNT(*) FILTER (WHERE actual = {c} AND predicted = {c})"
    support, claimed = f"COUNT(*) FILTER (WHERE actual = {c})", f"COUNT(*) FILTER (WHERE predicted = {c})"
    parts = {
        "precision": f"coalesce({hit} / nullif({claimed}, 0)::DOUBLE, 0)",
        "recall": f"coalesce({hit} / nullif({support}, 0)::DOUBLE, 0)",
        "f1": f"coalesce(2 * {hit} / nullif({support} + {claimed}, 0)::DOUBLE, 0)",
    }
    return parts[kind], support


_PER_CLASS = " UNION ALL ".join(
    f"SELECT '{name}' AS label, " + ", ".join(f"{_class(c, m)[0]} AS {m}" for m in ("precision", "recall", "f1"))
    + f", {_class(c, 'f1')[1]} AS support {_ONE}" for c, name in ((0, "low"), (1, "high")))


@query("clf_report", f"""SELECT label, {rnd("precision", 8)} AS precision, {rnd("recall", 8)} AS recall, {rnd("f1", 8)} AS f1, support FROM (
    SELECT * FROM per_class
    UNION ALL SELECT 'accuracy', NULL, NULL, avg(CAST(actual = predicted AS DOUBLE)), COUNT(*) {_ONE}
    UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), CAST(SUM(support) AS BIGINT) FROM per_class
    UNION ALL SELECT 'weighted avg', SUM(precision * support) / SUM(support), SUM(recall * support) / SUM(support),
    SUM(f1 * support) / SUM(support), CAST(SUM(support) AS BIGINT) FROM per_class)""", {"per_class": _PER_CLASS})
def _(t):
    rows = t.scored.where(F.col("model") == "length")
    report = scores.class_report(rows, "actual", "predicted", names=["low", "high"])
    return _round(report, 8, "precision", "recall", "f1")


@query("clf_confusion", f"""SELECT CAST(a AS INTEGER) AS actual, CAST(p AS INTEGER) AS predicted,
    (SELECT COUNT(*) FROM scored WHERE model = 'length' AND actual = a AND predicted = p) AS n
    FROM (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) v(a, p)""")
def _(t):
    return scores.confusion(t.scored.where(F.col("model") == "length"), "actual", "predicted")


@query("clf_importance")
def _(t):
    task, models = fitted(t, ["Random Forest"])
    return S.importances(models["Random Forest"], task.features, t.spark, top=12, labels=CLASSIFICATION_LABELS)


@query("clf_roc")
def _(t):
    """ROC curves of the fitted models with their area."""
    predictions = predicted(t)
    curves = roc_points(predictions, "actual", "score", "model")
    return curves.join(compared(predictions).select("model", "auc"), "model")
