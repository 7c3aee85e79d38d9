"""Regression metrics on fixed predictions, and fitted regressors."""

from pyspark.sql import functions as F

from starloom.functions.numeric import rounded
from starloom.mining import bundle, scores
from starloom.mining import supervised as S
from starloom.mining.features import REGRESSION_FEATURES
from starloom.operators import sets
from starloom.plans.bindings import rnd
from starloom.plans.catalog import fits
from starloom.plans.catalog.aggregates import histogram_sql
from starloom.plans.catalog.registry import query
from starloom.plans.catalog.targets import features_sql
from starloom.session import materialize, scratch

_ERR = "(actual - predicted)"
_RMSE = f"sqrt(avg({_ERR} * {_ERR}))"
_R2 = f"1 - avg({_ERR} * {_ERR}) / var_pop(actual)"
_MAPE = "avg(abs((actual - predicted) / nullif(actual, 0)) * 100)"


def _round(df, digits, *columns):
    return df.withColumns({c: rounded(c, digits) for c in columns})


def fitted(t, names=None):
    task = S.regression_task(t.prepared)
    return task, S.fit_regressors(task, names)


def predicted(t, names=None):
    return S.value_predictions(*fitted(t, names))


def compared(predictions):
    """RMSE, MAE and R2 on [0, 1] beside the RMSE in target units, per model."""
    unit = scores.regression_metrics(predictions, "actual", "predicted", by=["model"]).drop("mape")
    value = scores.regression_metrics(predictions, "actual_value", "predicted_value", by=["model"])
    return unit.join(value.select("model", F.col("rmse").alias("rmse_value")), "model")


_NAMES = [*REGRESSION_FEATURES, "work_FULL_TIME", "work_PART_TIME"]
_SPLIT = fits.split_values(features_sql(REGRESSION_FEATURES, "salary_clean", "DOUBLE"), _NAMES, "salary_clean")
OLS, RIDGE = (_SPLIT | fits.least_squares(name, len(_NAMES), penalty) for name, penalty in (("ols", 0), ("ridge", 1)))


def _weights_sql(name):
    return f"SELECT feature, {rnd('w', 8)} AS weight FROM {name}_weights JOIN {fits.named(_NAMES)} USING (i)"


def _linear_sql(model, name):
    """Metrics of a linear fit on [0, 1], and its error in target units."""
    return f"""SELECT '{model}' AS model, {rnd(_RMSE, 8)} AS rmse, {rnd(f"avg(abs({_ERR}))", 8)} AS mae, {rnd(_R2, 8)} AS r2,
        {rnd(f"{_RMSE} * any_value(high - low)", 2)} AS rmse_value FROM {name}_predictions"""


def _linear(t, model):
    return _round(_round(compared(predicted(t, [model])), 8, "rmse", "mae", "r2"), 2, "rmse_value")


@query("reg_ols", _weights_sql("ols"), OLS)
def _(t):
    """Weights of the least-squares fit; the SQL solves the normal equations."""
    task, models = fitted(t, ["Linear Regression"])
    return _round(S.coefficients(models["Linear Regression"], task.features, t.spark), 8, "weight")


@query("reg_ols_metrics", _linear_sql("Linear Regression", "ols"), OLS)
def _(t):
    return _linear(t, "Linear Regression")


@query("reg_ols_single", f"""SELECT {rnd("regr_slope(actual, predicted)", 6)} AS slope, {rnd("regr_intercept(actual, predicted)", 2)} AS intercept
    FROM priced WHERE model = 'gross'""")
def _(t):
    """Least squares on one feature through the same estimator, checkable in closed form."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression

    rows = t.priced.where(F.col("model") == "gross").select(F.col("actual"), F.col("predicted"))
    features = VectorAssembler(inputCols=["predicted"], outputCol="features").transform(rows)
    model = LinearRegression(solver="normal", labelCol="actual").fit(features)
    row = [(float(model.coefficients[0]), float(model.intercept))]
    line = t.spark.createDataFrame(row, "slope double, intercept double")
    return line.select(rounded("slope", 6).alias("slope"), rounded("intercept", 2).alias("intercept"))


@query("reg_ridge", _weights_sql("ridge"), RIDGE)
def _(t):
    """Weights of the ridge fit; the SQL solves the penalised normal equations."""
    task, models = fitted(t, ["Ridge Regression"])
    return _round(S.coefficients(models["Ridge Regression"], task.features, t.spark), 8, "weight")


@query("reg_ridge_metrics", _linear_sql("Ridge Regression", "ridge"), RIDGE)
def _(t):
    return _linear(t, "Ridge Regression")


@query("reg_rf")
def _(t):
    return compared(predicted(t, ["Random Forest"]))


@query("reg_gbt")
def _(t):
    return compared(predicted(t, ["Gradient Boosting"]))


_SPAN = "(SELECT max(o_totalprice) - min(o_totalprice) FROM orders)"


@query("reg_metrics", f"""SELECT model, {rnd(f"{_RMSE} / {_SPAN}", 8)} AS rmse, {rnd(f"avg(abs({_ERR})) / {_SPAN}", 8)} AS mae, {rnd(_R2, 8)} AS r2,
    {rnd(_RMSE, 4)} AS rmse_value FROM priced GROUP BY 1""")
def _(t):
    """Metrics on the unit scale and back in target units."""
    span = t.orders.agg(F.min("o_totalprice").alias("target_low"), F.max("o_totalprice").alias("target_high"))
    low, width = span.select("target_low").scalar(), span.select(F.col("target_high") - F.col("target_low")).scalar()
    rows = t.priced.withColumns({
        "actual_value": F.col("actual"),
        "predicted_value": F.col("predicted"),
        "actual": (F.col("actual") - low) / width,
        "predicted": (F.col("predicted") - low) / width,
    })
    return _round(_round(compared(rows), 8, "rmse", "mae", "r2"), 4, "rmse_value")


@query("reg_eval", f"""SELECT model, {rnd(_RMSE, 4)} AS rmse, {rnd(f"avg(abs({_ERR}))", 4)} AS mae, {rnd(_R2, 8)} AS r2, {rnd(_MAPE, 6)} AS mape
    FROM priced GROUP BY 1""")
def _(t):
    metrics = scores.regression_metrics(t.priced, "actual", "predicted", by=["model"])
    return _round(_round(_round(metrics, 4, "rmse", "mae"), 8, "r2"), 6, "mape")


def _kept(t, names=None):
    """The comparison of the fitted models, and the best one after it was written as a bundle and read again."""
    task, models = fitted(t, names)
    table = materialize(compared(S.value_predictions(task, models)))
    path = scratch(t.spark)
    bundle.save_best(path, task, models, table, "r2")
    return table, bundle.load(path, t.spark)


def task_metrics(t):
    """Test metrics of the best of all four models in units of the target, from its bundle; stored once a session."""
    return t._stage("regression_metrics", lambda: _kept(t)[1].evaluate(t.prepared))


@query("reg_best")
def _(t):
    """Comparison of all four models; the best one is persisted, and its R2 after reloading stands beside."""
    table, best = _kept(t)
    again = best.evaluate(t.prepared).select("model", F.col("r2").alias("r2_reloaded"), F.lit(True).alias("is_best"))
    joined = table.join(F.broadcast(again), "model", "left")  # one row a model
    return joined.withColumn("is_best", F.coalesce("is_best", F.lit(False)))


_BOTH = OLS | RIDGE | {"linear": "SELECT 'Linear Regression' AS model, actual * (high - low) + low AS actual, predicted * (high - low) + low AS predicted FROM ols_predictions "
    "UNION ALL SELECT 'Ridge Regression', actual * (high - low) + low, predicted * (high - low) + low FROM ridge_predictions"}


@query("reg_bundle", f"""SELECT model, {rnd(_RMSE, 2)} AS rmse, {rnd(f"avg(abs({_ERR}))", 2)} AS mae, {rnd(_R2, 8)} AS r2, {rnd(_MAPE, 6)} AS mape
    FROM linear GROUP BY 1 ORDER BY {_R2} DESC LIMIT 1""", _BOTH)
def _(t):
    """The better linear model: persisted, reloaded and judged in units of the target on the test rows of its rule."""
    _, best = _kept(t, ["Linear Regression", "Ridge Regression"])
    return _round(_round(_round(best.evaluate(t.prepared), 2, "rmse", "mae"), 8, "r2"), 6, "mape")


@query("reg_avp", f"""SELECT job_id, actual, {rnd("predicted", 4)} AS predicted, {rnd("(SELECT least(min(actual), min(predicted)) FROM gross_rows)", 4)} AS low,
    {rnd("(SELECT greatest(max(actual), max(predicted)) FROM gross_rows)", 4)} AS high FROM gross_rows""",
    {"gross_rows": "SELECT * FROM priced WHERE model = 'gross'"})
def _(t):
    rows = t.priced.where(F.col("model") == "gross")
    limits = scores.axis_limits(rows, "actual", "predicted")
    return rows.select(
        "job_id",
        "actual",
        rounded("predicted", 4).alias("predicted"),
        rounded(limits.select("low").scalar(), 4).alias("low"),
        rounded(limits.select("high").scalar(), 4).alias("high"),
    )


@query("reg_residuals", f"""SELECT h.*, {rnd("(SELECT avg(residual) FROM errors)", 4)} AS mean_residual
    FROM ({histogram_sql("errors", "residual", 40)}) h""",
    {"errors": "SELECT actual - predicted AS residual FROM priced WHERE model = 'gross'"})
def _(t):
    rows = t.priced.where(F.col("model") == "gross")
    return _round(scores.residual_histogram(rows, "actual", "predicted", 40), 4, "low", "high", "mean_residual")


@query("reg_importance")
def _(t):
    task, models = fitted(t, ["Random Forest"])
    return S.importances(models["Random Forest"], task.features, t.spark)


@query("reg_compare")
def _(t):
    """All four models beside the predictor that always answers the mean."""
    task, models = fitted(t)
    table = compared(S.value_predictions(task, models)).select("model", "rmse", "r2")
    return sets.with_naive_baseline(table, task.test, task.label, "Naive (always predict mean)")
