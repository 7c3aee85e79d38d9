"""Evaluation metrics on plain label, score and prediction columns; fitting is kept apart."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.functions.numeric import percentage_error
from starloom.operators.statistics import histogram, roc_auc


def confusion(df: DataFrame, actual: str, predicted: str, classes: Sequence[int] = (0, 1)) -> DataFrame:
    """Count per (actual, predicted) pair of the classes, pairs that never occur included."""
    listed = list(classes)
    pairs = [(a, p) for a in listed for p in listed]
    counts = [F.count_if((F.col(actual) == a) & (F.col(predicted) == p)).alias(f"_n{a}_{p}") for a, p in pairs]
    entries = [
        F.struct(F.lit(a).alias("actual"), F.lit(p).alias("predicted"), F.col(f"_n{a}_{p}").alias("n"))
        for a, p in pairs
    ]
    return df.agg(*counts).select(F.inline(F.array(*entries)))


def _safe(part: Column, whole: Column) -> Column:
    return F.coalesce(part / F.nullif(whole.cast("double"), F.lit(0.0)), F.lit(0.0))


def _class_scores(actual: str, predicted: str, classes: Sequence[int]) -> dict[int, dict[str, Column]]:
    """Aggregate expressions of precision, recall, F1 and support per class."""
    scores = {}
    for c in classes:
        hit = F.count_if((F.col(actual) == c) & (F.col(predicted) == c))
        support, claimed = F.count_if(F.col(actual) == c), F.count_if(F.col(predicted) == c)
        scores[c] = {
            "precision": _safe(hit, claimed),
            "recall": _safe(hit, support),
            "f1": _safe(hit * F.lit(2.0), claimed + support),
            "support": support,
        }
    return scores


def class_report(
    df: DataFrame, actual: str, predicted: str, classes: Sequence[int] = (0, 1), names: Sequence[str] | None = None
) -> DataFrame:
    """Precision, recall, F1 and support per class, then accuracy, macro and weighted averages."""
    names = list(names or [str(c) for c in classes])
    scores = _class_scores(actual, predicted, classes)
    aggregates = [expr.alias(f"{m}_{c}") for c, per in scores.items() for m, expr in per.items()]
    hits = F.count_if(F.col(actual) == F.col(predicted)).alias("hits")
    row = df.agg(F.count(F.lit(1)).alias("n"), hits, *aggregates)
    measures = ("precision", "recall", "f1")

    def entry(label: str, values: Sequence[Column], support: Column) -> Column:
        cells = [v.cast("double").alias(m) for m, v in zip(measures, values, strict=True)]
        return F.struct(F.lit(label).alias("label"), *cells, support.alias("support"))

    def average(measure: str, weighted: bool) -> Column:
        total = F.lit(0.0)
        for c in classes:
            total = total + F.col(f"{measure}_{c}") * (F.col(f"support_{c}") if weighted else F.lit(1.0))
        return _safe(total, F.col("n") if weighted else F.lit(float(len(classes))))

    entries = [
        entry(name, [F.col(f"{m}_{c}") for m in measures], F.col(f"support_{c}"))
        for c, name in zip(classes, names, strict=True)
    ]
    nothing = F.lit(None)
    entries.append(entry("accuracy", [nothing, nothing, _safe(F.col("hits"), F.col("n"))], F.col("n")))
    entries.append(entry("macro avg", [average(m, False) for m in measures], F.col("n")))
    entries.append(entry("weighted avg", [average(m, True) for m in measures], F.col("n")))
    return row.select(F.inline(F.array(*entries)))


def classifier_comparison(
    df: DataFrame, model: str, actual: str, predicted: str, score: str, classes: Sequence[int] = (0, 1)
) -> DataFrame:
    """Accuracy, weighted F1 and exact ROC-AUC per model."""
    scores = _class_scores(actual, predicted, classes)
    weighted = F.lit(0.0)
    for per in scores.values():
        weighted = weighted + per["f1"] * per["support"]
    n = F.count(F.lit(1))
    hits = F.count_if(F.col(actual) == F.col(predicted))
    basic = df.groupBy(model).agg((hits / n).alias("accuracy"), (weighted / n).alias("f1"))
    return basic.join(roc_auc(df, actual, score, model), model)


def regression_metrics(df: DataFrame, actual: str, predicted: str, by: Sequence[str] = ()) -> DataFrame:
    """RMSE, MAE, R2 and mean absolute percentage error (zero actuals skipped), per group."""
    y, error = F.col(actual), F.col(actual) - F.col(predicted)
    sums = df.groupBy(*by).agg(
        F.avg(error * error).alias("_mse"),
        F.avg(F.abs(error)).alias("mae"),
        F.var_pop(y).alias("_var"),
        F.avg(percentage_error(actual, predicted)).alias("mape"),
    )
    r2 = 1 - F.col("_mse") / F.nullif(F.col("_var"), F.lit(0.0))
    return sums.select(*by, F.sqrt("_mse").alias("rmse"), "mae", r2.alias("r2"), "mape")


def axis_limits(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Common range of actual and predicted values."""
    return df.agg(
        F.least(F.min(actual), F.min(predicted)).alias("low"), F.greatest(F.max(actual), F.max(predicted)).alias("high")
    )


def with_residuals(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    return df.withColumn("residual", F.col(actual) - F.col(predicted))


def residual_histogram(df: DataFrame, actual: str, predicted: str, bins: int = 40) -> DataFrame:
    """Equal-width histogram of residuals beside their mean."""
    rows = with_residuals(df, actual, predicted)
    mean = rows.agg(F.avg("residual")).scalar()
    return histogram(rows, "residual", bins).withColumn("mean_residual", mean)
