"""One table of the headline metrics of all four mining tasks."""

from __future__ import annotations

from pyspark.sql import DataFrame

from starloom.operators.sets import long_metrics, stack

# Metrics shown per task.
SCORECARD = {
    "classification": ["accuracy", "f1", "roc_auc"],
    "clustering": ["optimal_k", "silhouette", "davies_bouldin"],
    "association_rules": ["total_rules", "max_lift", "avg_confidence"],
    "regression": ["r2", "rmse", "mae", "mape"],
}


def scorecard(results: dict[str, DataFrame]) -> DataFrame:
    """(task, metric, value) from one-row metric frames; a task without a result is left out."""
    frames = [long_metrics(results[task], task, metrics) for task, metrics in SCORECARD.items() if task in results]
    return stack(frames)
