"""Fits and tasks that run at the same time."""

from threading import Barrier

import numpy as np
import pytest

from starloom.mining import supervised
from starloom.mining.scorecard import SCORECARD
from starloom.plans.catalog import QUERIES, classification, clustering, regression
from starloom.plans.catalog import rules as rule_queries
from starloom.session import in_threads


def test_results_keep_their_order(spark):
    barrier = Barrier(3)
    calls = [lambda i=i: (barrier.wait(30), spark.range(i).count())[1] for i in (5, 2, 7)]
    assert in_threads(calls, spark) == [5, 2, 7]
    assert in_threads([lambda: 1, lambda: 2], spark, 1) == [1, 2] and in_threads([], spark) == []


def test_tasks_of_the_scorecard_run_side_by_side(spark, small, monkeypatch):
    """No task waits for another one to end; each metric stays with its task."""
    barrier, modules = Barrier(4), {"classification": classification, "clustering": clustering, "association_rules": rule_queries, "regression": regression}
    for place, (task, module) in enumerate(modules.items()):
        frame = spark.createDataFrame([tuple(10.0 * place + i for i in range(len(SCORECARD[task])))], SCORECARD[task])
        monkeypatch.setattr(module, "task_metrics", lambda t, frame=frame: (barrier.wait(60), frame)[1])
    found = {(r.task, r.metric): r.value for r in QUERIES["set_scorecard"](spark, small).collect()}
    assert found == {(task, m): 10.0 * place + i for place, task in enumerate(modules) for i, m in enumerate(SCORECARD[task])}


@pytest.mark.parametrize("alike", [True, False])
def test_ensembles_on_few_cells_are_fitted_side_by_side(spark, monkeypatch, alike):
    """Where rows share no cells, fits on large tables come one after the other, so that they do not fill the disk together."""
    x = np.random.default_rng(2).normal(size=(400, 2)) if not alike else np.random.default_rng(2).integers(0, 3, (400, 2))
    rows = [(i, float(a), float(b), 30_000 + 500.0 * (i % 90)) for i, (a, b) in enumerate(x)]
    task = supervised.regression_task(spark.createDataFrame(rows, "job_id bigint, views double, applies double, salary_clean double"))
    seen = []
    monkeypatch.setattr(supervised, "fit_all", lambda task, estimators, at_once=1: seen.append((list(estimators), at_once)) or {})
    supervised.fit_regressors(task)
    supervised.fit_regressors(task, ["Linear Regression"])
    assert [n for _, n in seen] == ([4, 1] if alike else [1, 1]) and len(seen[0][0]) == 4
