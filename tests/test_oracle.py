"""Every registered query at the smallest scale: against its SQL where there is one, else for rows."""

import pytest
from check import compare, connect

from starloom.plans.catalog import ORACLES, QUERIES

# Fits that take long even on tiny data; their parts are tested in test_mining.py.
SLOW = {"clu_best_k", "clu_evaluate", "clu_scatter", "clf_best", "clf_roc", "reg_best", "reg_compare", "reg_gbt", "set_scorecard"}


@pytest.fixture(scope="module")
def duck(small):
    return connect(small)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - SLOW))
def test_query(spark, duck, small, name):
    df = QUERIES[name](spark, small)
    if name in ORACLES:
        assert compare(df, duck, ORACLES[name]) is None
    else:
        assert df.count() > 0


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    from __spark_entry__ import entry

    assert entry(spark).count() > 0
