"""Registration of queries with their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

from starloom.plans.bindings import Tables, with_ctes

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, ctes: Mapping[str, str] | None = None):
    """Register a function of the bound tables under a name; without SQL only its rows are checked."""

    def register(build: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, folder: build(Tables(spark, folder))
        if sql is not None:
            ORACLES[name] = with_ctes(sql, ctes)
        return build

    return register
