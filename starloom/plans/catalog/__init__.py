"""Registered queries: one per operator of the blueprint, each beside its oracle SQL."""

from starloom.plans.catalog import (  # noqa: F401  (importing registers the queries)
    aggregates,
    classification,
    clustering,
    joins,
    ranks,
    regression,
    rules,
    scalars,
    scans,
    targets,
    texts,
)
from starloom.plans.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
