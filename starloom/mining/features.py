"""Feature frames of the two supervised tasks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.functions.numeric import number_or_zero
from starloom.operators.project import prefixed_columns, present

# Features of the two tasks. The apply rate would reveal the classification target.
CLASSIFICATION_FEATURES = (
    "skill_count", "views", "experience_encoded", "company_size_encoded", "is_remote", "is_senior_title",
    "high_salary",
)
REGRESSION_FEATURES = (
    "skill_count", "applies", "views", "apply_rate", "experience_encoded", "company_size_encoded", "is_remote",
    "is_senior_title",
)


def feature_names(df: DataFrame, features: Sequence[str], prefix: str = "work_") -> list[str]:
    return present(df, features) + prefixed_columns(df, prefix)


def feature_frame(
    df: DataFrame, key: str, target: str, features: Sequence[str], target_type: str, prefix: str = "work_"
) -> DataFrame:
    """(key, features..., target): rows with a known target, every feature numeric with missing as 0."""
    if target not in df.columns:
        raise ValueError(f"the frame has no target column {target!r}; run the preprocessing first")
    names = feature_names(df, features, prefix)
    known = df.where(F.col(target).isNotNull())
    return known.select(key, *[number_or_zero(known, c).alias(c) for c in names], F.col(target).cast(target_type).alias(target))


def classification_frame(df: DataFrame, key: str = "job_id", target: str = "high_demand") -> DataFrame:
    return feature_frame(df, key, target, CLASSIFICATION_FEATURES, "int")


def regression_frame(df: DataFrame, key: str = "job_id", target: str = "salary_clean") -> DataFrame:
    return feature_frame(df, key, target, REGRESSION_FEATURES, "double")
