"""Fact table to model-ready table, as chained frame-to-frame steps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.functions.encode import COMPANY_SIZE_CODES, EXPERIENCE_CODES, dummies, ordinal, region_code
from starloom.functions.numeric import ratio_over_one, within
from starloom.functions.text import clean_text, keyword_flag, normal_title
from starloom.operators.profile import fill_text, fill_zero
from starloom.operators.scaling import demand_flag, top_share_flag, z_scores

# Columns to fill and to scale, and the range of credible salaries.
TEXT_COLUMNS = ("work_type", "formatted_experience_level", "company_size", "pay_period")
ZERO_COLUMNS = ("applies", "views", "skill_count", "apply_rate")
SCALED_COLUMNS = ("salary_clean", "applies", "views", "skill_count", "apply_rate")
SALARY_CLEAN_RANGE = (20_000.0, 500_000.0)
# Work types of the postings, with the text that fills gaps.
WORK_TYPES = ("FULL_TIME", "PART_TIME", "CONTRACT", "INTERNSHIP", "TEMPORARY", "OTHER", "VOLUNTEER", "Unknown")


def fill_missing(df: DataFrame) -> DataFrame:
    """Known text gaps become Unknown, known numeric gaps 0; salaries stay missing."""
    return fill_zero(fill_text(df, TEXT_COLUMNS), ZERO_COLUMNS)


def clean_texts(df: DataFrame) -> DataFrame:
    if "description" in df.columns:
        df = df.withColumn("description_clean", clean_text("description"))
    if "title" in df.columns:
        df = df.withColumn("title_clean", normal_title("title"))
    return df


def listed_category(c: str, values: Sequence[str]) -> Column:
    """The category itself; a value that is not listed raises instead of looking like the base level."""
    known = F.col(c).isNull() | F.col(c).isin(*values)
    unlisted = F.raise_error(F.concat(F.lit(f"{c} holds a value that is not listed: "), F.col(c)))
    return F.when(known, F.col(c)).otherwise(unlisted.cast("string"))


def encode_categories(df: DataFrame, work_types: Sequence[str] = WORK_TYPES) -> DataFrame:
    """Ordinal and dummy columns. The work types that can occur are part of the schema; the first one is the base level."""
    if "formatted_experience_level" in df.columns:
        df = df.withColumn("experience_encoded", ordinal("formatted_experience_level", EXPERIENCE_CODES, -1))
    if "work_type" in df.columns:
        df = df.withColumn("work_type", listed_category("work_type", work_types))
        df = df.withColumns(dummies("work_type", sorted(work_types), "work"))
    if "company_size" in df.columns:
        df = df.withColumn("company_size_encoded", ordinal("company_size", COMPANY_SIZE_CODES, 0))
    return df


def normalize_state(df: DataFrame) -> DataFrame:
    return df.withColumn("state", region_code("state")) if "state" in df.columns else df


def engineer_features(df: DataFrame) -> DataFrame:
    """Ratio, cleaned salary, the two targets and the seniority flag."""
    if {"applies", "views"} <= set(df.columns):
        df = df.withColumn("apply_rate", ratio_over_one("applies", "views"))
    if "normalized_salary" in df.columns:
        df = df.withColumn("salary_clean", within("normalized_salary", *SALARY_CLEAN_RANGE))
        df = top_share_flag(df, "salary_clean", "high_salary")
    if "applies" in df.columns:
        df = demand_flag(df, "applies", "high_demand")
    if "title" in df.columns:
        df = df.withColumn("is_senior_title", keyword_flag("title"))
    return df


def scale_features(df: DataFrame) -> DataFrame:
    return z_scores(df, SCALED_COLUMNS)


def preprocess(df: DataFrame, work_types: Sequence[str] = WORK_TYPES) -> DataFrame:
    return (
        df.transform(fill_missing)
        .transform(clean_texts)
        .transform(encode_categories, work_types)
        .transform(normalize_state)
        .transform(engineer_features)
        .transform(scale_features)
    )
