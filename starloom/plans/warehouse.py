"""Raw tables to star schema: one lazy plan per warehouse table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.functions.numeric import epoch_ms_to_timestamp, flag, midpoint, month_label, ratio_or_null
from starloom.operators.filters import in_range
from starloom.operators.joins import with_counts, with_details, with_dimension
from starloom.operators.project import present, standard_names

# Plausible yearly salaries of the salary dimension.
SALARY_RANGE = (10_000.0, 500_000.0)
COMPANY_ATTRIBUTES = ("name", "company_size", "state", "country")
SALARY_ATTRIBUTES = ("salary_midpoint", "min_salary", "max_salary", "pay_period")


def clean_salaries(salaries: DataFrame) -> DataFrame:
    """Salary dimension with its midpoint, implausible rows removed."""
    salaries = standard_names(salaries)
    if not {"min_salary", "max_salary"} <= set(salaries.columns):
        return salaries
    return in_range(salaries.withColumn("salary_midpoint", midpoint("min_salary", "max_salary")), "salary_midpoint", *SALARY_RANGE)


#: Source tables that are joined by the job.
JOB_TABLES = ("job_postings", "job_skills", "salaries")


def bucketed_sources(tables: Mapping[str, DataFrame], database: str, buckets: int, key: str = "job_id") -> dict[str, DataFrame]:
    """The source tables, those of a job saved to a catalog database in `buckets` buckets by the job, sorted in each.

    Each is shuffled once, when it is written; every later join or count by the job reads matching buckets. `buckets`
    should give files of a few hundred MB and is kept with the tables. Rows without a key lie in one bucket.
    """
    out = dict(tables)
    for name in JOB_TABLES:
        df = standard_names(tables[name])
        if key in df.columns:
            df.repartition(buckets, key).write.mode("overwrite").format("parquet").bucketBy(buckets, key).sortBy(key).saveAsTable(f"{database}.{name}")
            out[name] = df.sparkSession.table(f"{database}.{name}")
    return out


def build_fact(tables: Mapping[str, DataFrame], unique_salaries: bool = False, bucketed: bool = False) -> DataFrame:
    """Postings joined with company, salary and category count, plus derived columns.

    Salary rows may repeat a job; `unique_salaries` keeps the fact table at one row per posting. With `bucketed` the
    tables are those of `bucketed_sources`, and no join by the job shuffles.
    """
    fact = standard_names(tables["job_postings"])
    first = list(fact.columns)
    bridge = standard_names(tables["job_skills"])
    # All joins by the job come first and share one shuffle of the postings; the company's key, which ends it, comes last,
    # and columns that are derived from others are not shuffled at all.
    if "job_id" in bridge.columns:
        fact = with_counts(fact, bridge, "job_id", "skill_count")
    salaries = clean_salaries(tables["salaries"])
    attributes = present(salaries, SALARY_ATTRIBUTES)
    if unique_salaries:
        row = F.min(F.struct(*attributes)).alias("_row")
        salaries = salaries.groupBy("job_id").agg(row).select("job_id", "_row.*")
        fact = with_dimension(fact, salaries, "job_id", attributes)
    else:
        fact = with_details(fact, salaries, "job_id", attributes, nulls_apart=bucketed)
    companies = standard_names(tables["companies"])
    of_company = present(companies, COMPANY_ATTRIBUTES)
    fact = with_dimension(fact, companies, "company_id", of_company)
    if "original_listed_time" in fact.columns:
        fact = fact.withColumn("listed_date", epoch_ms_to_timestamp("original_listed_time"))
        fact = fact.withColumn("listed_month", month_label("listed_date"))
    remote = flag("remote_allowed") if "remote_allowed" in fact.columns else F.lit(0)
    fact = fact.withColumn("is_remote", remote)
    if {"applies", "views"} <= set(fact.columns):
        fact = fact.withColumn("apply_rate", ratio_or_null("applies", "views"))
    # Postings, what is derived from them, companies, salaries, counts.
    last = [*of_company, *attributes, *[f"{c}_y" for c in attributes], "skill_count", "apply_rate"]
    rank = {c: i for i, c in enumerate([*first, *[f"{c}_x" for c in first], "listed_date", "listed_month", "is_remote", *last])}
    place = {c: rank.get(c, len(rank)) for c in fact.columns}
    return fact.select(*sorted(fact.columns, key=lambda c: place[c]))


def build_star(tables: Mapping[str, DataFrame], unique_salaries: bool = False) -> dict[str, DataFrame]:
    """The warehouse tables by name."""
    return {
        "fact_job_postings": build_fact(tables, unique_salaries),
        "dim_companies": standard_names(tables["companies"]),
        "dim_salaries": clean_salaries(tables["salaries"]),
        "bridge_job_skills": standard_names(tables["job_skills"]),
        "dim_benefits": tables["benefits"],
    }
