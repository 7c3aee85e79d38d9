"""Joins of the star schema."""

import uuid

from pyspark.sql import functions as F

from starloom.functions.numeric import rounded
from starloom.operators import joins
from starloom.plans.bindings import rnd
from starloom.plans.catalog.registry import query
from starloom.plans.warehouse import bucketed_sources, build_fact, clean_salaries

TOP15 = {
    "top15": "SELECT skill_abr, COUNT(*) AS n FROM bridge GROUP BY 1 ORDER BY n DESC, skill_abr LIMIT 15",
    "counted": "SELECT job_id, skill_abr, COUNT(*) AS m FROM bridge SEMI JOIN top15 USING (skill_abr) GROUP BY ALL",
    "met": "SELECT a.skill_abr AS item_a, b.skill_abr AS item_b, SUM(a.m * b.m) AS n "
    "FROM counted a JOIN counted b ON a.job_id = b.job_id AND a.skill_abr <> b.skill_abr GROUP BY 1, 2",
    "pairs": "SELECT a.skill_abr AS item_a, b.skill_abr AS item_b, CAST(coalesce(met.n, 0) AS BIGINT) AS n FROM top15 a JOIN top15 b "
    "ON a.skill_abr <> b.skill_abr LEFT JOIN met ON met.item_a = a.skill_abr AND met.item_b = b.skill_abr",
}


@query("jn_company", "SELECT job_id, p.company_id, name, company_size, state, country FROM postings p LEFT JOIN companies c ON p.company_id = c.company_id")
def _(t):
    attributes = ["name", "company_size", "state", "country"]
    joined = joins.with_dimension(t.postings, t.companies, "company_id", attributes)
    return joined.select("job_id", "company_id", *attributes)


@query("jn_salary", f"""SELECT p.job_id, normalized_salary, {rnd("salary_midpoint", 2)} AS salary_midpoint, pay_period FROM postings p
    LEFT JOIN (SELECT * FROM (SELECT *, (coalesce(min_salary, max_salary) + coalesce(max_salary, min_salary)) / 2 AS salary_midpoint
    FROM salary_lines) WHERE salary_midpoint BETWEEN 10000 AND 500000) s ON p.job_id = s.job_id""")
def _(t):
    joined = joins.with_details(t.postings, clean_salaries(t.salary_lines), "job_id", ["salary_midpoint", "pay_period"])
    return joined.select("job_id", "normalized_salary", rounded("salary_midpoint", 2).alias("salary_midpoint"), "pay_period")


@query("jn_count", """SELECT p.job_id, CAST(coalesce(n, 0) AS INTEGER) AS skill_count FROM postings p
    LEFT JOIN skill_counts k ON p.job_id = k.job_id""")
def _(t):
    return joins.with_counts(t.postings.select("job_id"), t.bridge, "job_id", "skill_count")


@query("jn_topk_semi", """SELECT job_id, skill_abr FROM bridge WHERE skill_abr IN
    (SELECT skill_abr FROM bridge GROUP BY 1 ORDER BY COUNT(*) DESC, skill_abr LIMIT 5)""")
def _(t):
    return joins.keep_top_items(t.bridge, "skill_abr", 5).select("job_id", "skill_abr")


@query("jn_key_check", """SELECT 'bridge in fact' AS kind, COUNT(*) AS n_keys, COUNT(*) FILTER (WHERE o_orderkey IS NULL) AS n_missing,
    COUNT(*) FILTER (WHERE o_orderkey IS NULL) = 0 AS contained FROM (SELECT DISTINCT job_id FROM bridge)
    LEFT JOIN orders ON job_id = o_orderkey
    UNION ALL SELECT 'fact in bridge', COUNT(*), COUNT(*) FILTER (WHERE b.job_id IS NULL), COUNT(*) FILTER (WHERE b.job_id IS NULL) = 0
    FROM orders LEFT JOIN (SELECT DISTINCT job_id FROM bridge) b ON b.job_id = o_orderkey""")
def _(t):
    there = joins.missing_keys(t.bridge, t.postings, "job_id").withColumn("kind", F.lit("bridge in fact"))
    back = joins.missing_keys(t.postings, t.bridge, "job_id").withColumn("kind", F.lit("fact in bridge"))
    return there.unionByName(back)


@query("jn_lookup", """SELECT b.job_id, f.experience_encoded, f.is_remote FROM (SELECT DISTINCT job_id FROM bridge) b
    JOIN encoded f ON b.job_id = f.job_id""")
def _(t):
    keys = t.bridge.select("job_id").distinct()
    return joins.lookup_rows(keys, t.prepared, "job_id", ["experience_encoded", "is_remote"])


@query("jn_cooccur", "SELECT item_a, item_b, n FROM pairs", TOP15)
def _(t):
    return joins.cooccurrence(t.bridge, "job_id", "skill_abr", 15)


_FACT = f"""SELECT job_id, company_id, work_type, listed_month, is_remote, name, company_size, state, country,
    {rnd("salary_midpoint", 2)} AS salary_midpoint, pay_period, skill_count, apply_rate FROM fact"""


def _fact_columns(fact):
    return fact.withColumn("salary_midpoint", rounded("salary_midpoint", 2)).select(
        "job_id", "company_id", "work_type", "listed_month", "is_remote", "name", "company_size", "state", "country",
        "salary_midpoint", "pay_period", "skill_count", "apply_rate",
    )


@query("etl_fact", _FACT)
def _(t):
    """The whole warehouse plan in one query, computed from the raw tables."""
    return _fact_columns(build_fact(t.sources))


@query("etl_fact_bucketed", _FACT)
def _(t):
    """The same from source tables that were saved in buckets of a job; its joins by the job do not shuffle."""
    database = f"starloom_{uuid.uuid4().hex}"
    t.spark.sql(f"CREATE DATABASE {database}")
    return _fact_columns(build_fact(bucketed_sources(t.sources, database, 16), bucketed=True))
