"""Derived targets, scaling and model features."""

from pyspark.sql import functions as F

from starloom.functions.numeric import rounded
from starloom.mining.features import CLASSIFICATION_FEATURES, REGRESSION_FEATURES, classification_frame, regression_frame
from starloom.operators import scaling
from starloom.plans.bindings import rnd
from starloom.plans.catalog.registry import query
from starloom.plans.preprocess import SCALED_COLUMNS


@query("tgt_high_salary", "SELECT job_id, high_salary FROM prepared")
def _(t):
    return scaling.top_share_flag(t.prepared.drop("high_salary"), "salary_clean", "high_salary").select("job_id", "high_salary")


@query("tgt_high_demand", "SELECT job_id, high_demand FROM prepared")
def _(t):
    return scaling.demand_flag(t.prepared.drop("high_demand"), "applies", "high_demand").select("job_id", "high_demand")


@query("scl_standard", "SELECT job_id, " + ", ".join(
    rnd(f"(coalesce({c}, 0) - (SELECT avg(coalesce({c}, 0)) FROM encoded)) / (SELECT stddev_pop(coalesce({c}, 0)) FROM encoded)", 6)
    + f" AS {c}_scaled" for c in SCALED_COLUMNS) + " FROM encoded")
def _(t):
    base = t.prepared.select("job_id", *SCALED_COLUMNS)
    scaled = scaling.z_scores(base, SCALED_COLUMNS)
    return scaled.select("job_id", *[rounded(f"{c}_scaled", 6).alias(f"{c}_scaled") for c in SCALED_COLUMNS])


_HALF = ["experience_encoded", "company_size_encoded", "is_remote"]


@query("scl_minmax_half", "SELECT job_id, " + ", ".join(
    rnd(f"({c} - (SELECT min({c}) FROM encoded)) / (SELECT max({c}) - min({c}) FROM encoded)::DOUBLE * 0.5", 6)
    + f" AS {c}" for c in _HALF) + " FROM encoded")
def _(t):
    scaled = scaling.unit_range(t.prepared.select("job_id", *_HALF), _HALF, 0.5)
    return scaled.select("job_id", *[rounded(c, 6).alias(c) for c in _HALF])


@query("scl_target_inverse", f"""SELECT job_id, {rnd("(salary_clean - lo) / (hi - lo)", 8)} AS target_scaled, salary_clean AS restored
    FROM encoded, (SELECT min(salary_clean) AS lo, max(salary_clean) AS hi FROM encoded) WHERE salary_clean IS NOT NULL""")
def _(t):
    known = t.prepared.where(F.col("salary_clean").isNotNull()).select("job_id", "salary_clean")
    scaled = scaling.with_scaled_target(known, "salary_clean")
    restored = rounded(scaling.unscaled("target_scaled"), 2)
    return scaled.select("job_id", rounded("target_scaled", 8).alias("target_scaled"), restored.alias("restored"))


def features_sql(names, target, cast):
    columns = ", ".join(f"CAST(coalesce({c}, 0) AS DOUBLE) AS {c}" for c in names)
    work = ", ".join(f'CAST("{w}" AS DOUBLE) AS "{w}"' for w in ("work_FULL_TIME", "work_PART_TIME"))
    return f"SELECT job_id, {columns}, {work}, CAST({target} AS {cast}) AS {target} FROM prepared WHERE {target} IS NOT NULL"


@query("fea_clf", features_sql(CLASSIFICATION_FEATURES, "high_demand", "INTEGER"))
def _(t):
    return classification_frame(t.prepared)


@query("fea_reg", features_sql(REGRESSION_FEATURES, "salary_clean", "DOUBLE"))
def _(t):
    return regression_frame(t.prepared)
