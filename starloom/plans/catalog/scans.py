"""Sources, sinks and persistence; each query writes Spark data to the shared folder and reads it back."""

import uuid
from functools import partial

from pyspark.sql import functions as F

from starloom.functions.numeric import rounded
from starloom.mining import bundle
from starloom.mining.rules import association_rules, baskets, frequent_itemsets
from starloom.mining.scorecard import scorecard
from starloom.operators.sets import stack
from starloom.plans.bindings import rnd
from starloom.plans.catalog import classification, clustering, regression
from starloom.plans.catalog import rules as rule_queries
from starloom.plans.catalog.registry import query
from starloom.plans.warehouse import build_star
from starloom.session import in_threads, scratch
from starloom.sources import readers, sinks


def _folder(t):
    return scratch(t.spark)


_TABLES = ["customer", "documents", "embeddings", "events", "labels", "lineitem", "nation", "orders", "pages", "part"]


@query("src_csv_roundtrip", """SELECT job_id, title, work_type, formatted_experience_level, applies, views, original_listed_time,
    normalized_salary FROM postings""")
def _(t):
    folder = _folder(t)
    sinks.write_csv(t.postings, f"{folder}/postings.csv")
    tables = readers.read_tables(t.spark, folder)
    return tables["job_postings"].select(
        "job_id", "title", "work_type", "formatted_experience_level", "applies", "views", "original_listed_time",
        "normalized_salary",
    )


@query("src_fallback", "SELECT job_id, applies, views FROM postings")
def _(t):
    name = f"merged_{uuid.uuid4().hex}"
    t.postings.createOrReplaceTempView(name)
    return readers.first_available(t.spark, [f"{name}_preprocessed", name]).select("job_id", "applies", "views")


@query("snk_star_readback", """SELECT 'fact_job_postings' AS name, COUNT(*) AS n, COUNT(DISTINCT job_id) AS n_keys FROM fact
    UNION ALL SELECT 'dim_companies', COUNT(*), COUNT(DISTINCT company_id) FROM companies
    UNION ALL SELECT 'dim_salaries', COUNT(*), COUNT(DISTINCT job_id) FROM salaries_clean
    UNION ALL SELECT 'bridge_job_skills', COUNT(*), COUNT(DISTINCT job_id) FROM bridge
    UNION ALL SELECT 'dim_benefits', COUNT(*), COUNT(DISTINCT job_id) FROM benefits""")
def _(t):
    folder = _folder(t)
    sinks.write_star(build_star(t.sources), folder, {"fact_job_postings": ["listed_month"]})
    stored = sinks.read_star(t.spark, folder)
    parts = [
        df.agg(
            F.lit(name).alias("name"),
            F.count(F.lit(1)).alias("n"),
            F.countDistinct("company_id" if name == "dim_companies" else "job_id").alias("n_keys"),
        )
        for name, df in stored.items()
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


@query("snk_star_versions", """SELECT v AS version, 'fact_job_postings' AS name, COUNT(*) AS n FROM fact, (VALUES (1::BIGINT), (2)) w(v) WHERE v = 2 OR job_id % 2 = 0 GROUP BY ALL
    UNION ALL SELECT v, 'dim_companies', COUNT(*) FROM companies, (VALUES (1::BIGINT), (2)) w(v) GROUP BY ALL
    UNION ALL SELECT v, 'bridge_job_skills', COUNT(*) FROM bridge, (VALUES (1::BIGINT), (2)) w(v) WHERE v = 2 OR job_id % 2 = 0 GROUP BY ALL""")
def _(t):
    """Two versions of the warehouse published one after the other, each read as a whole."""
    root = _folder(t)
    full = {"fact_job_postings": t.fact, "dim_companies": t.companies, "bridge_job_skills": t.bridge}
    half = {name: df.where("job_id % 2 = 0") if "job_id" in df.columns else df for name, df in full.items()}
    numbers = [sinks.publish_star(tables, root, {"fact_job_postings": ["listed_month"]}) for tables in (half, full)]
    parts = [
        df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(v).cast("bigint").alias("version"), F.lit(name).alias("name"), "n")
        for v in numbers for name, df in sinks.published_star(t.spark, root, v).items()
    ]
    return stack(parts)


@query("snk_csv_roundtrip", "SELECT job_id, skill_abr FROM bridge")
def _(t):
    folder = _folder(t)
    sinks.write_csv(t.bridge, f"{folder}/jobs/job_skills.csv")
    return readers.read_tables(t.spark, folder)["job_skills"]


@query("snk_rules_text", f"""SELECT replace(a, ',', ', ') AS antecedents, replace(c, ',', ', ') AS consequents,
    {rnd("support", 8)} AS support, {rnd("confidence", 8)} AS confidence, {rnd("lift", 8)} AS lift FROM rule_set""", rule_queries._LEVELS)
def _(t):
    path = f"{_folder(t)}/association_rules"
    found = association_rules(frequent_itemsets(baskets(t.small_bridge, "job_id", "skill_abr")), 0.1)
    sinks.write_rules(found.select("antecedents", "consequents", "support", "confidence", "lift"), path)
    schema = "antecedents string, consequents string, support double, confidence double, lift double"
    rows = t.spark.read.schema(schema).option("header", True).option("escape", '"').csv(path)
    return rows.withColumns({c: rounded(c, 8) for c in ("support", "confidence", "lift")})


@query("snk_model_reload", f"SELECT job_id, {rnd('predicted * (high - low) + low', 4)} AS predicted FROM ridge_predictions", regression.RIDGE)
def _(t):
    """Predictions of a reloaded bundle in units of the target; nothing of the session that fitted it is used."""
    task, models = regression.fitted(t, ["Ridge Regression"])
    path = _folder(t)
    bundle.save(path, models["Ridge Regression"], bundle.about_task(task, "Ridge Regression"), t.spark)
    kept = bundle.load(path, t.spark)
    return kept.predict(kept.test_rows(t.prepared)).select("job_id", rounded("predicted", 4).alias("predicted"))


@query("set_scorecard")
def _(t):
    """Headline metrics of the four tasks from their stored results: the best classifier and regressor after reloading,
    the chosen number of clusters, all rules. The tasks share the prepared table only and run side by side."""
    tasks = {
        "regression": regression.task_metrics,
        "classification": classification.task_metrics,
        "clustering": clustering.task_metrics,
        "association_rules": rule_queries.task_metrics,
    }
    t.prepared  # noqa: B018 - stored before the tasks, which would each build it
    return scorecard(dict(zip(tasks, in_threads([partial(task, t) for task in tasks.values()], t.spark), strict=True)))
