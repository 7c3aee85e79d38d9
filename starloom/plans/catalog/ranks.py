"""Sorts, top-k, windows in disguise, samples, splits and set operations."""

from pyspark.sql import functions as F

from starloom.functions.encode import label
from starloom.functions.encode import CATEGORY_LABELS
from starloom.functions.numeric import rounded
from starloom.mining.scores import classifier_comparison, regression_metrics
from starloom.operators import aggregate, filters, ranking, sampling, sets, statistics
from starloom.plans.bindings import _case, hashed, rnd
from starloom.plans.catalog.registry import query


def _round(df, digits, *columns):
    return df.withColumns({c: rounded(c, digits) for c in columns})


@query("win_roc", f"""SELECT model, threshold, {rnd("fpr", 8)} AS fpr, {rnd("tpr", 8)} AS tpr FROM (
    SELECT model, score AS threshold, SUM(neg) OVER w / SUM(neg) OVER (PARTITION BY model)::DOUBLE AS fpr,
    SUM(pos) OVER w / SUM(pos) OVER (PARTITION BY model)::DOUBLE AS tpr
    FROM (SELECT model, score, COUNT(*) FILTER (WHERE actual = 1) AS pos, COUNT(*) FILTER (WHERE actual = 0) AS neg
    FROM scored GROUP BY 1, 2) WINDOW w AS (PARTITION BY model ORDER BY score DESC)
    UNION ALL SELECT DISTINCT model, CAST(NULL AS DOUBLE), 0.0::DOUBLE, 0.0::DOUBLE FROM scored)""")
def _(t):
    return _round(statistics.roc_points(t.scored, "actual", "score", "model"), 8, "fpr", "tpr")


@query("win_topn", f"""SELECT formatted_experience_level, title_clean, state, n, place FROM (
    SELECT formatted_experience_level, title_clean, state, n, CAST(row_number() OVER (PARTITION BY formatted_experience_level
    ORDER BY n DESC, title_clean, state) AS INTEGER) AS place FROM (SELECT formatted_experience_level,
    coalesce(title_clean, '') AS title_clean, state, COUNT(*) AS n FROM encoded GROUP BY ALL)) WHERE place <= 5""")
def _(t):
    rows = t.prepared.withColumn("title_clean", F.coalesce("title_clean", F.lit("")))
    counts = rows.groupBy("formatted_experience_level", "title_clean", "state").agg(F.count(F.lit(1)).alias("n"))
    order = [F.desc("n"), F.asc("title_clean"), F.asc("state")]
    return ranking.top_per_group(counts, "formatted_experience_level", order, 5)


@query("win_share", f"SELECT skill_abr, n, {rnd('n / SUM(n) OVER ()::DOUBLE', 8)} AS share FROM (SELECT skill_abr, COUNT(*) AS n FROM bridge GROUP BY 1)")
def _(t):
    return _round(ranking.share_of_selection(aggregate.group_counts(t.bridge, "skill_abr"), "n"), 8, "share")


@query("srt_metric", f"""SELECT formatted_experience_level, {rnd("avg(normalized_salary)", 4)} AS mean_salary FROM postings
    GROUP BY 1 ORDER BY 2 DESC""")
def _(t):
    means = t.postings.groupBy("formatted_experience_level").agg(rounded(F.avg("normalized_salary"), 4).alias("mean_salary"))
    return means.orderBy(F.desc("mean_salary"), "formatted_experience_level")


@query("srt_titles", "SELECT title, COUNT(*) AS n FROM titles GROUP BY 1 ORDER BY n DESC, title LIMIT 15")
def _(t):
    return aggregate.top_values(t.titles, "title", 15)


@query("srt_categories", f"""SELECT skill_abr, {_case("skill_abr", CATEGORY_LABELS, "skill_abr")} AS label, n FROM
    (SELECT skill_abr, COUNT(*) AS n FROM bridge GROUP BY 1 ORDER BY n DESC, skill_abr LIMIT 15)""")
def _(t):
    return aggregate.top_values(t.bridge, "skill_abr", 15).select("skill_abr", label("skill_abr").alias("label"), "n")


@query("srt_states", "SELECT state, COUNT(*) AS n FROM encoded WHERE state <> 'Unknown' GROUP BY 1 ORDER BY n DESC, state LIMIT 15")
def _(t):
    return aggregate.top_values(filters.other_than(t.prepared, "state", "Unknown"), "state", 15)


@query("srt_remote", """SELECT CASE WHEN is_remote = 1 THEN 'Remote' ELSE 'On-site / Hybrid' END AS kind, COUNT(*) AS n
    FROM fact GROUP BY 1""")
def _(t):
    return statistics.relabelled_counts(t.fact, "is_remote", {0: "On-site / Hybrid", 1: "Remote"})


_R2 = "1 - avg((actual - predicted) * (actual - predicted)) / var_pop(actual)"
_RMSE = "sqrt(avg((actual - predicted) * (actual - predicted)))"


@query("srt_argmax", f"SELECT model, {rnd('r2', 6)} AS r2 FROM (SELECT model, {_R2} AS r2 FROM priced GROUP BY 1 ORDER BY r2 DESC, model LIMIT 1)")
def _(t):
    metrics = regression_metrics(t.priced, "actual", "predicted", by=["model"])
    return _round(ranking.best_by(metrics, "model", "r2"), 6, "r2")


@query("smp_n", f"SELECT job_id, normalized_salary FROM {hashed('postings', 'job_id')} ORDER BY _h, job_id LIMIT 3000")
def _(t):
    return sampling.sample_rows(t.postings, "job_id", 3000).select("job_id", "normalized_salary")


@query("smp_split", f"SELECT job_id, CAST(_h < 858993459 AS INTEGER) AS is_test FROM {hashed('postings', 'job_id')}")
def _(t):
    return sampling.split_rows(t.postings, "job_id").select("job_id", "is_test")


@query("smp_strat", f"""SELECT job_id, high_demand, CAST(row_number() OVER (PARTITION BY high_demand ORDER BY _h, job_id)
    <= ceil(0.2::DOUBLE * COUNT(*) OVER (PARTITION BY high_demand)) AS INTEGER) AS is_test
    FROM {hashed("(SELECT job_id, high_demand FROM prepared WHERE high_demand IS NOT NULL)", "job_id")}""")
def _(t):
    known = t.prepared.where(F.col("high_demand").isNotNull()).select("job_id", "high_demand")
    return sampling.stratified_split(known, "job_id", "high_demand", classes=(0.0, 1.0))


@query("smp_scatter", f"""SELECT job_id, salary_clean, applies, is_remote FROM
    {hashed("(SELECT * FROM encoded WHERE salary_clean IS NOT NULL AND applies > 0)", "job_id")} ORDER BY _h, job_id LIMIT 3000""")
def _(t):
    known = filters.known_and_positive(t.prepared, "salary_clean", "applies")
    return sampling.sample_rows(known.select("job_id", "salary_clean", "applies", "is_remote"), "job_id", 3000)


_F1 = " + ".join(
    f"coalesce(2.0::DOUBLE * COUNT(*) FILTER (WHERE actual = {c} AND predicted = {c}) / nullif(COUNT(*) FILTER (WHERE actual = {c}) "
    f"+ COUNT(*) FILTER (WHERE predicted = {c}), 0), 0) * COUNT(*) FILTER (WHERE actual = {c})" for c in (0, 1))
COMPARISON_CTES = {
    "areas": """SELECT model, SUM(pos * (below + neg / 2.0::DOUBLE)) / (SUM(pos) * SUM(neg))::DOUBLE AS auc FROM (
        SELECT model, score, pos, neg, coalesce(SUM(neg) OVER (PARTITION BY model ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING
        AND 1 PRECEDING), 0) AS below FROM (SELECT model, score, COUNT(*) FILTER (WHERE actual = 1) AS pos,
        COUNT(*) FILTER (WHERE actual = 0) AS neg FROM scored GROUP BY 1, 2)) GROUP BY 1""",
    "basics": f"SELECT model, avg(CAST(actual = predicted AS DOUBLE)) AS accuracy, ({_F1}) / COUNT(*) AS f1 FROM scored GROUP BY 1",
    "compared": "SELECT model, accuracy, f1, auc FROM basics JOIN areas USING (model)",
}


def scorecard_part(t):
    models = classifier_comparison(t.scored, "model", "actual", "predicted", "score")
    values = regression_metrics(t.priced, "actual", "predicted", by=["model"])
    return models, values


@query("set_scorecard_sql", f"""SELECT 'classification' AS task, metric, {rnd("value", 6)} AS value FROM (
    SELECT 'accuracy' AS metric, max(accuracy) AS value FROM compared UNION ALL SELECT 'f1', max(f1) FROM compared
    UNION ALL SELECT 'roc_auc', max(auc) FROM compared)
    UNION ALL SELECT 'regression', metric, {rnd("value", 6)} FROM (
    SELECT 'rmse' AS metric, {_RMSE} AS value FROM priced WHERE model = 'gross'
    UNION ALL SELECT 'mae', avg(abs(actual - predicted)) FROM priced WHERE model = 'gross')""", COMPARISON_CTES)
def _(t):
    models, values = scorecard_part(t)
    best = models.agg(F.max("accuracy").alias("accuracy"), F.max("f1").alias("f1"), F.max("auc").alias("roc_auc"))
    gross = values.where(F.col("model") == "gross")
    parts = [
        sets.long_metrics(best, "classification", ["accuracy", "f1", "roc_auc"]),
        sets.long_metrics(gross, "regression", ["rmse", "mae"]),
    ]
    return _round(sets.stack(parts), 6, "value")


@query("set_baseline", f"""SELECT model, {rnd("rmse", 4)} AS rmse, {rnd("r2", 6)} AS r2 FROM (
    SELECT 'Naive (always predict mean)' AS model, stddev_pop(actual) AS rmse, 0.0::DOUBLE AS r2 FROM priced WHERE model = 'gross'
    UNION ALL SELECT model, {_RMSE}, {_R2} FROM priced GROUP BY 1)""")
def _(t):
    metrics = regression_metrics(t.priced, "actual", "predicted", by=["model"]).select("model", "rmse", "r2")
    rows = t.priced.where(F.col("model") == "gross")
    table = sets.with_naive_baseline(metrics, rows, "actual", "Naive (always predict mean)")
    return table.select("model", rounded("rmse", 4).alias("rmse"), rounded("r2", 6).alias("r2"))
