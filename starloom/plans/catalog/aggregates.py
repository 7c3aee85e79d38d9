"""Counts, summaries, profiles and chart statistics."""

from pyspark.sql import functions as F

from starloom.functions.numeric import rounded
from starloom.operators import aggregate, ordered, profile, statistics
from starloom.plans.bindings import rnd
from starloom.plans.catalog.registry import query

EXPERIENCE_ORDER = ["Entry level", "Associate", "Mid-Senior level", "Director", "Executive"]
CORRELATED = [
    "salary_clean", "skill_count", "applies", "views", "apply_rate", "is_remote", "experience_encoded",
    "company_size_encoded", "is_senior_title",
]


def _round(df, digits, *columns):
    return df.withColumns({c: rounded(c, digits) for c in columns})


@query("agg_count", "SELECT job_id, COUNT(*) AS n FROM bridge GROUP BY 1")
def _(t):
    return aggregate.group_counts(t.bridge, "job_id")


@query("agg_value_counts", """SELECT formatted_experience_level, COUNT(*) AS n FROM postings
    WHERE formatted_experience_level IS NOT NULL GROUP BY 1""")
def _(t):
    return aggregate.value_counts(t.postings, "formatted_experience_level")


@query("agg_value_share", f"SELECT skill_count, COUNT(*) AS n, {rnd('COUNT(*) / (SELECT COUNT(*)::DOUBLE FROM fact)', 6)} AS share FROM fact GROUP BY 1")
def _(t):
    return _round(aggregate.value_shares(t.fact, "skill_count"), 6, "share")


@query("agg_collect", "SELECT job_id, string_agg(skill_abr, ',' ORDER BY skill_abr) AS items FROM bridge GROUP BY 1")
def _(t):
    lists = aggregate.item_lists(t.bridge, "job_id", "skill_abr")
    return lists.withColumn("items", F.array_join("items", ","))


@query("agg_quantile", f"""SELECT COUNT(salary_clean) AS n, {rnd("quantile_cont(salary_clean, 0.25)", 4)} AS p25,
    {rnd("quantile_cont(salary_clean, 0.5)", 4)} AS p50, {rnd("quantile_cont(salary_clean, 0.75)", 4)} AS p75,
    {rnd("quantile_cont(salary_clean, 0.99)", 4)} AS p99 FROM encoded""")
def _(t):
    probs = {"p25": 0.25, "p50": 0.5, "p75": 0.75, "p99": 0.99}
    return _round(ordered.exact_quantiles(t.prepared, "salary_clean", probs), 4, *probs)


@query("agg_summary", f"""SELECT COUNT(normalized_salary) AS n, {rnd("avg(normalized_salary)", 4)} AS mean,
    {rnd("median(normalized_salary)", 4)} AS median, min(normalized_salary) AS min, max(normalized_salary) AS max FROM postings""")
def _(t):
    return _round(aggregate.summary(t.postings, "normalized_salary"), 4, "mean", "median")


@query("agg_nunique", "SELECT COUNT(DISTINCT state) AS n_states, COUNT(DISTINCT title) AS n_titles FROM encoded")
def _(t):
    return t.prepared.agg(F.countDistinct("state").alias("n_states"), F.countDistinct("title").alias("n_titles"))


@query("agg_cond", f"""SELECT condition, n, {rnd("n / (SELECT COUNT(*)::DOUBLE FROM prepared)", 6)} AS share FROM (
    SELECT 'known_state' AS condition, COUNT(*) AS n FROM prepared WHERE state <> 'Unknown'
    UNION ALL SELECT 'known_salary', COUNT(salary_clean) FROM prepared
    UNION ALL SELECT 'known_demand', COUNT(high_demand) FROM prepared
    UNION ALL SELECT 'high_demand', COUNT(*) FROM prepared WHERE high_demand = 1)""")
def _(t):
    conditions = {
        "known_state": F.col("state") != "Unknown",
        "known_salary": F.col("salary_clean").isNotNull(),
        "known_demand": F.col("high_demand").isNotNull(),
        "high_demand": F.col("high_demand") == 1,
    }
    return _round(aggregate.conditional_counts(t.prepared, conditions), 6, "share")


@query("agg_balance", f"""SELECT high_demand, COUNT(*) AS n, {rnd("COUNT(*) / (SELECT COUNT(high_demand)::DOUBLE FROM prepared)", 6)} AS share
    FROM prepared WHERE high_demand IS NOT NULL GROUP BY 1""")
def _(t):
    return _round(aggregate.class_balance(t.prepared, "high_demand"), 6, "share")


@query("agg_present", """SELECT CAST(list_position(['Entry level', 'Associate', 'Mid-Senior level', 'Director', 'Executive'],
    formatted_experience_level) AS INTEGER) AS place, formatted_experience_level FROM postings
    WHERE formatted_experience_level IN ('Entry level', 'Associate', 'Mid-Senior level', 'Director', 'Executive') GROUP BY ALL""")
def _(t):
    return aggregate.present_in_order(t.postings, "formatted_experience_level", EXPERIENCE_ORDER)


def _profile_sql(table, columns):
    total = f"(SELECT COUNT(*) FROM {table})"
    percent = rnd(f"COUNT(*) FILTER (WHERE {{c}} IS NULL) / CAST({total} AS DOUBLE) * 100", 1)
    return " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, COUNT(*) AS n_rows, {len(columns)} AS n_columns, '{c}' AS column_name, "
        f"{percent.format(c=c)} AS null_pct, {percent.format(c=c)} > 10 AS high_null FROM {table}"
        for c in columns
    )


_POSTING_COLUMNS = [
    "job_id", "company_id", "title", "work_type", "remote_allowed", "formatted_experience_level",
    "original_listed_time", "normalized_salary", "views", "applies",
]
_SALARY_COLUMNS = ["job_id", "min_salary", "max_salary", "pay_period", "currency"]


_PROFILED = {
    "postings": _POSTING_COLUMNS,
    "companies": ["company_id", "name", "company_size", "state", "country"],
    "bridge": ["job_id", "skill_abr"],
    "salaries": _SALARY_COLUMNS,
    "benefits": ["job_id", "type", "inferred"],
}


@query("prf_table", " UNION ALL ".join(_profile_sql(table, columns) for table, columns in _PROFILED.items()))
def _(t):
    return profile.profile({table: getattr(t, table) for table in _PROFILED})


_NULLS = " + ".join(f"COUNT(*) FILTER (WHERE {c} IS NULL)" for c in _POSTING_COLUMNS)


@query("prf_overview", f"""SELECT COUNT(*) AS n_rows, 10 AS n_columns, 7 AS n_numeric, 3 AS n_other, CAST({_NULLS} AS BIGINT) AS nulls,
    {rnd(f"({_NULLS}) / (COUNT(*) * 10)::DOUBLE * 100", 1)} AS null_pct FROM postings""")
def _(t):
    return profile.overview(t.postings)


@query("prf_missing", "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, COUNT(*) FILTER (WHERE {c} IS NULL) AS nulls, "
    + rnd(f"COUNT(*) FILTER (WHERE {c} IS NULL) / COUNT(*)::DOUBLE * 100", 1) + " AS null_pct FROM postings"
    for c in _POSTING_COLUMNS) + ") WHERE nulls > 0")
def _(t):
    return profile.missing_columns(t.postings)


_BOX = """SELECT formatted_experience_level AS level, COUNT(*) AS n, quantile_cont(salary_clean, 0.25) AS q1,
    quantile_cont(salary_clean, 0.5) AS median, quantile_cont(salary_clean, 0.75) AS q3 FROM encoded
    WHERE salary_clean IS NOT NULL AND formatted_experience_level IN
    ('Entry level', 'Associate', 'Mid-Senior level', 'Director', 'Executive') GROUP BY 1"""


@query("sta_box", f"""SELECT formatted_experience_level, n, {rnd("q1", 4)} AS q1, {rnd("median", 4)} AS median, {rnd("q3", 4)} AS q3,
    min(salary_clean) FILTER (WHERE salary_clean BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS whisker_low,
    max(salary_clean) FILTER (WHERE salary_clean BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS whisker_high,
    COUNT(*) FILTER (WHERE salary_clean NOT BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS n_outliers
    FROM encoded JOIN boxes ON formatted_experience_level = level WHERE salary_clean IS NOT NULL GROUP BY ALL""",
    {"boxes": _BOX})
def _(t):
    stats = statistics.box_stats(t.prepared, "formatted_experience_level", "salary_clean", EXPERIENCE_ORDER)
    return _round(stats, 4, "q1", "median", "q3")


def histogram_sql(source: str, value: str, bins: int) -> str:
    return f"""SELECT CAST(bin AS BIGINT) AS bin, {rnd(f"lo + bin * ((hi - lo) / {bins})", 4)} AS low,
    {rnd(f"lo + (bin + 1) * ((hi - lo) / {bins})", 4)} AS high, CAST(coalesce(n, 0) AS BIGINT) AS n
    FROM range({bins}) g(bin) CROSS JOIN (SELECT min({value}) AS lo, max({value}) AS hi FROM {source}) r
    LEFT JOIN (SELECT least(CAST(floor(({value} - lo) / ((hi - lo) / {bins})) AS BIGINT), {bins - 1}) AS b, COUNT(*) AS n FROM {source}
    CROSS JOIN (SELECT min({value}) AS lo, max({value}) AS hi FROM {source}) WHERE {value} IS NOT NULL GROUP BY 1) c ON c.b = bin"""


@query("sta_hist", histogram_sql("capped", "salary_clean", 50), {
    "capped": "SELECT salary_clean FROM encoded WHERE salary_clean <= (SELECT quantile_cont(salary_clean, 0.99) FROM encoded)"})
def _(t):
    from starloom.operators.filters import up_to_quantile

    capped = up_to_quantile(t.prepared, "salary_clean", 0.99)
    return _round(statistics.histogram(capped, "salary_clean", 50), 4, "low", "high")


@query("sta_corr", " UNION ALL ".join(
    f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, "
    + rnd(f"CASE WHEN isnan(corr({a}, {b})) THEN NULL ELSE corr({a}, {b}) END", 2) + " AS r FROM prepared"
    for i, a in enumerate(CORRELATED) for b in CORRELATED[:i]))
def _(t):
    return statistics.correlations(t.prepared, CORRELATED)


@query("sta_disclosure", f"""SELECT COUNT(salary_clean) AS n_known, COUNT(*) AS n_rows,
    {rnd("COUNT(salary_clean) / COUNT(*)::DOUBLE", 6)} AS share FROM encoded""")
def _(t):
    return _round(statistics.disclosure(t.prepared, "salary_clean"), 6, "share")


@query("win_ecdf", f"""SELECT salary_clean, {rnd("SUM(COUNT(*)) OVER (ORDER BY salary_clean) / (SELECT COUNT(salary_clean) FROM encoded)::DOUBLE", 9)} AS cdf
    FROM encoded WHERE salary_clean IS NOT NULL GROUP BY 1""")
def _(t):
    return _round(statistics.ecdf(t.prepared, "salary_clean"), 9, "cdf")


@query("win_ecdf_marks", f"""SELECT {rnd("quantile_cont(salary_clean, 0.25)", 4)} AS p25,
    {rnd("quantile_cont(salary_clean, 0.5)", 4)} AS p50, {rnd("quantile_cont(salary_clean, 0.75)", 4)} AS p75,
    COUNT(salary_clean) AS n FROM encoded""")
def _(t):
    marks = ordered.exact_quantiles(t.prepared, "salary_clean", {"p25": 0.25, "p50": 0.5, "p75": 0.75})
    return _round(marks, 4, "p25", "p50", "p75")
