"""Projections, filters, null handling, numbers and dates."""

from pyspark.sql import functions as F

from starloom.functions import numeric as N
from starloom.operators import filters, profile, project
from starloom.plans.bindings import rnd
from starloom.plans.catalog.registry import query
from starloom.plans.preprocess import SALARY_CLEAN_RANGE, TEXT_COLUMNS, ZERO_COLUMNS
from starloom.plans.warehouse import SALARY_RANGE


@query("prj_std_names", "SELECT o_orderkey AS order_key, o_custkey AS cust_key, o_totalprice AS total_price FROM orders")
def _(t):
    raw = t.orders.select(
        F.col("o_orderkey").alias(" Order Key"), F.col("o_custkey").alias("CUST Key "), F.col("o_totalprice").alias("Total Price")
    )
    return project.standard_names(raw)


@query("prj_prune", "SELECT job_id, name, company_size, state FROM postings p LEFT JOIN companies c ON p.company_id = c.company_id")
def _(t):
    wanted = t.companies.select("company_id", "name", "company_size", "state")
    return t.postings.join(wanted, "company_id", "left").select("job_id", "name", "company_size", "state")


@query("prj_present", "SELECT job_id, views, applies FROM postings")
def _(t):
    return project.keep_present(t.postings, ["job_id", "no_such_column", "views", "applies", "salary_clean"])


@query("prj_prefix", 'SELECT job_id, "work_FULL_TIME", "work_PART_TIME" FROM prepared')
def _(t):
    return t.prepared.select("job_id", *project.prefixed_columns(t.prepared, "work_"))


_KINDS = {"o_orderkey": "numeric", "o_custkey": "numeric", "o_orderstatus": "other", "o_totalprice": "numeric", "o_orderdate": "other", "o_orderpriority": "other"}


@query("prj_types", " UNION ALL ".join(f"SELECT '{c}' AS column_name, '{kind}' AS kind, COUNT({c}) AS cells FROM orders" for c, kind in _KINDS.items()))
def _(t):
    numeric, other = project.split_by_type(t.orders)
    kinds = [(c, kind) for names, kind in ((numeric, "numeric"), (other, "other")) for c in names]
    counts = t.orders.agg(*[F.count(c).alias(c) for c, _ in kinds])
    rows = F.explode(F.array([F.struct(F.lit(c).alias("column_name"), F.lit(kind).alias("kind"), F.col(c).alias("cells")) for c, kind in kinds]))
    return counts.select(rows.alias("r")).select("r.*")


@query("prj_positional", "SELECT l_orderkey AS key_value, skill_abr AS item_value FROM (SELECT job_id AS l_orderkey, skill_abr FROM bridge)")
def _(t):
    odd = t.bridge.withColumnsRenamed({"job_id": "posting", "skill_abr": "category"})
    key, item = project.key_column(odd), project.item_column(odd)
    return odd.select(F.col(key).alias("key_value"), F.col(item).alias("item_value"))


@query("prj_withcols", "SELECT job_id, company_id, views * 2 AS double_views, applies IS NULL AS no_data FROM postings")
def _(t):
    added = {"double_views": F.col("views") * 2, "no_data": F.col("applies").isNull()}
    return project.add_columns(t.postings, added).select("job_id", "company_id", *added)


@query("flt_between", f"SELECT job_id, {rnd('salary_midpoint', 2)} AS salary_midpoint FROM salaries_clean")
def _(t):
    rows = t.salaries.withColumn("salary_midpoint", N.midpoint("min_salary", "max_salary"))
    kept = filters.in_range(rows, "salary_midpoint", *SALARY_RANGE)
    return kept.select("job_id", N.rounded("salary_midpoint", 2).alias("salary_midpoint"))


@query("flt_mask", """SELECT job_id, CASE WHEN normalized_salary BETWEEN 20000 AND 500000 THEN normalized_salary END AS salary_clean
    FROM postings""")
def _(t):
    return t.postings.select("job_id", N.within("normalized_salary", *SALARY_CLEAN_RANGE).alias("salary_clean"))


@query("flt_isin", """SELECT job_id, formatted_experience_level FROM postings
    WHERE formatted_experience_level IN ('Entry level', 'Director')""")
def _(t):
    kept = filters.among(t.postings, "formatted_experience_level", ["Entry level", "Director"])
    return kept.select("job_id", "formatted_experience_level")


@query("flt_conj", "SELECT job_id, salary_clean, applies FROM encoded WHERE salary_clean IS NOT NULL AND applies > 0")
def _(t):
    return filters.known_and_positive(t.prepared, "salary_clean", "applies").select("job_id", "salary_clean", "applies")


@query("flt_ne", "SELECT job_id, state FROM encoded WHERE state <> 'Unknown'")
def _(t):
    return filters.other_than(t.prepared, "state", "Unknown").select("job_id", "state")


@query("flt_dropna", """SELECT 'any' AS kind, COUNT(*) AS n FROM postings WHERE title IS NOT NULL AND views IS NOT NULL
    AND remote_allowed IS NOT NULL AND formatted_experience_level IS NOT NULL AND applies IS NOT NULL
    UNION ALL SELECT 'subset', COUNT(*) FROM postings WHERE views IS NOT NULL AND applies IS NOT NULL""")
def _(t):
    whole = t.postings.dropna().agg(F.lit("any").alias("kind"), F.count(F.lit(1)).alias("n"))
    subset = t.postings.dropna(subset=["views", "applies"]).agg(F.lit("subset").alias("kind"), F.count(F.lit(1)).alias("n"))
    return whole.unionByName(subset)


@query("flt_p99", """SELECT job_id, salary_clean FROM encoded
    WHERE salary_clean <= (SELECT quantile_cont(salary_clean, 0.99) FROM encoded)""")
def _(t):
    return filters.up_to_quantile(t.prepared, "salary_clean", 0.99).select("job_id", "salary_clean")


@query("flt_nonempty", """SELECT job_id, len(items) AS n_items FROM (SELECT job_id, list(skill_abr) FILTER
    (WHERE skill_abr IN ('IT', 'SALE', 'MGMT')) AS items FROM bridge GROUP BY 1) WHERE len(items) > 0""")
def _(t):
    from starloom.functions.arrays import keep_allowed
    from starloom.operators.aggregate import item_lists

    lists = item_lists(t.bridge, "job_id", "skill_abr")
    kept = lists.withColumn("items", keep_allowed("items", ["IT", "SALE", "MGMT"]))
    return filters.non_empty(kept, "items").select("job_id", F.size("items").cast("bigint").alias("n_items"))


@query("nul_fill_cat", """SELECT job_id, coalesce(work_type, 'Unknown') AS work_type,
    coalesce(formatted_experience_level, 'Unknown') AS formatted_experience_level,
    coalesce(company_size, 'Unknown') AS company_size, coalesce(pay_period, 'Unknown') AS pay_period FROM fact""")
def _(t):
    return profile.fill_text(t.fact, TEXT_COLUMNS).select("job_id", *TEXT_COLUMNS)


@query("nul_fill_num", """SELECT job_id, coalesce(applies, 0) AS applies, coalesce(views, 0) AS views, skill_count,
    coalesce(apply_rate, 0) AS apply_rate, normalized_salary FROM fact""")
def _(t):
    return profile.fill_zero(t.fact, ZERO_COLUMNS).select("job_id", *ZERO_COLUMNS, "normalized_salary")


@query("nul_totals", """SELECT 'before' AS step, CAST(SUM((applies IS NULL)::INT + (views IS NULL)::INT + (title IS NULL)::INT
    + (remote_allowed IS NULL)::INT + (formatted_experience_level IS NULL)::INT) AS BIGINT) AS nulls FROM postings
    UNION ALL SELECT 'after', CAST(SUM((title IS NULL)::INT + (remote_allowed IS NULL)::INT) AS BIGINT) FROM postings""")
def _(t):
    filled = {c: F.coalesce(c, F.lit(0.0)) for c in ("applies", "views")}
    filled["formatted_experience_level"] = F.coalesce("formatted_experience_level", F.lit("Unknown"))
    return profile.null_totals(t.postings, filled)


@query("num_coerce", """SELECT part_id, coalesce(TRY_CAST(raw AS DOUBLE), 0) AS number FROM (SELECT p_partkey AS part_id,
    CASE WHEN p_type = 'PROMO' THEN 'n/a' WHEN p_type = 'SMALL' THEN p_name ELSE CAST(p_size AS VARCHAR) END AS raw FROM part)""")
def _(t):
    raw = F.when(F.col("p_type") == "PROMO", "n/a").when(F.col("p_type") == "SMALL", F.col("p_name"))
    rows = t.part.select(F.col("p_partkey").alias("part_id"), raw.otherwise(F.col("p_size").cast("string")).alias("raw"))
    return rows.select("part_id", N.number_or_zero(rows, "raw").alias("number"))


@query("num_midpoint", f"SELECT job_id, {rnd('salary_midpoint', 2)} AS salary_midpoint FROM midpoints")
def _(t):
    return t.salaries.select("job_id", N.rounded(N.midpoint("min_salary", "max_salary"), 2).alias("salary_midpoint"))


@query("num_ratio_null", f"SELECT job_id, {rnd('views / nullif(applies, 0)', 4)} AS ratio FROM postings")
def _(t):
    return t.postings.select("job_id", N.ratio_or_null("views", "applies").alias("ratio"))


@query("num_ratio_one", f"""SELECT job_id, {rnd('views / CASE WHEN applies = 0 THEN 1 ELSE applies END', 4)} AS ratio
    FROM postings""")
def _(t):
    return t.postings.select("job_id", N.ratio_over_one("views", "applies").alias("ratio"))


@query("num_flag", "SELECT job_id, CAST(coalesce(remote_allowed, 0) AS INTEGER) AS is_remote FROM postings")
def _(t):
    return t.postings.select("job_id", N.flag("remote_allowed").alias("is_remote"))


@query("num_ape", f"""SELECT model, job_id, {rnd('abs((actual - predicted) / nullif(actual, 0)) * 100', 4)} AS ape FROM priced""")
def _(t):
    return t.priced.select("model", "job_id", N.rounded(N.percentage_error("actual", "predicted"), 4).alias("ape"))


@query("dat_epoch_ms", "SELECT job_id, make_timestamp(original_listed_time * 1000) AS listed_date FROM postings")
def _(t):
    listed = N.epoch_ms_to_timestamp("original_listed_time").cast("timestamp_ntz")
    return t.postings.select("job_id", listed.alias("listed_date"))


@query("dat_month", """SELECT job_id, strftime(make_timestamp(original_listed_time * 1000), '%Y-%m') AS listed_month
    FROM postings""")
def _(t):
    return t.postings.select("job_id", N.month_label(N.epoch_ms_to_timestamp("original_listed_time")).alias("listed_month"))
