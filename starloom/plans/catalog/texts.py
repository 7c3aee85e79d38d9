"""Text cleaning, labels, encodings and item lists."""

from pyspark.sql import functions as F

from starloom.functions import arrays, encode, text
from starloom.functions.numeric import rounded
from starloom.operators.aggregate import item_flags, item_lists, item_sets
from starloom.plans.bindings import BRAND_CODES, WORK_TYPES, _case, rnd
from starloom.plans.catalog.registry import query

_STOP = ", ".join("'" + w.replace("'", "''") + "'" for w in text.STOP_WORDS)


def _tokens(source: str) -> str:
    """DuckDB twin of the token cleaning of a text column."""
    plain = f"regexp_replace(coalesce({source}, ''), '<[^>]+>', ' ', 'g')"
    letters = f"lower(regexp_replace({plain}, '[^a-zA-Z\\s]', ' ', 'g'))"
    return (
        f"list_filter(regexp_split_to_array({letters}, '\\s+'), "
        f"lambda w: len(w) > 2 AND NOT list_contains([{_STOP}], w))"
    )


_LISTS = {"lists": "SELECT job_id, list(skill_abr ORDER BY skill_abr) AS items FROM bridge GROUP BY 1"}


@query("str_clean", f"""SELECT 'page' AS kind, page_id AS id, array_to_string({_tokens("html")}, ' ') AS cleaned FROM pages
    UNION ALL SELECT 'document', doc_id, array_to_string({_tokens("text")}, ' ') FROM documents""")
def _(t):
    pages = t.pages.select(F.lit("page").alias("kind"), F.col("page_id").alias("id"), text.clean_text("html").alias("cleaned"))
    documents = t.documents.select(F.lit("document").alias("kind"), F.col("doc_id").alias("id"), text.clean_text("text").alias("cleaned"))
    return pages.unionByName(documents)


@query("str_avg_tokens", f"""SELECT COUNT(*) AS n, {rnd(f"avg(len({_tokens('text')}))", 4)} AS avg_tokens FROM documents""")
def _(t):
    cleaned = t.documents.select(text.clean_text("text").alias("cleaned"))
    return cleaned.agg(F.count(F.lit(1)).alias("n"), rounded(F.avg(text.token_count("cleaned")), 4).alias("avg_tokens"))


@query("str_title", "SELECT job_id, lower(trim(title)) AS title_clean FROM postings")
def _(t):
    return t.postings.select("job_id", text.normal_title("title").alias("title_clean"))


@query("str_keyword", """SELECT 'title' AS kind, job_id AS id, is_senior_title AS hit FROM encoded
    UNION ALL SELECT 'part', part_id, CAST(regexp_matches(lower(title), 'red|hot|gear') AS INTEGER) FROM titles""")
def _(t):
    posts = t.postings.select(F.lit("title").alias("kind"), F.col("job_id").alias("id"), text.keyword_flag("title").alias("hit"))
    hit = text.keyword_flag("title", ["red", "hot", "gear"])
    return posts.unionByName(t.titles.select(F.lit("part").alias("kind"), F.col("part_id").alias("id"), hit.alias("hit")))


@query("str_state", """SELECT c.company_id, CASE WHEN regexp_full_match(k, '[A-Z]{2}') THEN k ELSE 'Unknown' END AS state
    FROM (SELECT company_id, """ + _case("trim(coalesce(state, 'Unknown'))", encode.STATE_CODES, "trim(coalesce(state, 'Unknown'))")
    + " AS k FROM companies) c")
def _(t):
    return t.companies.select("company_id", encode.region_code("state").alias("state"))


@query("str_label", f"""SELECT skill_abr, {_case("skill_abr", encode.CATEGORY_LABELS, "skill_abr")} AS label, COUNT(*) AS n
    FROM bridge GROUP BY 1, 2""")
def _(t):
    return t.bridge.groupBy("skill_abr", encode.label("skill_abr").alias("label")).agg(F.count(F.lit(1)).alias("n"))


@query("str_set_label", f"""SELECT job_id, array_to_string(list_transform(items, lambda x:
    {_case("x", encode.RULE_LABELS, "x")}), ' + ') AS set_label
    FROM (SELECT job_id, list_sort(list_distinct(list(skill_abr))) AS items FROM bridge GROUP BY 1)""")
def _(t):
    return item_sets(t.bridge, "job_id", "skill_abr").select("job_id", encode.set_label("items").alias("set_label"))


@query("str_relabel", """SELECT job_id, CASE WHEN is_remote = 1 THEN 'Remote' ELSE 'On-site / Hybrid' END AS kind FROM fact""")
def _(t):
    return t.fact.select("job_id", F.when(F.col("is_remote") == 1, "Remote").otherwise("On-site / Hybrid").alias("kind"))


@query("enc_experience", "SELECT job_id, experience_encoded FROM encoded")
def _(t):
    code = encode.ordinal("formatted_experience_level", encode.EXPERIENCE_CODES, -1)
    return t.postings.select("job_id", code.alias("experience_encoded"))


@query("enc_size", f"""SELECT company_id, CAST({_case("company_size", encode.COMPANY_SIZE_CODES, "0")} AS INTEGER) AS size_encoded
    FROM companies""")
def _(t):
    return t.companies.select("company_id", encode.ordinal("company_size", encode.COMPANY_SIZE_CODES, 0).alias("size_encoded"))


@query("enc_onehot", """SELECT job_id, CAST(coalesce(work_type = 'FULL_TIME', false) AS INTEGER) AS "work_FULL_TIME",
    CAST(coalesce(work_type = 'PART_TIME', false) AS INTEGER) AS "work_PART_TIME" FROM postings""")
def _(t):
    columns = encode.dummies("work_type", sorted(WORK_TYPES.values()), "work")
    return t.postings.withColumns(columns).select("job_id", *columns)


@query("arr_filter", """SELECT job_id, array_to_string(list_filter(items, lambda x: x IN ('IT', 'SALE', 'EDU')), ',') AS kept
    FROM lists""", _LISTS)
def _(t):
    kept = arrays.keep_allowed("items", ["IT", "SALE", "EDU"])
    return item_lists(t.bridge, "job_id", "skill_abr").select("job_id", F.array_join(kept, ",").alias("kept"))


@query("arr_multihot", """SELECT job_id, array_to_string(list_transform(['IT', 'SALE', 'MGMT', 'QA'],
    lambda c: CAST(list_contains(items, c) AS INTEGER)), '') AS hot FROM lists""", _LISTS)
def _(t):
    hot = arrays.multi_hot("items", ["IT", "SALE", "MGMT", "QA"])
    rows = item_sets(t.bridge, "job_id", "skill_abr")
    return rows.select("job_id", F.array_join(F.transform(hot, lambda x: x.cast("string")), "").alias("hot"))


@query("arr_basket_matrix", "SELECT job_id, " + ", ".join(
    f"CAST(bool_or(skill_abr = '{c}') AS INTEGER) AS \"{c}\"" for c in sorted(BRAND_CODES)) + " FROM bridge GROUP BY 1")
def _(t):
    return item_flags(t.bridge, "job_id", "skill_abr", sorted(BRAND_CODES))


@query("arr_size", "SELECT job_id, CAST(len(items) AS INTEGER) AS n_items FROM lists", _LISTS)
def _(t):
    return item_lists(t.bridge, "job_id", "skill_abr").select("job_id", arrays.length("items").alias("n_items"))

