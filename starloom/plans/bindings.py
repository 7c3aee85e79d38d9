"""The star schema expressed over the test tables, once as frames and once as SQL for the oracle.

Orders play postings, customers companies, line items the category bridge. Gaps that the tables lack are bound to
attribute values (a priority, a status), so null handling is exercised on every query.
"""

from __future__ import annotations

import re
from collections.abc import Mapping
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.functions.encode import COMPANY_SIZE_CODES, EXPERIENCE_CODES, STATE_CODES, literal_map
from starloom.functions.text import SENIOR_KEYWORDS
from starloom.plans.preprocess import preprocess
from starloom.plans.warehouse import build_fact
from starloom.session import materialize

TITLES = {
    "1-URGENT": " Senior Data Scientist ",
    "2-HIGH": "Lead ML Engineer",
    "3-MEDIUM": "Data Analyst",
    "5-LOW": "Product Manager",
}
LEVELS = {"1-URGENT": "Director", "2-HIGH": "Mid-Senior level", "3-MEDIUM": "Associate", "5-LOW": "Entry level"}
WORK_TYPES = {"F": "FULL_TIME", "O": "PART_TIME", "P": "CONTRACT"}
SIZES = {
    "AUTOMOBILE": "1-10",
    "BUILDING": "51-200",
    "FURNITURE": "501-1000",
    "HOUSEHOLD": "10001+",
    "MACHINERY": "freelance",
}
STATES = {
    "NATION_0": "California",
    "NATION_1": " TX ",
    "NATION_2": "ny",
    "NATION_3": "New York",
    "NATION_4": "WA",
    "NATION_5": " Massachusetts",
    "NATION_6": "Ontario",
    "NATION_7": "FL",
    "NATION_8": "District of Columbia",
    "NATION_9": "Florida",
    "NATION_10": "QQ",
}
BRAND_CODES = (
    "IT SALE MGMT MNFC HCPR BD ENG OTHR FIN MRKT ACCT ADM CUST PRJM ANLS RSCH HR LGL CNSL EDU SCI DSGN WRT QA STRA"
).split()
TYPE_CODES = {"ECONOMY": "IT", "LARGE": "SALE", "MEDIUM": "MGMT", "PROMO": "MNFC", "SMALL": "HCPR", "STANDARD": "BD"}
BENEFITS = {"A": "Medical insurance", "N": "Dental insurance", "R": "401K"}


def _of(c: str, mapping: Mapping[str, str]) -> Column:
    return F.try_element_at(literal_map(mapping), F.col(c))


def _case(c: str, mapping: Mapping, default: str = "NULL") -> str:
    def literal(v) -> str:
        return f"'{v}'" if isinstance(v, str) else str(v)

    arms = " ".join(f"WHEN {literal(k)} THEN {literal(v)}" for k, v in mapping.items())
    return f"CASE {c} {arms} ELSE {default} END"


BRANDS = {f"Brand#{i + 1}": code for i, code in enumerate(BRAND_CODES)}

# The fact table and the prepared table are stage tables: written once per session, as the pipeline does.
_STAGES: dict[tuple[str, str, str], DataFrame] = {}


class Tables:
    """Test tables of one folder and the logical tables bound to them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def _stage(self, name: str, build) -> DataFrame:
        key = (self.spark.sparkContext.applicationId, self.folder, name)
        if key not in _STAGES:
            _STAGES[key] = materialize(build())
        return _STAGES[key]

    @cached_property
    def postings(self) -> DataFrame:
        lines = self.lineitem.groupBy(F.col("l_orderkey").alias("job_id")).agg(
            F.sum("l_quantity").alias("views"), F.count_if(F.col("l_returnflag") == "R").cast("double").alias("applies")
        )
        first_half = F.month("o_orderdate") <= 6
        orders = self.orders.select(
            F.col("o_orderkey").alias("job_id"),
            F.col("o_custkey").alias("company_id"),
            _of("o_orderpriority", TITLES).alias("title"),
            _of("o_orderstatus", WORK_TYPES).alias("work_type"),
            F.when(F.col("o_orderpriority") != "3-MEDIUM", first_half.cast("double")).alias("remote_allowed"),
            _of("o_orderpriority", LEVELS).alias("formatted_experience_level"),
            F.unix_millis(F.col("o_orderdate").cast("timestamp")).alias("original_listed_time"),
            F.col("o_totalprice").alias("normalized_salary"),
        )
        return orders.join(lines, "job_id", "left")

    @cached_property
    def companies(self) -> DataFrame:
        nations = self.nation.select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
        return self.customer.join(nations, "c_nationkey", "left").select(
            F.col("c_custkey").alias("company_id"),
            F.col("c_name").alias("name"),
            _of("c_mktsegment", SIZES).alias("company_size"),
            _of("n_name", STATES).alias("state"),
            F.lit("US").alias("country"),
        )

    @cached_property
    def salaries(self) -> DataFrame:
        price = F.col("o_totalprice")
        return self.orders.select(
            F.col("o_orderkey").alias("job_id"),
            F.when(F.col("o_orderpriority") != "5-LOW", price * 0.8).alias("min_salary"),
            F.when(F.col("o_orderstatus") != "P", price * 1.2).alias("max_salary"),
            F.lit("YEARLY").alias("pay_period"),
            F.lit("USD").alias("currency"),
        )

    @cached_property
    def salary_lines(self) -> DataFrame:
        """A salary table that repeats jobs."""
        return self.lineitem.select(
            F.col("l_orderkey").alias("job_id"),
            (F.col("l_extendedprice") * 0.8).alias("min_salary"),
            F.when(F.col("l_returnflag") != "N", F.col("l_extendedprice") * 1.2).alias("max_salary"),
            F.lit("YEARLY").alias("pay_period"),
        )

    def _bridge(self, c: str, mapping: Mapping[str, str]) -> DataFrame:
        parts = self.part.select(F.col("p_partkey").alias("l_partkey"), _of(c, mapping).alias("skill_abr"))
        lines = self.lineitem.select(F.col("l_orderkey").alias("job_id"), "l_partkey")
        return lines.join(parts, "l_partkey").select("job_id", "skill_abr")

    @cached_property
    def bridge(self) -> DataFrame:
        return self._bridge("p_brand", BRANDS)

    @cached_property
    def small_bridge(self) -> DataFrame:
        return self._bridge("p_type", TYPE_CODES)

    @cached_property
    def benefits(self) -> DataFrame:
        return self.lineitem.select(
            F.col("l_orderkey").alias("job_id"),
            _of("l_returnflag", BENEFITS).alias("type"),
            (F.col("l_linestatus") == "O").alias("inferred"),
        )

    @cached_property
    def titles(self) -> DataFrame:
        return self.part.select(F.col("p_partkey").alias("part_id"), F.col("p_name").alias("title"))

    @cached_property
    def sources(self) -> dict[str, DataFrame]:
        return {
            "job_postings": self.postings,
            "companies": self.companies,
            "job_skills": self.bridge,
            "salaries": self.salaries,
            "benefits": self.benefits,
        }

    @cached_property
    def fact(self) -> DataFrame:
        return self._stage("fact", lambda: build_fact(self.sources))

    @cached_property
    def prepared(self) -> DataFrame:
        return self._stage("prepared", lambda: preprocess(self.fact, sorted(WORK_TYPES.values())))

    @cached_property
    def scored(self) -> DataFrame:
        """Two deterministic scorers of document quality: (model, doc_id, actual, predicted, score)."""
        rows = self.labels.join(self.documents.select("doc_id", "n_chars"), "doc_id")
        common = ["doc_id", F.col("quality").alias("actual")]
        by_length = rows.select(
            F.lit("length").alias("model"),
            *common,
            (F.col("n_chars") > 2000).cast("int").alias("predicted"),
            F.col("n_chars").cast("double").alias("score"),
        )
        by_toxicity = rows.select(
            F.lit("toxicity").alias("model"),
            *common,
            (1 - F.col("toxic")).alias("predicted"),
            (1 - F.col("toxic")).cast("double").alias("score"),
        )
        return by_length.unionByName(by_toxicity)

    @cached_property
    def priced(self) -> DataFrame:
        """Deterministic predictions of an order's price from its lines: (model, job_id, actual, predicted)."""
        lines = self.lineitem.groupBy(F.col("l_orderkey").alias("job_id")).agg(
            F.sum("l_extendedprice").alias("gross"), F.count(F.lit(1)).alias("lines")
        )
        rows = self.orders.select(F.col("o_orderkey").alias("job_id"), F.col("o_totalprice").alias("actual")).join(lines, "job_id")
        gross = rows.select(F.lit("gross").alias("model"), "job_id", "actual", F.col("gross").alias("predicted"))
        lines = rows.select(
            F.lit("lines").alias("model"), "job_id", "actual", (F.col("lines") * 60000.0).alias("predicted")
        )
        return gross.unionByName(lines)

    @cached_property
    def vectors(self) -> DataFrame:
        return self.embeddings.select(
            "vec_id", F.col("label").alias("cluster"), F.col("embedding").cast("array<double>").alias("features")
        )


# ---------------------------------------------------------------------------------------------------------------------
# The same bindings as SQL common table expressions.


def rnd(expr: str, digits: int) -> str:
    """Half-even rounding of a double, the twin of `rounded`."""
    return f"(round_even(CAST({expr} AS DOUBLE) * {10**digits}.0, 0) / {10**digits}.0 + 0.0)"


def hashed(source: str, key: str, seed: int = 42) -> str:
    """Rows of a source with the seeded hash `_h`, the twin of `seeded_hash`."""
    steps = [f"CAST({key} AS BIGINT) AS k0", "xor(k0, k0 >> 31) & 2147483647 AS k1"]
    steps.append(f"(k1 * 2654435761 + {seed}) & 4294967295 AS k2")
    for i, (shift, factor) in enumerate(((15, 2654435761), (13, 2246822519), (16, 3266489917))):
        a = 2 + 2 * i
        steps.append(f"xor(k{a}, k{a} >> {shift}) & 2147483647 AS k{a + 1}")
        steps.append(f"(k{a + 1} * {factor}) & 4294967295 AS k{a + 2}")
    return f"(SELECT *, {', '.join(steps)}, k8 AS _h FROM {source})"


_KEYWORDS = "|".join(SENIOR_KEYWORDS)
_STATE_KEY = "trim(coalesce(state, 'Unknown'))"

CTES = {
    "lines": "SELECT l_orderkey AS job_id, SUM(l_quantity) AS views, "
    "CAST(COUNT(*) FILTER (WHERE l_returnflag = 'R') AS DOUBLE) AS applies FROM lineitem GROUP BY 1",
    "postings": f"""SELECT o_orderkey AS job_id, o_custkey AS company_id,
        {_case("o_orderpriority", TITLES)} AS title, {_case("o_orderstatus", WORK_TYPES)} AS work_type,
        CASE WHEN o_orderpriority <> '3-MEDIUM' THEN CAST(month(o_orderdate) <= 6 AS DOUBLE) END AS remote_allowed,
        {_case("o_orderpriority", LEVELS)} AS formatted_experience_level,
        epoch_ms(o_orderdate) AS original_listed_time, o_totalprice AS normalized_salary, views, applies
        FROM orders LEFT JOIN lines ON o_orderkey = lines.job_id""",
    "companies": f"""SELECT c_custkey AS company_id, c_name AS name, {_case("c_mktsegment", SIZES)} AS company_size,
        {_case("n_name", STATES)} AS state, 'US' AS country
        FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""",
    "salaries": """SELECT o_orderkey AS job_id, CASE WHEN o_orderpriority <> '5-LOW' THEN o_totalprice * 0.8::DOUBLE END AS min_salary,
        CASE WHEN o_orderstatus <> 'P' THEN o_totalprice * 1.2::DOUBLE END AS max_salary, 'YEARLY' AS pay_period, 'USD' AS currency
        FROM orders""",
    "salary_lines": """SELECT l_orderkey AS job_id, l_extendedprice * 0.8::DOUBLE AS min_salary,
        CASE WHEN l_returnflag <> 'N' THEN l_extendedprice * 1.2::DOUBLE END AS max_salary, 'YEARLY' AS pay_period FROM lineitem""",
    "midpoints": """SELECT *, (coalesce(min_salary, max_salary) + coalesce(max_salary, min_salary)) / 2 AS salary_midpoint
        FROM salaries""",
    "salaries_clean": "SELECT * FROM midpoints WHERE salary_midpoint BETWEEN 10000 AND 500000",
    "bridge": f"""SELECT l_orderkey AS job_id, {_case("p_brand", BRANDS)} AS skill_abr
        FROM lineitem JOIN part ON l_partkey = p_partkey""",
    "small_bridge": f"""SELECT l_orderkey AS job_id, {_case("p_type", TYPE_CODES)} AS skill_abr
        FROM lineitem JOIN part ON l_partkey = p_partkey""",
    "benefits": f"""SELECT l_orderkey AS job_id, {_case("l_returnflag", BENEFITS)} AS type, l_linestatus = 'O' AS inferred
        FROM lineitem""",
    "titles": "SELECT p_partkey AS part_id, p_name AS title FROM part",
    "skill_counts": "SELECT job_id, COUNT(*) AS n FROM bridge GROUP BY 1",
    "fact": f"""SELECT p.*, make_timestamp(original_listed_time * 1000) AS listed_date,
        strftime(make_timestamp(original_listed_time * 1000), '%Y-%m') AS listed_month,
        CAST(coalesce(remote_allowed, 0) AS INTEGER) AS is_remote, c.name, c.company_size, c.state, c.country,
        s.salary_midpoint, s.min_salary, s.max_salary, s.pay_period, CAST(coalesce(k.n, 0) AS INTEGER) AS skill_count,
        {rnd("applies / nullif(views, 0)", 4)} AS apply_rate
        FROM postings p LEFT JOIN companies c ON p.company_id = c.company_id
        LEFT JOIN salaries_clean s ON p.job_id = s.job_id LEFT JOIN skill_counts k ON p.job_id = k.job_id""",
    "filled": """SELECT * REPLACE (coalesce(work_type, 'Unknown') AS work_type,
        coalesce(formatted_experience_level, 'Unknown') AS formatted_experience_level,
        coalesce(company_size, 'Unknown') AS company_size, coalesce(pay_period, 'Unknown') AS pay_period,
        coalesce(applies, 0) AS applies, coalesce(views, 0) AS views, coalesce(apply_rate, 0) AS apply_rate) FROM fact""",
    "encoded": f"""SELECT * REPLACE ({rnd("applies / CASE WHEN views = 0 THEN 1 ELSE views END", 4)} AS apply_rate,
        CASE WHEN regexp_full_match({_case(_STATE_KEY, STATE_CODES, _STATE_KEY)}, '[A-Z]{{2}}')
             THEN {_case(_STATE_KEY, STATE_CODES, _STATE_KEY)} ELSE 'Unknown' END AS state),
        lower(trim(title)) AS title_clean,
        CAST({_case("formatted_experience_level", EXPERIENCE_CODES, "-1")} AS INTEGER) AS experience_encoded,
        CAST(work_type = 'FULL_TIME' AS INTEGER) AS "work_FULL_TIME",
        CAST(work_type = 'PART_TIME' AS INTEGER) AS "work_PART_TIME",
        CAST({_case("company_size", COMPANY_SIZE_CODES, "0")} AS INTEGER) AS company_size_encoded,
        CASE WHEN normalized_salary BETWEEN 20000 AND 500000 THEN normalized_salary END AS salary_clean,
        CAST(coalesce(regexp_matches(lower(title), '{_KEYWORDS}'), false) AS INTEGER) AS is_senior_title FROM filled""",
    "limits": "SELECT quantile_cont(salary_clean, 0.75) AS p75, "
    "quantile_cont(applies, 0.75) FILTER (WHERE applies > 0) AS p75_applies FROM encoded",
    "prepared": """SELECT *, CAST(coalesce(salary_clean >= (SELECT p75 FROM limits), false) AS INTEGER) AS high_salary,
        CASE WHEN applies > 0 THEN CAST(applies >= (SELECT p75_applies FROM limits) AS DOUBLE) END AS high_demand
        FROM encoded""",
    "scored": """SELECT 'length' AS model, doc_id, quality AS actual, CAST(n_chars > 2000 AS INTEGER) AS predicted,
        CAST(n_chars AS DOUBLE) AS score FROM labels JOIN documents USING (doc_id)
        UNION ALL SELECT 'toxicity', doc_id, quality, 1 - toxic, CAST(1 - toxic AS DOUBLE)
        FROM labels JOIN documents USING (doc_id)""",
    "line_sums": "SELECT l_orderkey AS job_id, SUM(l_extendedprice) AS gross, COUNT(*) AS n FROM lineitem GROUP BY 1",
    "priced": """SELECT 'gross' AS model, job_id, o_totalprice AS actual, gross AS predicted
        FROM orders JOIN line_sums ON o_orderkey = job_id
        UNION ALL SELECT 'lines', job_id, o_totalprice, n * 60000::DOUBLE FROM orders JOIN line_sums ON o_orderkey = job_id""",
    "vectors": "SELECT vec_id, label AS cluster, CAST(embedding AS DOUBLE[]) AS features FROM embeddings",
}


#: A table expression that starts with this is computed once, however often it is named.
ONCE = "/* once */ "


def with_ctes(body: str, extra: Mapping[str, str] | None = None) -> str:
    """Prefix a query with the common table expressions it names, in dependency order."""
    defined = CTES | dict(extra or {})
    ordered: list[str] = []

    def visit(text: str) -> None:
        for name in defined:
            if name not in ordered and re.search(rf"\b{name}\b", text):
                if text is not defined[name]:
                    visit(defined[name])
                if name not in ordered:
                    ordered.append(name)

    visit(body)
    if not ordered:
        return body
    return "WITH " + ",\n".join(f"{name} AS {'MATERIALIZED ' if defined[name].startswith(ONCE) else ''}({defined[name]})" for name in ordered) + "\n" + body
