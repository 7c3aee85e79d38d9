"""Sources, sinks and the warehouse and preprocessing pipelines."""

import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from starloom.mining import supervised
from starloom.plans.preprocess import encode_categories, preprocess
from starloom.plans.warehouse import build_fact, build_star
from starloom.session import stored_for_fits
from starloom.sources import readers, sinks


@pytest.fixture()
def raw(tmp_path):
    os.makedirs(tmp_path / "companies")
    os.makedirs(tmp_path / "jobs")
    (tmp_path / "postings.csv").write_text(
        " Job_ID ,company_id,title,description,work_type,remote_allowed,formatted_experience_level,applies,views,"
        "original_listed_time,normalized_salary,extra col\n"
        '1,10,Lead Analyst,"<p>Line one,\n""quoted"" the data</p>",FULL_TIME,1,Director,5,100,1672531200000,90000,x\n'
        "2,11,Clerk,,PART_TIME,,,,0,bad,nan,\n"
        "3,12,,plain,FULL_TIME,0,Intern,2,0,1675209600000,600000,\n"
    )
    (tmp_path / "companies/companies.csv").write_text(
        'company_id,name,company_size,state,country\n10,"A, B",1-10,California,US\n11,C,huge,  tx ,US\n'
    )
    (tmp_path / "jobs/job_skills.csv").write_text("job_id,skill_abr\n1,IT\n1,ENG\n3,IT\n9,IT\n")
    (tmp_path / "jobs/salaries.csv").write_text(
        "job_id,min_salary,max_salary,pay_period,currency\n1,80000,100000,YEARLY,USD\n1,,120000,YEARLY,USD\n2,10,20,HOURLY,USD\n"
    )
    (tmp_path / "jobs/benefits.csv").write_text("job_id,type,inferred\n1,401K,1\n")
    return str(tmp_path)


def test_manifest_and_reading(spark, raw):
    manifest = {r["name"]: (r["present"], r["all_present"]) for r in readers.source_manifest(spark, raw).collect()}
    assert manifest["job_postings"] == (True, False) and manifest["job_industries"] == (False, False)
    tables = readers.read_tables(spark, raw)
    assert "job_industries" not in tables
    rows = tables["job_postings"].collect()
    assert len(rows) == 3 and rows[0]["description"] == '<p>Line one,\n"quoted" the data</p>'
    assert rows[1]["original_listed_time"] is None and rows[1]["normalized_salary"] is None
    assert rows[0]["extra col"] == "x"


def test_warehouse_and_preprocessing(spark, raw, tmp_path):
    tables = readers.read_tables(spark, raw)
    fact = build_fact(tables)
    rows = fact.orderBy("job_id", "salary_midpoint").collect()
    assert [(r["job_id"], r["salary_midpoint"], r["skill_count"]) for r in rows] == [
        (1, 90000.0, 2), (1, 120000.0, 2), (2, None, 0), (3, None, 1),
    ]
    assert [r["listed_month"] for r in rows] == ["2023-01", "2023-01", None, "2023-02"]
    assert [r["apply_rate"] for r in rows] == [0.05, 0.05, None, None]
    assert [r["is_remote"] for r in rows] == [1, 1, 0, 0]
    assert build_fact(tables, unique_salaries=True).count() == 3

    out = str(tmp_path / "warehouse")
    sinks.write_star(build_star(tables), out, {"fact_job_postings": ["listed_month"]})
    stored = sinks.read_star(spark, out)
    assert {n: df.count() for n, df in stored.items()} == {
        "fact_job_postings": 4, "dim_companies": 2, "dim_salaries": 2, "bridge_job_skills": 4, "dim_benefits": 1,
    }
    assert readers.first_path(spark, [f"{out}/absent", f"{out}/dim_companies"]).count() == 2
    assert readers.first_path(spark, [f"{out}/absent"]) is None

    done = {(r["job_id"], r["salary_midpoint"]): r for r in preprocess(stored["fact_job_postings"], ["FULL_TIME", "PART_TIME", "Unknown"]).collect()}
    first, second, third = done[1, 90000.0], done[2, None], done[3, None]
    assert first["description_clean"] == "line one quoted data" and second["description_clean"] == ""
    assert (first["state"], second["state"], third["state"]) == ("CA", "Unknown", "Unknown")
    assert (first["experience_encoded"], second["experience_encoded"], third["experience_encoded"]) == (4, -1, -1)
    assert (first["company_size_encoded"], second["company_size_encoded"]) == (1, 0)
    assert (first["work_PART_TIME"], second["work_PART_TIME"]) == (0, 1) and "work_FULL_TIME" not in first
    assert (first["salary_clean"], second["salary_clean"], third["salary_clean"]) == (90000.0, None, None)
    assert (first["high_demand"], second["high_demand"], third["high_demand"]) == (1.0, None, 0.0)
    assert (first["is_senior_title"], second["is_senior_title"], third["is_senior_title"]) == (1, 0, 0)
    assert (second["apply_rate"], third["apply_rate"]) == (0.0, 2.0)
    assert sum(r["views_scaled"] for r in done.values()) == pytest.approx(0.0, abs=1e-9)


def test_preprocessing_skips_absent_columns(spark):
    df = spark.createDataFrame([(1, 2.0)], "job_id int, views double")
    assert preprocess(df).columns == ["job_id", "views", "views_scaled"]
    with pytest.raises(Exception, match="not listed: GIG"):
        encode_categories(spark.createDataFrame([("GIG",)], "work_type string")).collect()


def test_catalog_tables_and_fallback(spark, raw):
    tables = readers.read_tables(spark, raw)
    tables["companies"].createOrReplaceTempView("merged_test")
    assert readers.first_available(spark, ["preprocessed_test", "merged_test"]).count() == 2
    assert readers.first_available(spark, ["preprocessed_test"]) is None


def test_csv_exports_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, ' a "quoted", text '), (2, None)], "job_id bigint, skill_abr string")
    sinks.write_csv(df, str(tmp_path / "jobs/job_skills.csv"))
    got = readers.read_tables(spark, str(tmp_path))["job_skills"]
    assert {tuple(r) for r in got.collect()} == {(1, ' a "quoted", text '), (2, None)}
    rules = spark.createDataFrame([(["b", "a"], ["c"], 0.5)], "antecedents array<string>, consequents array<string>, lift double")
    sinks.write_rules(rules, str(tmp_path / "rules"))
    text = spark.read.option("header", True).csv(str(tmp_path / "rules")).first()
    assert (text["antecedents"], text["consequents"]) == ("a, b", "c")


def test_reloaded_model_predicts_the_same(spark, tmp_path):
    df = spark.range(200).select(
        F.col("id").alias("job_id"), (F.col("id") % 17).cast("double").alias("views"), (F.col("id") % 17 * 1000.0 + 30000).alias("salary_clean")
    )
    task = supervised.regression_task(df)
    model = supervised.fit_regressors(task, ["Linear Regression"])["Linear Regression"]
    sinks.save_model(model, str(tmp_path / "model"))
    again = sinks.load_model(str(tmp_path / "model"))
    before = model.transform(task.test).select("job_id", "prediction").collect()
    after = again.transform(task.test).select("job_id", "prediction").collect()
    assert sorted(before) == sorted(after)


def test_csv_parts_are_put_together_by_column_name(spark, tmp_path):
    folder = tmp_path / "jobs/job_skills.csv"
    folder.mkdir(parents=True)
    (folder / "a.csv").write_text("job_id,skill_abr\n1,IT\n")
    (folder / "b.csv").write_text("skill_abr,job_id\nHR,2\n")
    (folder / "c.csv").write_text("job_id\n3\n")
    rows = readers.read_tables(spark, str(tmp_path))["job_skills"].collect()
    assert {(r["job_id"], r["skill_abr"]) for r in rows} == {(1, "IT"), (2, "HR"), (3, None)}


def test_queries_run_where_workers_have_no_package(tmp_path):
    """The package is on the driver's path only; functions in tasks must bring their own code."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = f"""
import sys
sys.path.insert(0, {root!r})
from starloom.session import build_session
spark = build_session("apart", "local[2]", **{{"spark.sql.shuffle.partitions": "2", "spark.ui.enabled": "false"}})
from starloom.plans.catalog import QUERIES
for name in ("sta_corr", "clu_silhouette"):
    assert QUERIES[name](spark, "/root/testdata/sf0.001").count() > 0
print("all ran")
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "all ran" in done.stdout, done.stderr[-2000:]


def test_fits_do_not_depend_on_the_layout_of_the_input(spark):
    df = spark.range(400).selectExpr("id AS k", "cast(id % 7 AS double) AS a")
    parts = [stored_for_fits(df.repartition(n), "k", 6).rdd.glom().map(lambda rows: [r["k"] for r in rows]).collect() for n in (3, 11)]
    assert parts[0] == parts[1] and len(parts[0]) == 6


def test_bucketed_sources_join_without_shuffles_by_the_job(spark):
    import uuid

    from starloom.plans.warehouse import bucketed_sources

    n = 300
    tables = {
        "job_postings": spark.range(n).selectExpr("IF(id % 50 = 0, NULL, id) AS job_id", "id % 7 AS company_id", "CAST(id AS DOUBLE) AS applies", "2.0D AS views"),
        "companies": spark.range(6).selectExpr("id AS company_id", "concat('c', id) AS name", "'1-10' AS company_size", "'CA' AS state", "'US' AS country"),
        "salaries": spark.range(2 * n).selectExpr("IF(id % 3 = 0, 7, id DIV 3) AS job_id", "20000.0D + id AS min_salary", "30000.0D AS max_salary", "'YEARLY' AS pay_period"),
        "job_skills": spark.range(n).selectExpr("IF(id % 11 = 0, NULL, id % 40) AS job_id", "'IT' AS skill_abr"),
    }
    database = f"starloom_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {database}")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fact = build_fact(bucketed_sources(tables, database, 4), bucketed=True)
        plan = fact._jdf.queryExecution().executedPlan().toString()
        exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
        assert exchanges and not any("job_id" in line for line in exchanges)
        expected = build_fact(tables).select(*sorted(fact.columns))
        assert sorted(map(str, fact.select(*sorted(fact.columns)).collect())) == sorted(map(str, expected.collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.sql(f"DROP DATABASE {database} CASCADE")


def test_fact_moves_the_postings_twice_only(spark):
    """All joins by the job share a shuffle of the postings; that by the company is the other one."""
    n = 300
    tables = {
        "job_postings": spark.range(n).selectExpr("IF(id % 50 = 0, NULL, id) AS job_id", "id % 7 AS company_id", "CAST(id AS DOUBLE) AS applies", "2.0D AS views"),
        "companies": spark.range(6).selectExpr("id AS company_id", "concat('c', id) AS name"),
        "salaries": spark.range(2 * n).selectExpr("IF(id % 3 = 0, 7, id DIV 3) AS job_id", "20000.0D + id AS min_salary", "30000.0D AS max_salary"),
        "job_skills": spark.range(n).selectExpr("IF(id % 11 = 0, NULL, id % 40) AS job_id", "'IT' AS skill_abr"),
    }
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fact = build_fact(tables)

        def exchanged(node):
            children = node.children()
            below = [e for i in range(children.size()) for e in exchanged(children.apply(i))]
            return below + ([node.output().mkString(",")] if node.nodeName() == "Exchange" else [])

        moved = [columns for columns in exchanged(fact._jdf.queryExecution().executedPlan().initialPlan()) if "applies" in columns]
        # One for the job's details and one for the company, besides the one that the test itself asks for.
        assert len([columns for columns in moved if "skill_count" in columns]) == 2 and len(moved) == 3
        assert fact.columns == ["job_id", "company_id", "applies", "views", "is_remote", "name", "salary_midpoint", "min_salary", "max_salary", "skill_count", "apply_rate"]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_headers_of_many_files_without_a_sort_of_their_lines(spark, tmp_path, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame

    heads = {"a.csv": "job_id,skill_abr", "b.csv": "skill_abr,job_id", "c.csv": "job_id,skill_abr"}
    for i, (name, head) in enumerate(heads.items()):
        (tmp_path / name).write_text(head + "\n" + "".join(f"{i}{k},{i}{k}\n" for k in range(30_000)))
    (tmp_path / "empty.csv").write_text("")
    plans, collect = [], DataFrame.collect
    monkeypatch.setattr(DataFrame, "collect", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or collect(df))
    groups = readers._same_headers(spark, str(tmp_path))
    assert [[os.path.basename(f) for f in g] for g in groups] == [["a.csv", "c.csv"], ["b.csv"]]
    # The texts of files may be gathered per header, but no line is sorted or grouped by its file.
    assert plans and not any("Sort [file" in p or "keys=[file" in p or "key=[file" in p for p in plans)
