"""CSV sources of the star schema, their manifest and the choice between prepared tables."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.operators.project import nulls_for_nan
from starloom.sources.quoted import header_names, quoted_records, runs

# Logical source tables and their files.
SOURCE_FILES = {
    "job_postings": "postings.csv",
    "companies": "companies/companies.csv",
    "job_skills": "jobs/job_skills.csv",
    "job_industries": "jobs/job_industries.csv",
    "salaries": "jobs/salaries.csv",
    "benefits": "jobs/benefits.csv",
}

SOURCE_SCHEMAS = {
    "job_postings": (
        "job_id bigint, company_id bigint, title string, description string, work_type string, remote_allowed double, "
        "formatted_experience_level string, applies double, views double, original_listed_time bigint, "
        "normalized_salary double"
    ),
    "companies": "company_id bigint, name string, company_size string, state string, country string",
    "job_skills": "job_id bigint, skill_abr string",
    "job_industries": "job_id bigint, industry_id int",
    "salaries": "job_id bigint, min_salary double, max_salary double, pay_period string, currency string",
    "benefits": "job_id bigint, type string, inferred boolean",
}


def _exists(spark: SparkSession, path: str) -> bool:
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(jvm_path)


def source_manifest(spark: SparkSession, root: str, files: Mapping[str, str] = SOURCE_FILES) -> DataFrame:
    """One row per expected source: name, relative path, whether it is there, and whether all are."""
    found = [(name, path, _exists(spark, f"{root}/{path}")) for name, path in files.items()]
    rows = [(name, path, here, all(f[2] for f in found)) for name, path, here in found]
    return spark.createDataFrame(rows, "name string, path string, present boolean, all_present boolean")


# Tables with free text, whose values may contain line breaks; they are cut into records first.
FREE_TEXT_TABLES = ("job_postings",)


def _csv_reader(spark: SparkSession):
    return spark.read.option("header", True).option("escape", '"')


def _same_headers(spark: SparkSession, path: str) -> list[list[str]]:
    """The CSV files below a path, grouped by their header line."""
    first = F.split(F.col("value"), r"\r?\n", 2)[0]
    lines = spark.read.text(path, wholetext=False).select(F.input_file_name().alias("file"), F.col("_metadata.file_block_start").alias("split"), first.alias("header"))

    def leading(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A file's first line is the first row of its first block; an aggregate of texts would sort all lines for it.
        seen = set()
        for batch in batches:
            for (file, _), part in runs(batch):
                if file not in seen:
                    seen.add(file)
                    yield part.slice(0, 1).select(["file", "header"])

    heads = lines.where("split = 0").mapInArrow(leading, "file string, header string")
    groups = heads.groupBy("header").agg(F.collect_list("file").alias("files")).collect()
    return [sorted(g["files"]) for g in sorted(groups, key=lambda g: g["header"])]


def _header_schema(names: Sequence[str], declared: str) -> T.StructType:
    """Types by column name for the columns that files of one header have, in their order; undeclared ones stay text."""
    types = {f.name: f.dataType for f in T.StructType.fromDDL(declared).fields}
    return T.StructType([T.StructField(name, types.get(name.strip().lower().replace(" ", "_"), T.StringType())) for name in names])


def _read_lines(spark: SparkSession, path: str, declared: str) -> list[DataFrame]:
    """Files whose records are lines, one frame for each header; Spark splits them."""
    parts = []
    for files in _same_headers(spark, path):
        schema = _header_schema(_csv_reader(spark).csv(files[0]).columns, declared)
        parts.append(_csv_reader(spark).option("enforceSchema", False).schema(schema).csv(files))
    return parts


def _read_quoted(spark: SparkSession, path: str, declared: str) -> list[DataFrame]:
    """Files whose values may hold line breaks, one frame for each header."""
    records, heads = quoted_records(spark, path)
    groups = heads.groupBy("header").agg(F.collect_list("file").alias("files")).orderBy("header").collect()
    parts = []
    for group in groups:
        schema = _header_schema(header_names(group["header"]), declared)
        rows = records if len(groups) == 1 else records.where(F.col("file").isin(group["files"]))
        row = F.from_csv("text", ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema), {"escape": '"'})
        parts.append(rows.where(~F.col("first")).select(row.alias("_row")).select("_row.*"))
    return parts


def _read_csv(spark: SparkSession, path: str, declared: str, free_text: bool) -> DataFrame:
    """All files below a path, put together by column name; a column that some files lack is NULL there."""
    parts = (_read_quoted if free_text else _read_lines)(spark, path, declared)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def read_tables(
    spark: SparkSession,
    root: str,
    files: Mapping[str, str] = SOURCE_FILES,
    schemas: Mapping[str, str] = SOURCE_SCHEMAS,
    free_text: Sequence[str] = FREE_TEXT_TABLES,
) -> dict[str, DataFrame]:
    """All sources that exist; absent files are skipped. Values that do not parse become NULL."""
    tables = {}
    for name, file in files.items():
        path = f"{root}/{file}"
        if _exists(spark, path):
            tables[name] = nulls_for_nan(_read_csv(spark, path, schemas[name], name in free_text))
    return tables


def first_available(spark: SparkSession, names: Sequence[str]) -> DataFrame | None:
    """The first of several tables (or views) that exists."""
    for name in names:
        if spark.catalog.tableExists(name):
            return spark.table(name)
    return None


def first_path(spark: SparkSession, paths: Sequence[str], schema: str | None = None) -> DataFrame | None:
    """The first of several Parquet folders that exists."""
    for path in paths:
        if _exists(spark, path):
            reader = spark.read.schema(schema) if schema else spark.read
            return reader.parquet(path)
    return None
