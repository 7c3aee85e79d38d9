"""Writers: star-schema tables, CSV exports and fitted models."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Names of the warehouse tables.
WAREHOUSE_TABLES = (
    "fact_job_postings", "dim_companies", "dim_salaries", "bridge_job_skills", "dim_benefits",
)


def _write_table(df: DataFrame, path: str, by: Sequence[str]) -> None:
    """One warehouse table as Parquet; an existing one is replaced.

    A partitioned table is rebalanced on its partition columns first: one writer per partition value when it is
    small, several when it is large, so neither tiny files nor one huge task results.
    """
    if by:
        df = df.hint("rebalance", *[F.col(c) for c in by])
    df.write.mode("overwrite").partitionBy(*by).parquet(path)


def write_star(tables: Mapping[str, DataFrame], root: str, partitions: Mapping[str, Sequence[str]] | None = None) -> None:
    """Replace the warehouse tables as Parquet folders, one after the other; see `publish_star` for all at once."""
    for name, df in tables.items():
        _write_table(df, f"{root}/{name}", list((partitions or {}).get(name, ())))


#: The list of published versions of a warehouse, below its root.
VERSIONS = "_versions"
_VERSION_SCHEMA = "version bigint, folder string, tables array<string>"


def star_versions(spark: SparkSession, root: str) -> DataFrame:
    """version, folder, tables: all versions of the warehouse that were published, none where there is no warehouse."""
    try:
        return spark.read.schema(_VERSION_SCHEMA).parquet(f"{root}/{VERSIONS}")
    except AnalysisException as absent:
        if absent.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _VERSION_SCHEMA)


def _latest(spark: SparkSession, root: str):
    return star_versions(spark, root).orderBy(F.desc("version"), F.desc("folder")).first()


def publish_star(tables: Mapping[str, DataFrame], root: str, partitions: Mapping[str, Sequence[str]] | None = None) -> int:
    """Write all warehouse tables into a new folder and make them the current version in one step; its number is returned.

    The one row that names the folder is written last and by one task, so a reader sees all tables of the old version or
    all of the new one. Where a table fails, the old version stays and the half-written folder is never named. Tables may
    be computed from the current version. Of two writers at once the later row wins, with all of its tables.
    """
    spark = next(iter(tables.values())).sparkSession
    before, folder = _latest(spark, root), f"version-{uuid.uuid4().hex}"
    for name, df in tables.items():
        _write_table(df, f"{root}/{folder}/{name}", list((partitions or {}).get(name, ())))
    version = (before.version if before else 0) + 1
    row = spark.createDataFrame([(version, folder, sorted(tables))], _VERSION_SCHEMA)
    row.coalesce(1).write.mode("append").parquet(f"{root}/{VERSIONS}")
    return version


def published_star(spark: SparkSession, root: str, version: int | None = None) -> dict[str, DataFrame]:
    """The tables of the current version of a warehouse, or of an older one; an unknown version is an error.

    The frames stay on their version while newer ones are published.
    """
    rows = star_versions(spark, root)
    found = _latest(spark, root) if version is None else rows.where(F.col("version") == version).orderBy(F.desc("folder")).first()
    if found is None:
        raise ValueError(f"no published version {'' if version is None else version} in {root}")
    return {name: spark.read.parquet(f"{root}/{found.folder}/{name}") for name in found.tables}


def drop_versions(spark: SparkSession, root: str, keep: int = 2) -> int:
    """Delete the folders of all but the `keep` latest versions, and of those that were never published; how many went.

    Readers of what is deleted fail, so it should run when none can be left, and while nobody publishes.
    """
    kept = {r.folder for r in star_versions(spark, root).orderBy(F.desc("version"), F.desc("folder")).limit(max(keep, 1)).collect()}
    base = spark._jvm.org.apache.hadoop.fs.Path(root)
    files = base.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    old = [s.getPath() for s in files.listStatus(base) if s.getPath().getName().startswith("version-") and s.getPath().getName() not in kept]
    for path in old:
        files.delete(path, True)
    return len(old)


def save_star(tables: Mapping[str, DataFrame], database: str, partitions: Mapping[str, Sequence[str]] | None = None) -> None:
    """Replace the warehouse tables in the catalog."""
    partitions = partitions or {}
    for name, df in tables.items():
        by = list(partitions.get(name, ()))
        if by:
            df = df.hint("rebalance", *[F.col(c) for c in by])
        writer = df.write.mode("overwrite").format("parquet")
        (writer.partitionBy(*by) if by else writer).saveAsTable(f"{database}.{name}")


def read_star(spark: SparkSession, root: str, names: Sequence[str] = WAREHOUSE_TABLES) -> dict[str, DataFrame]:
    return {name: spark.read.parquet(f"{root}/{name}") for name in names}


def write_csv(df: DataFrame, path: str) -> None:
    """Interchange export; stages themselves exchange Parquet."""
    writer = df.write.mode("overwrite").option("header", True).option("escape", '"')
    # Spark trims values on writing unless told otherwise.
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)


def rules_as_text(rules: DataFrame, sep: str = ", ") -> DataFrame:
    """Item sets of a rule frame flattened to joined text."""
    sides = ("antecedents", "consequents")
    return rules.withColumns({c: F.array_join(F.array_sort(F.col(c)), sep) for c in sides})


def write_rules(rules: DataFrame, path: str) -> None:
    write_csv(rules_as_text(rules), path)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
