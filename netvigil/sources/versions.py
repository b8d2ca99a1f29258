"""Readers of published tables: the newest commit record names the current folder of every table."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

COMMITS = "commits"
COMMIT_SCHEMA = "version bigint, tables array<struct<name:string,folder:string>>"


def table_or_none(spark: SparkSession, path: str, fmt: str = "parquet", schema: StructType | str | None = None):
    """The table at ``path``, or None when there is none."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    try:
        return reader.format(fmt).load(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def commits(spark: SparkSession, root: str) -> DataFrame | None:
    """One row per refresh, None before the first."""
    return table_or_none(spark, f"{root}/{COMMITS}", "json", COMMIT_SCHEMA)


def current(spark: SparkSession, root: str) -> tuple[int, dict[str, str]]:
    """The newest version and its folder of every table; version 0 has none."""
    found = commits(spark, root)
    newest = None if found is None else found.orderBy(F.desc("version")).first()
    return (0, {}) if newest is None else (newest.version, {t.name: t.folder for t in newest.tables})


def read_current(spark: SparkSession, root: str, name: str) -> DataFrame | None:
    """A published table, or None when it was never published."""
    folder = current(spark, root)[1].get(name)
    return None if folder is None else spark.read.parquet(f"{root}/{folder}")


def read_published(spark: SparkSession, path: str) -> DataFrame | None:
    """As ``read_current``, by the path under which a table was refreshed."""
    root, _, name = path.rstrip("/").rpartition("/")
    return read_current(spark, root, name)
