"""Document copies of raw logs and readers of the serving tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from netvigil.operators.clean import whole_number
from netvigil.schema import DOCUMENT_SCHEMA, METRICS, RAW_COLUMNS
from netvigil.sources.versions import read_published, table_or_none

# Texts that mean "no value" in a raw log.
MISSING_TEXTS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
                 "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]


def to_documents(raw: DataFrame) -> DataFrame:
    """Raw rows with missing texts as NULL and the metrics as nullable whole numbers."""
    present = lambda name: F.when(~F.col(name).isin(MISSING_TEXTS), F.col(name))
    return raw.select(*[
        (whole_number(present(name)) if name in METRICS else present(name)).alias(name)
        for name in RAW_COLUMNS
    ])


def load_documents(raw: DataFrame, path: str, load: str | None = None) -> None:
    """Append raw rows to the document copy. NULL fields are kept in each document.

    With the name of a load the rows go to its own partition, which a repetition
    replaces, so that a load that failed or was started twice leaves one copy.
    """
    documents = to_documents(raw)
    if load is None:
        documents.write.mode("append").option("ignoreNullFields", False).json(path)
        return
    documents.withColumn("load", F.lit(load)).write.partitionBy("load").mode("overwrite").option(
        "partitionOverwriteMode", "dynamic").option("ignoreNullFields", False).json(path)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(DOCUMENT_SCHEMA).json(path).select(*DOCUMENT_SCHEMA.names)


def read_serving(
    spark: SparkSession, table_path: str, mirror_path: str, schema: StructType | None = None
) -> DataFrame | None:
    """The serving table (as published, or a plain one), or its JSON mirror when the table is absent or empty."""
    for read in (lambda: read_published(spark, table_path), lambda: table_or_none(spark, table_path, "parquet", schema),
                 lambda: table_or_none(spark, mirror_path, "json", schema)):
        found = read()
        if found is not None and not found.isEmpty():
            return found
    return None
