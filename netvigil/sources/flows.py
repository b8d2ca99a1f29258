"""Readers for raw and clean flow tables."""

from __future__ import annotations

from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from netvigil.schema import RAW_SCHEMA


def read_raw_flows(spark: SparkSession, path: str) -> DataFrame:
    """Raw flow logs from CSV, all fields as text (no inference pass).

    Columns are found by their names in the header, in any order and among
    others; a file whose header differs from the first one is an error.
    """
    found = spark.read.option("header", True).option("enforceSchema", False).csv(path)
    return found.select(*RAW_SCHEMA.names)


REJECTED = "rejected_line"


def read_raw_records(spark: SparkSession, path: str) -> DataFrame:
    """Raw flow logs as ``read_raw_flows`` has them, and ``rejected_line``: the text of a line that is no record, else NULL.

    A line is no record if it has fewer or more fields than the header; fields are counted whatever is read of them. Header
    and lines are parsed once; the names come from the first line.
    """
    names = spark.read.option("header", True).csv(path).columns
    schema = T.StructType([T.StructField(name, T.StringType()) for name in [*names, REJECTED]])
    found = spark.read.schema(schema).option("header", True).option("enforceSchema", False).option(
        "columnNameOfCorruptRecord", REJECTED).option("columnPruning", False).csv(path)
    return found.select(*RAW_SCHEMA.names, REJECTED, F.lit(len(names)).alias("expected_fields"), F.col(names[-1]).alias("last_field"))


def rejected_rows(records: DataFrame) -> DataFrame:
    """The lines that are no records, as often as they occur, with the reason; fields are told by their commas."""
    fields = F.size(F.split(REJECTED, ","))
    few, many = fields < F.col("expected_fields"), fields > F.col("expected_fields")
    # Spark refuses to read this column alone, so the condition has a second one: a short line has no last field.
    lost = F.col(REJECTED).isNotNull() & (F.col("last_field").isNull() | ~few)
    reason = F.when(few, "too few fields").when(many, "too many fields").otherwise("unreadable")
    return records.where(lost).select(reason.alias("reason"), F.col(REJECTED).alias("line"))


def write_raw_flows(raw: DataFrame, path: str) -> None:
    """Write raw logs as CSV, keeping the blanks around fields."""
    (
        raw.select(*RAW_SCHEMA.names).write.option("header", True)
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def read_flows(spark: SparkSession, path: str) -> DataFrame:
    """Clean flows from Parquet."""
    return spark.read.parquet(path)


def inline_rows(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A small in-memory list as a DataFrame.

    Handed over as Arrow, it becomes a local table in the plan and needs no
    Python worker on the executors.
    """
    fields = T.StructType.fromDDL(schema)
    columns = [pa.array(values) for values in zip(*rows)]
    return spark.createDataFrame(pa.Table.from_arrays(columns, names=fields.names), fields)


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table with its number of records and fields."""
    counted = [
        df.agg(F.count(F.lit(1)).alias("records")).select(
            F.lit(name).alias("table_name"), "records", F.lit(len(df.columns)).alias("fields")
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counted)


def sum_probe(table: DataFrame, column: str) -> DataFrame:
    """Distributed sum over one column, the sanity check of a fresh cluster."""
    return table.agg(
        F.count(F.lit(1)).alias("items"), F.sum(F.col(column)).cast("long").alias("total")
    )
