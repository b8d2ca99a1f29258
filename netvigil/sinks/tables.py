"""Parquet outputs, serving tables, JSON mirrors and run records."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from netvigil.functions.temporal import as_text
from netvigil.sinks.versions import publish


def write_table(df: DataFrame, path: str) -> DataFrame:
    """Overwrite a Parquet output and return it as read back."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def write_lookup(risk: DataFrame, path: str) -> None:
    """Risk table for point lookups of an address.

    Sorted by address, so that row groups with other ranges are skipped, and with
    a bloom filter per row group, so that an address that was never seen is
    answered without reading a row of the range it would be in.
    """
    options = {"parquet.bloom.filter.enabled#source_ip": "true", "parquet.bloom.filter.adaptive.enabled": "true"}
    risk.repartitionByRange("source_ip").sortWithinPartitions("source_ip").write.mode("overwrite").options(**options).parquet(path)


def refresh_serving(df: DataFrame, path: str) -> bool:
    """Replace a serving table (read it with ``read_published``); an empty input leaves the old one in place.

    Its readers see the old table until the new one is complete.
    """
    root, _, name = path.rstrip("/").rpartition("/")
    return bool(publish({name: df}, root))


def stamped(predictions: DataFrame) -> DataFrame:
    return predictions.withColumn("analyzed_at", F.current_timestamp())


def append_predictions(predictions: DataFrame, path: str, run: str) -> None:
    """Add the predictions of a run to the log; the same run given again replaces its own and no others."""
    stamped(predictions).withColumn("run", F.lit(run)).write.partitionBy("run").mode("overwrite").option(
        "partitionOverwriteMode", "dynamic").parquet(path)


def without_timestamps(df: DataFrame) -> DataFrame:
    """Timestamps as text, all other columns unchanged."""
    is_time = lambda f: isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType))
    return df.select(*[
        as_text(F.col(f.name)).alias(f.name) if is_time(f) else F.col(f.name) for f in df.schema.fields
    ])


def json_mirror(df: DataFrame, path: str) -> None:
    """JSON copy of a table, timestamps as text, NULL fields kept."""
    without_timestamps(df).write.mode("overwrite").option("ignoreNullFields", False).json(path)


def read_mirror(spark: SparkSession, path: str, table: DataFrame) -> DataFrame:
    """A JSON mirror under the schema of the table it copies."""
    return spark.read.schema(without_timestamps(table).schema).json(path)


def rows_per_output(outputs: dict[str, DataFrame]) -> DataFrame:
    """One row per output with its number of records (read from Parquet footers)."""
    counted = [
        df.agg(F.count(F.lit(1)).alias("records")).select(F.lit(name).alias("output"), "records")
        for name, df in outputs.items()
    ]
    return reduce(DataFrame.unionByName, counted)


def run_summary(outputs: dict[str, DataFrame], flows: DataFrame) -> DataFrame:
    """Rows of every output and the number of analysed flows."""
    analysed = flows.agg(F.count(F.lit(1)).alias("records")).select(
        F.lit("total_records_analysed").alias("output"), "records"
    )
    return rows_per_output(outputs).unionByName(analysed)


def integration_manifest(outputs: dict[str, DataFrame], version: str) -> DataFrame:
    """Documents per published collection, their total, and the pipeline version."""
    counted = rows_per_output(outputs)
    total = counted.agg(F.sum("records").alias("records")).select(F.lit("TOTAL").alias("output"), "records")
    return counted.unionByName(total).select(
        F.col("output").alias("collection"), F.col("records").alias("documents"),
        F.lit(version).alias("pipeline_version"),
    )
