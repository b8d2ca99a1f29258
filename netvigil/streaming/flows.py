"""Streams of raw flows.

Each query runs with an available-now trigger and a checkpoint, so it can be
scheduled repeatedly and continues where it stopped.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from netvigil.ml.features import class_labels
from netvigil.ml.inference import name_predictions
from netvigil.operators.clean import typed_flows, valid_flows, with_time_parts
from netvigil.operators.enrich import with_technique
from netvigil.operators.entropy import entropy_of, rounded, symbol_counts
from netvigil.operators.hosts import exclude_listed, only_listed
from netvigil.schema import RAW_SCHEMA

DEFAULT_POLICY = "Hard Drop & BGP Null-Route"


def stream_raw_flows(spark: SparkSession, folder: str, files_per_batch: int = 1000) -> DataFrame:
    """Raw CSV logs as they arrive in a folder; a backlog is worked off in bounded batches.

    Headers must list the raw columns in their order; other files are an error.
    """
    reader = spark.readStream.schema(RAW_SCHEMA).option("header", True).option("enforceSchema", False)
    return reader.option("maxFilesPerTrigger", files_per_batch).csv(folder)


def clean_stream(raw: DataFrame) -> DataFrame:
    """Row-wise cleaning: typing, validity and time parts (no de-duplication)."""
    return with_time_parts(valid_flows(typed_flows(raw)))


def run_to_table(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Append everything available to a Parquet table, each row exactly once."""
    (
        stream.writeStream.format("parquet").outputMode("append")
        .option("checkpointLocation", checkpoint).trigger(availableNow=True)
        .start(path).awaitTermination()
    )


def run_batches(stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    query: StreamingQuery = (
        stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()


def batch_folder(path: str, batch_id: int) -> str:
    """A repeated batch overwrites its own folder, so a retry leaves no double rows."""
    return f"{path}/batch={batch_id}"


def incident_records(blocked: DataFrame, policy: str = DEFAULT_POLICY) -> DataFrame:
    """Audit record of every blocked flow, dated by the flow."""
    return with_technique(blocked).select(
        "source_ip", "technique_id", F.lit(policy).alias("action_taken"), "timestamp",
        F.lit("ENFORCED").alias("status"),
    )


def run_allowed(flows: DataFrame, blacklist_path: str, path: str, checkpoint: str) -> None:
    """Write the streamed flows that pass the blacklist; the list is read anew for every micro-batch."""

    def write(batch: DataFrame, batch_id: int) -> None:
        blacklist = batch.sparkSession.read.parquet(blacklist_path)
        exclude_listed(batch, blacklist).write.mode("overwrite").parquet(batch_folder(path, batch_id))

    run_batches(flows, write, checkpoint)


def run_incident_audit(
    flows: DataFrame, blacklist_path: str, path: str, checkpoint: str, policy: str = DEFAULT_POLICY
) -> None:
    """Write an incident for every streamed flow whose source is blacklisted when its micro-batch runs."""

    def write(batch: DataFrame, batch_id: int) -> None:
        blocked = only_listed(batch, batch.sparkSession.read.parquet(blacklist_path))
        incident_records(blocked, policy).write.mode("overwrite").parquet(batch_folder(path, batch_id))

    run_batches(flows, write, checkpoint)


def score_stream(flows: DataFrame, model: PipelineModel) -> DataFrame:
    """Prediction records of a flow stream."""
    return name_predictions(model.transform(flows), class_labels(model))


def run_entropy_counts(flows: DataFrame, path: str, checkpoint: str, width: str = "1 hour") -> None:
    """Write every micro-batch's packet-length counts per window to a folder of its own.

    Counts add up, so no state is kept and no window is ever closed: late rows
    count in their window, and a repeated batch replaces its own folder.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        symbol_counts(batch, width).write.mode("overwrite").parquet(batch_folder(path, batch_id))

    run_batches(flows, write, checkpoint)


def read_entropy(spark: SparkSession, path: str) -> DataFrame:
    """Entropy of every window from the counts written so far."""
    counts = spark.read.parquet(path).groupBy("window_start", "packet_length").agg(F.sum("n").alias("n"))
    return entropy_of(counts).select("window_start", "flows", "distinct_lengths", rounded(F.col("h")).alias("entropy"))
