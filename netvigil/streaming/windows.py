"""Packet-length counts per window, published once when the window is over and amended by late rows.

An event-time watermark closes windows. A window's counts are kept as state until
then, come out as ``final`` rows when it closes, and leave the state. Rows that
arrive for a closed window come out as ``late`` rows, so nothing is dropped: the
final rows are what can be published, and final and late rows together are all rows.

Rows are counted per Arrow batch before the shuffle, and the state is kept per
window and shard of the packet lengths, so a window that holds most of the data is
spread over tasks and reaches them as few rows. Every call between Spark and Python
costs about a millisecond: a shard makes one for all of its lengths.

The functions that run on executors travel by value, so a cluster needs no copy
of this package. Timers need the RocksDB state store, which a run sets for itself.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from netvigil.operators.entropy import entropy_of, rounded
from netvigil.session import RECOMMENDED_CONF
from netvigil.streaming.flows import run_to_table

cloudpickle.register_pickle_by_value(sys.modules[__name__])

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
FINAL, LATE = "final", "late"
PARTIAL = "start_ms long, end_ms long, packet_length long, n long"
COUNTED = "start_ms long, packet_length long, n long, kind string"
HEARTBEAT_SCHEMA = "timestamp timestamp"
SHARDS = 8


def partial_counts(batches: Iterator) -> Iterator:
    """Rows of every Arrow batch counted per window and length; heartbeats have no length."""
    import pyarrow as pa
    import pyarrow.compute as pc

    for batch in batches:
        rows = pa.Table.from_batches([batch.filter(pc.is_valid(batch.column(2)))])
        counted = rows.group_by(["start_ms", "end_ms", "packet_length"]).aggregate([("packet_length", "count")])
        yield from counted.rename_columns(["start_ms", "end_ms", "packet_length", "n"]).to_batches()


class WindowCounter(StatefulProcessor):
    """State per window and shard: its lengths and their rows so far, until the watermark passes the end of the window."""

    def init(self, handle) -> None:
        self.handle = handle
        self.counted = handle.getValueState("counted", "lengths array<long>, n array<long>")

    def handleInputRows(self, key, rows, timerValues) -> Iterator:  # noqa: N802, N803
        import pandas as pd

        start, end = int(key[0]), int(key[1])
        parts, known = list(rows), False
        late = end <= timerValues.getCurrentWatermarkInMs()
        if not late and self.counted.exists():
            known = True
            lengths, n = self.counted.get()
            parts.append(pd.DataFrame({"packet_length": list(lengths), "n": list(n)}))
        counts = pd.concat([part[["packet_length", "n"]] for part in parts]).groupby("packet_length")["n"].sum()
        if late:
            yield published(start, counts.index, counts.to_numpy(), LATE)
            return
        if not known:
            self.handle.registerTimer(end)
        self.counted.update((counts.index.tolist(), counts.tolist()))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator:  # noqa: N802, N803
        lengths, n = self.counted.get()
        self.counted.clear()
        yield published(int(key[0]), list(lengths), list(n), FINAL)

    def close(self) -> None:
        pass


def published(start: int, lengths, n, kind: str):
    import pandas as pd

    return pd.DataFrame({"start_ms": start, "packet_length": lengths, "n": n, "kind": kind})


def window_counts(flows: DataFrame, width: str = "1 hour", delay: str = "1 hour", heartbeats: DataFrame | None = None) -> DataFrame:
    """Final and late counts of a flow stream.

    ``heartbeats`` is a stream of bare timestamps that moves the watermark on where no flows arrive any more.
    Flows without a timestamp belong to no window.
    """
    rows = flows.select("timestamp", "packet_length")
    if heartbeats is not None:
        rows = rows.unionByName(heartbeats.select("timestamp", F.lit(None).cast("long").alias("packet_length")))
    window = F.window("timestamp", width)
    # As plain numbers the bounds do not carry the watermark along, by which rows that come late would be dropped unseen.
    # Heartbeats are dropped in Python only: a filter on the length would be moved below the watermark that they drive.
    bounded = rows.withWatermark("timestamp", delay).where("timestamp IS NOT NULL").select(
        F.unix_millis(window.start).alias("start_ms"), F.unix_millis(window.end).alias("end_ms"), "packet_length")
    partial = bounded.mapInArrow(partial_counts, PARTIAL).withColumn("shard", F.pmod(F.xxhash64("packet_length"), F.lit(SHARDS)))
    counted = partial.groupBy("start_ms", "end_ms", "shard").transformWithStateInPandas(
        WindowCounter(), COUNTED, "Append", "EventTime")
    return counted.select(F.timestamp_millis("start_ms").alias("window_start"), "packet_length", "n", "kind")


def run_window_counts(flows: DataFrame, path: str, checkpoint: str, width: str = "1 hour", delay: str = "1 hour",
                      heartbeats: DataFrame | None = None) -> None:
    """Append everything that can be published by now, each row exactly once; later runs go on where this one stopped."""
    conf = flows.sparkSession.conf
    before = conf.get(STATE_STORE)
    conf.set(STATE_STORE, RECOMMENDED_CONF[STATE_STORE])  # a stream keeps the settings that it started with
    try:
        run_to_table(window_counts(flows, width, delay, heartbeats), path, checkpoint)
    finally:
        conf.set(STATE_STORE, before)


def heartbeat_stream(spark: SparkSession, folder: str) -> DataFrame:
    return spark.readStream.schema(HEARTBEAT_SCHEMA).parquet(folder)


def send_heartbeat(spark: SparkSession, folder: str, timestamp: str) -> None:
    """Tell the streams that read ``folder`` that event time has come to ``timestamp``."""
    beat = spark.range(1).select(F.lit(timestamp).cast("timestamp").alias("timestamp"))
    beat.coalesce(1).write.mode("append").parquet(folder)


def read_window_entropy(spark: SparkSession, path: str) -> DataFrame:
    """Every published window: its entropy as published and as amended by what came late."""
    counts = spark.read.parquet(path)

    def entropy(rows: DataFrame, name: str) -> DataFrame:
        per_length = rows.groupBy("window_start", "packet_length").agg(F.sum("n").alias("n"))
        return entropy_of(per_length).select("window_start", "flows", "distinct_lengths", rounded(F.col("h")).alias(name))

    published = entropy(counts.where(F.col("kind") == FINAL), "published_entropy").select(
        "window_start", F.col("flows").alias("published_flows"), "published_entropy")
    return entropy(counts, "entropy").join(published, "window_start", "left").withColumn(
        "published_flows", F.coalesce("published_flows", F.lit(0)))
