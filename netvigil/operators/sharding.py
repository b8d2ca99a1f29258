"""Hash distribution of flow logs by source address."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netvigil.functions.hashing import md5_mod
from netvigil.session import materialize
from netvigil.operators.distributions import share_of_all


def shard_of(source_ip: Column, shards: int) -> Column:
    return md5_mod(source_ip, shards).cast("int")


def partition_balance(flows: DataFrame, shards: int = 2) -> DataFrame:
    """Records per shard and their share."""
    sized = flows.groupBy(shard_of(F.col("source_ip"), shards).alias("shard")).agg(
        F.count(F.lit(1)).alias("documents")
    )
    return sized.select("shard", "documents", share_of_all("documents", 1).alias("pct")).orderBy("shard")


def write_sharded(flows: DataFrame, path: str, shards: int, writers_per_shard: int | None = None) -> None:
    """Write one folder per shard.

    Without ``writers_per_shard`` the session's shuffle partitions are shared out among the shards.

    All records of a source land in its shard, but each shard is written by
    several tasks, so a source that holds most of the records does not end up
    in a single writer.
    """
    if writers_per_shard is None:
        writers_per_shard = max(1, int(flows.sparkSession.conf.get("spark.sql.shuffle.partitions")) // shards)
    spread = F.pmod(F.xxhash64("destination_ip", "timestamp", "total_bytes"), F.lit(writers_per_shard))
    placed = flows.withColumn("shard", shard_of(F.col("source_ip"), shards))
    placed.repartition(shards * writers_per_shard, "shard", spread).write.partitionBy("shard").parquet(path)


def write_bucketed(flows: DataFrame, table: str, path: str, buckets: int | None = None) -> DataFrame:
    """A table bucketed by source address: later joins and aggregates on the source need no shuffle.

    A bucket holds all records of its sources, so a dominant source makes a
    large bucket; for such logs ``write_salted`` spreads it over buckets.
    """
    spark = flows.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    flows.repartition(buckets, "source_ip").write.bucketBy(buckets, "source_ip").sortBy("source_ip").mode(
        "overwrite").option("path", path).saveAsTable(table)
    return spark.table(table)


# Sources that the sketch names at most, and counters that it keeps per task: its error is about rows / counters.
NAMED_SOURCES, COUNTERS = 256, 4096


def hot_sources(flows: DataFrame, buckets: int, key: str = "source_ip") -> DataFrame:
    """The keys with more rows than half a bucket has on average, at most ``NAMED_SOURCES``, as a written table.

    A mergeable sketch of bounded size finds them in one scan.
    """
    found = flows.agg(F.expr(f"approx_top_k({key}, {NAMED_SOURCES}, {COUNTERS})").alias("top"), F.count(F.lit(1)).alias("rows"))
    listed = found.select(F.explode("top").alias("top"), "rows").where(F.col("top.count") * (2 * buckets) > F.col("rows"))
    return materialize(listed.select(F.col("top.item").alias(key)), "hot")


def _bucketed(table: DataFrame, key: str, name: str, path: str, buckets: int) -> DataFrame:
    table.repartition(buckets, key, "salt").write.bucketBy(buckets, key, "salt").sortBy(key, "salt").mode("overwrite").option(
        "path", path).saveAsTable(name)
    return table.sparkSession.table(name)


def write_salted(flows: DataFrame, hot: DataFrame, name: str, path: str, buckets: int, salts: int, key: str = "source_ip") -> DataFrame:
    """A table bucketed by key and ``salt``, in which the rows of a hot key are spread over ``salts`` salts.

    All other keys have salt 0. ``hot`` has at most ``NAMED_SOURCES`` rows.
    """
    marked = flows.join(F.broadcast(hot.select(key, F.lit(True).alias("is_hot"))), key, "left")
    every = F.xxhash64(*[F.col(column) for column in flows.columns])
    salt = F.when(F.col("is_hot"), F.pmod(every, F.lit(salts))).otherwise(F.lit(0)).cast("int")
    return _bucketed(marked.withColumn("salt", salt).drop("is_hot"), key, name, path, buckets)


def write_salted_side(side: DataFrame, hot: DataFrame, name: str, path: str, buckets: int, salts: int,
                      key: str = "source_ip") -> DataFrame:
    """The other side of a join with a salted table: rows of hot keys once per salt, all others once.

    Both tables joined by key and ``salt`` need no shuffle, every row of the salted table meets what it would
    meet by the key alone, and a hot key is spread over tasks.
    """
    marked = side.join(F.broadcast(hot.select(key, F.lit(True).alias("is_hot"))), key, "left")
    given = F.when(F.col("is_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    return _bucketed(marked.withColumn("salt", F.explode(given)).drop("is_hot"), key, name, path, buckets)
