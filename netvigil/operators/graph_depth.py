"""Levels and depth of attack graphs, found hop by hop from a frontier.

A host's level is the fewest hops over which an attack reaches it from an entry
point. Entry points are the hosts that no other host attacks; where only cycles
lead to a part of the graph, its entry points are those hosts that no
smaller-named host of the part reaches. A round follows the links of the hosts
found in the round before and of no others; every round is a written table, and
the search ends when a round finds nothing new. There are as many rounds as hops.

``by`` names columns that keep graphs apart (such as a time window); rows without
a value there belong to no graph. Links from a host to itself are no hops, and a
host that has no others has no level.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netvigil.session import fresh_path, materialize


def hops_of(links: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Distinct links between different hosts (``a`` attacks ``b``), written."""
    hops = links.where("source_ip <> destination_ip").dropna(subset=list(by) or None).select(
        *by, F.col("source_ip").alias("a"), F.col("destination_ip").alias("b")).distinct()
    return materialize(hops, "hops")


def hosts_of(hops: DataFrame, by: Sequence[str]) -> DataFrame:
    """Every host with whether it is attacked; the half-links merge on the map side."""
    ends = F.explode(F.array(F.struct(F.col("a").alias("host"), F.lit(0).alias("attacked")),
                             F.struct(F.col("b").alias("host"), F.lit(1).alias("attacked"))))
    return hops.select(*by, ends.alias("end")).select(*by, "end.*").groupBy(*by, "host").agg(F.max("attacked").alias("attacked"))


def spread(hops: DataFrame, entries: DataFrame, by: Sequence[str]) -> DataFrame:
    """(host, level) of all hosts that the entry points reach, the entry points themselves at level 0."""
    spark, path = hops.sparkSession, fresh_path(hops.sparkSession, "levels")
    schema = entries.select(*by, "host").withColumn("level", F.lit(0)).schema
    entries.select(*by, "host").write.parquet(f"{path}/level=0")
    depth = 0
    while True:
        reached = spark.read.schema(schema).parquet(path)
        frontier = spark.read.schema(entries.select(*by, "host").schema).parquet(f"{path}/level={depth}")
        if frontier.isEmpty():
            return reached
        found = hops.join(frontier.withColumnRenamed("host", "a"), [*by, "a"], "left_semi").select(
            *by, F.col("b").alias("host")).distinct()
        depth += 1
        found.join(reached, [*by, "host"], "left_anti").write.parquet(f"{path}/level={depth}")


def cycle_entries(hops: DataFrame, hosts: DataFrame, by: Sequence[str]) -> DataFrame:
    """The hosts that no smaller-named host reaches. Only hosts whose smallest known ancestor changed pass it on."""
    labels = materialize(hosts.select(*by, "host", F.col("host").alias("label")), "labels")
    changed = labels
    while True:
        sent = hops.join(changed.withColumnRenamed("host", "a"), [*by, "a"]).groupBy(
            *by, F.col("b").alias("host")).agg(F.min("label").alias("sent"))
        told = labels.join(sent, [*by, "host"], "left")
        less = F.coalesce(F.col("sent") < F.col("label"), F.lit(False))
        after = materialize(told.select(*by, "host", F.when(less, F.col("sent")).otherwise(F.col("label")).alias("label"),
                                        less.alias("moved")), "labels")
        labels, changed = after.drop("moved"), after.where("moved").drop("moved")
        if changed.isEmpty():
            return labels.where("label = host").select(*by, "host")


def graph_levels(links: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The level of every host (columns ``by``, ``host``, ``level``)."""
    hops = hops_of(links, by)
    hosts = materialize(hosts_of(hops, by), "hosts")
    levels = spread(hops, hosts.where("attacked = 0"), by)
    rest = materialize(hosts.join(levels, [*by, "host"], "left_anti").select(*by, "host"), "unreached")
    if rest.isEmpty():
        return levels
    among = hops.join(rest.withColumnRenamed("host", "a"), [*by, "a"], "left_semi").join(
        rest.withColumnRenamed("host", "b"), [*by, "b"], "left_semi").select(*hops.columns)
    among = materialize(among, "hops")
    return levels.unionByName(spread(among, cycle_entries(among, rest, by), by))


def graph_depth(links: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Per graph: its hosts, its entry points, and the largest level."""
    return graph_levels(links, by).groupBy(*by).agg(
        F.count(F.lit(1)).alias("hosts"), F.count_if(F.col("level") == 0).alias("entry_points"),
        F.coalesce(F.max("level"), F.lit(0)).alias("max_depth"))
