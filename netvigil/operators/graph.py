"""Attack graph derived from flows. Inputs: flows or a pair rollup.

Vertices are hosts, edges are attack relations. Paths over a pivot are kept as
their two sets of hops instead of being multiplied out: a pivot with a million
attackers and a million targets takes two million rows, not a trillion.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netvigil.functions.measures import Measures, as_double
from netvigil.operators.distributions import GIB
from netvigil.operators.graph_depth import graph_depth
from netvigil.operators.hosts import attack_flows
from netvigil.session import materialize

ADVERSARY, PIVOT, TARGET = "Adversary", "Pivot", "Target"


def graph_edges(table: DataFrame) -> DataFrame:
    """Weighted edges per (source, destination, class)."""
    m = Measures(table)
    return attack_flows(table).groupBy("source_ip", "destination_ip", "attack_type").agg(
        m.flows().alias("flows"), F.round(as_double(m.total("total_bytes")) / GIB, 6).alias("bytes_gb")
    )


def host_links(table: DataFrame) -> DataFrame:
    """Distinct attack links between two hosts with their flow count."""
    m = Measures(table)
    return attack_flows(table).groupBy("source_ip", "destination_ip").agg(m.flows().alias("flows"))


def graph_degree(links: DataFrame) -> DataFrame:
    """In- and out-degree and role of every host, in one shuffle.

    Each link contributes one half-edge to both its ends; the halves are summed
    on the map side, so a heavily attacked host costs one row per task.
    """
    halves = links.select(
        F.explode(F.array(
            F.struct(F.col("source_ip").alias("host"), F.lit(0).alias("i"), F.lit(1).alias("o")),
            F.struct(F.col("destination_ip").alias("host"), F.lit(1).alias("i"), F.lit(0).alias("o")),
        )).alias("half")
    ).select("half.*")
    degrees = halves.groupBy("host").agg(
        F.sum("i").alias("in_degree"), F.sum("o").alias("out_degree")
    )
    role = (
        F.when(F.col("in_degree") == 0, ADVERSARY).when(F.col("out_degree") == 0, TARGET).otherwise(PIVOT)
    )
    return degrees.withColumn("role", role)


def walks() -> Column:
    return F.col("in_degree").cast("double") * F.col("out_degree").cast("double")


def graph_pivots(degree: DataFrame) -> DataFrame:
    """Hosts that are attacked and attack others, with the number of two-hop walks over them.

    A walk may use a self-loop or return to where it came from; ``lateral_paths`` has neither. The number is a
    double, exact up to 2**53, so that no degrees overflow it.
    """
    return degree.where((F.col("in_degree") > 0) & (F.col("out_degree") > 0)).select(
        "host", "in_degree", "out_degree",
        walks().alias("two_hop_walks"),
    )


def graph_summary(links: DataFrame) -> DataFrame:
    """Vertices, links, pivots, two-hop walks, and the largest level of a host (see ``graph_depth``)."""
    links = materialize(links, "links")
    degree = graph_degree(links)
    pivot = (F.col("in_degree") > 0) & (F.col("out_degree") > 0)
    totals = degree.agg(
        F.count(F.lit(1)).alias("vertices"),
        F.coalesce(F.sum("out_degree"), F.lit(0)).alias("edges"),
        F.count_if(pivot).alias("pivots"),
        F.coalesce(F.sum(walks()), F.lit(0.0)).alias("two_hop_walks"),
    )
    return totals.withColumn("max_depth", F.lit(graph_depth(links).first()["max_depth"]))


def pivot_hosts(degree: DataFrame) -> DataFrame:
    """The pivots as a written table.

    Adaptive execution splits a hot key only where both join inputs come
    straight from a shuffle. Joined as an aggregate, the pivots would bring
    their own partitioning along and leave a hot host in one task.
    """
    return materialize(graph_pivots(degree).select("host"), "pivots")


def label_edges(edges: DataFrame, degree: DataFrame) -> DataFrame:
    """Edges with the roles of both ends.

    Every source has an outgoing link and every destination an incoming one, so
    only the pivots have to be looked up; their set is far smaller than the
    vertex table. It is written before the joins.
    """
    pivots = pivot_hosts(degree).select("host", F.lit(True).alias("pivot"))
    by_source = pivots.select(F.col("host").alias("source_ip"), F.col("pivot").alias("source_pivot"))
    by_target = pivots.select(F.col("host").alias("destination_ip"), F.col("pivot").alias("target_pivot"))
    joined = edges.join(by_source, "source_ip", "left").join(by_target, "destination_ip", "left")
    return joined.select(
        "source_ip", "destination_ip", "attack_type", "flows", "bytes_gb",
        F.when(F.col("source_pivot"), PIVOT).otherwise(ADVERSARY).alias("source_role"),
        F.when(F.col("target_pivot"), PIVOT).otherwise(TARGET).alias("destination_role"),
    )


def lateral_hops(links: DataFrame, degree: DataFrame) -> DataFrame:
    """All two-hop paths in factored form: per pivot its ingress and its egress hops.

    Any ingress peer followed by any egress peer of the same pivot is a path.
    The set of pivots is written before the join.
    """
    hops = links.select(
        "flows",
        F.explode(F.array(
            F.struct(F.col("destination_ip").alias("pivot"), F.lit("ingress").alias("hop"),
                     F.col("source_ip").alias("peer")),
            F.struct(F.col("source_ip").alias("pivot"), F.lit("egress").alias("hop"),
                     F.col("destination_ip").alias("peer")),
        )).alias("h"),
    ).select("h.*", "flows")
    pivots = pivot_hosts(degree).select(F.col("host").alias("pivot"))
    return hops.join(pivots, "pivot", "left_semi")


def lateral_paths(links: DataFrame, sources: list[str]) -> DataFrame:
    """All two-hop paths source -> pivot -> asset of the named sources, written out.

    A source meets each link of a pivot at most once, so the result grows with
    the links, times the number of sources named. Hosts never repeat within a
    path. ``lateral_hops`` has the paths of all sources in factored form.
    """
    first = links.where(F.col("source_ip").isin(sources)).select(
        "source_ip", F.col("destination_ip").alias("pivot"), F.col("flows").alias("ingress_flows")
    )
    second = links.select(
        F.col("source_ip").alias("pivot"), F.col("destination_ip").alias("asset"),
        F.col("flows").alias("egress_flows"),
    )
    source, pivot, asset = F.col("source_ip"), F.col("pivot"), F.col("asset")
    return first.join(second, "pivot").where(
        (source != pivot) & (pivot != asset) & (source != asset)
    ).select("source_ip", "pivot", "asset", "ingress_flows", "egress_flows")
