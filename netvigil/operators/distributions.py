"""Shares of attack classes, protocols and severities. Inputs: flows or a profile rollup."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from netvigil.functions.measures import Measures, as_double
from netvigil.functions.scoring import is_attack, is_benign, severity_rank, severity_score

GIB = 2**30


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    return F.round(part / whole * 100, digits)


def share_of_all(count: str, digits: int = 2) -> Column:
    """Share of the grand total, taken over the already aggregated report rows."""
    return percent(F.col(count), F.sum(count).over(Window.partitionBy()), digits)


def attack_distribution(table: DataFrame) -> DataFrame:
    """Volume, share and averages per attack class.

    ``avg_flow_duration_ms`` averages the raw duration field, which is in
    microseconds; name and value are kept for compatibility.
    """
    m = Measures(table)
    grouped = table.groupBy("attack_type").agg(
        m.flows().alias("total_flows"),
        F.round(m.mean_of(severity_score()), 2).alias("avg_severity_score"),
        F.round(m.mean("flow_duration"), 2).alias("avg_flow_duration_ms"),
        F.round(m.mean("packet_length"), 2).alias("avg_packet_length"),
        F.round(as_double(m.total("total_bytes")) / GIB, 6).alias("total_bytes_gb"),
    )
    return grouped.select(
        "attack_type", "total_flows", share_of_all("total_flows").alias("pct_share"),
        "avg_severity_score", "avg_flow_duration_ms", "avg_packet_length", "total_bytes_gb",
    ).orderBy(F.desc("total_flows"), "attack_type")


def protocol_distribution(table: DataFrame) -> DataFrame:
    m = Measures(table)
    grouped = table.groupBy("protocol").agg(
        m.flows().alias("total_flows"),
        m.flows_where(is_attack()).alias("attack_count"),
        m.flows_where(is_benign()).alias("benign_count"),
    )
    return grouped.select(
        "protocol", "total_flows", share_of_all("total_flows").alias("pct_share"),
        "attack_count", "benign_count",
    ).orderBy(F.desc("total_flows"), "protocol")


def severity_distribution(table: DataFrame) -> DataFrame:
    m = Measures(table)
    grouped = table.groupBy("severity").agg(m.flows().alias("total_flows"))
    return grouped.select(
        "severity", "total_flows", share_of_all("total_flows").alias("pct_share")
    ).orderBy(F.desc("total_flows"), "severity")


def severity_ranked(distribution: DataFrame) -> DataFrame:
    """Severity report from the most to the least severe level; unknown levels last."""
    return distribution.withColumn("severity_rank", severity_rank()).orderBy(
        F.col("severity_rank").asc_nulls_last(), "severity"
    )


def attack_overview(distribution: DataFrame) -> DataFrame:
    """Attack report under presentation headings."""
    headings = {
        "attack_type": "Attack Vector",
        "total_flows": "Telemetry Flows",
        "pct_share": "Traffic Share (%)",
        "avg_severity_score": "Severity Score (1-4)",
        "total_bytes_gb": "Bandwidth Consumed (GB)",
    }
    return distribution.select(*[F.col(name).alias(title) for name, title in headings.items()])


def bandwidth_rank(distribution: DataFrame) -> DataFrame:
    """Attack classes by transferred volume, smallest first."""
    return distribution.select("attack_type", "total_bytes_gb").orderBy("total_bytes_gb", "attack_type")


def kpi_overview(table: DataFrame) -> DataFrame:
    """Total, attack and clean flows, attack rate and number of scored sources; one pass.

    ``table`` is the flow table or the pair rollup (both carry ``source_ip``).
    """
    m = Measures(table)
    per_source = table.groupBy("source_ip").agg(
        m.flows().alias("flows"), m.flows_where(is_attack()).alias("attacks")
    )
    totals = per_source.agg(
        F.coalesce(F.sum("flows"), F.lit(0)).alias("total_flows"),
        F.coalesce(F.sum("attacks"), F.lit(0)).alias("attack_flows"),
        F.count(F.lit(1)).alias("scored_actors"),
    )
    total, attacks = F.col("total_flows"), F.col("attack_flows")
    return totals.select(
        total, attacks, (total - attacks).alias("clean_flows"),
        F.round(F.try_divide(attacks, total) * 100, 1).alias("attack_rate"), "scored_actors",
    )


def distinct_values(table: DataFrame, column: str) -> DataFrame:
    """Sorted values of a filter menu, without NULL."""
    return table.select(column).where(F.col(column).isNotNull()).distinct().orderBy(column)
