"""Risk score of every source address. Inputs: flows or a pair rollup."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netvigil.functions.measures import Measures, as_double
from netvigil.functions.scoring import attack_weight, is_attack, risk_score, risk_tier, tier_action
from netvigil.operators.rollup import stored_pairs


def risk_order():
    return [F.desc("risk_score"), F.desc("attack_count"), F.asc("source_ip")]


def ip_risk_scores(table: DataFrame, ordered: bool = True) -> DataFrame:
    """Flows, attacks, destinations, 0-100 score, tier and action per source.

    Flows are summed per (source, destination) first; the number of pairs of a
    source is then its number of distinct destinations, so a dominant source is
    spread over many reducers and no row is expanded. All destinations count,
    not only attacked ones. ``ordered=False`` saves the global sort.
    """
    m = Measures(table)
    pairs = table.groupBy("source_ip", "destination_ip").agg(
        m.flows().alias("n"),
        m.flows_where(is_attack()).alias("attacks"),
        F.max(attack_weight()).alias("weight"),
    )
    signals = pairs.groupBy("source_ip").agg(
        F.sum("n").alias("total_flows"),
        F.sum("attacks").alias("attack_count"),
        F.count("destination_ip").alias("unique_destinations"),
        F.max("weight").alias("weight"),
    )
    score = risk_score(F.col("attack_count"), F.col("weight"), F.col("unique_destinations"))
    scored = signals.withColumn("risk_score", score).withColumn("risk_level", risk_tier(F.col("risk_score")))
    result = scored.select(
        "source_ip", "total_flows", "attack_count", "unique_destinations", "risk_score",
        "risk_level", tier_action(F.col("risk_level")).alias("recommended_action"),
    )
    return result.orderBy(*risk_order()) if ordered else result


def ip_risk_signals(table: DataFrame) -> DataFrame:
    """The signals behind the score, with class diversity and mean flow size, from one stored pair rollup."""
    table = stored_pairs(table)
    m = Measures(table)
    parts = table.groupBy("source_ip", "destination_ip", "attack_type").agg(
        m.flows().alias("n"), m.total("total_bytes").alias("bytes"))
    pairs = parts.groupBy("source_ip", "destination_ip").agg(
        F.sum("n").alias("n"), F.sum("bytes").alias("bytes"),
        F.sum(F.when(is_attack(), F.col("n")).otherwise(F.lit(0))).alias("attacks"))
    hosts = pairs.groupBy("source_ip").agg(
        F.sum("n").alias("total_flows"), F.sum("attacks").alias("attack_count"),
        F.count("destination_ip").alias("unique_destinations"), F.sum("bytes").alias("bytes"))
    classes = parts.groupBy("source_ip", "attack_type").agg(F.sum("n").alias("n")).groupBy("source_ip").agg(
        F.count("attack_type").alias("unique_attack_types"), F.max(attack_weight()).alias("max_severity_weight"))
    return hosts.join(classes, "source_ip").select(
        "source_ip", "total_flows", "attack_count", "unique_destinations", "unique_attack_types", "max_severity_weight",
        F.round(as_double(F.col("bytes")) / F.col("total_flows"), 2).alias("avg_bytes_per_flow"),
    )


def top_risk_actors(risk: DataFrame, n: int) -> DataFrame:
    return risk.orderBy(*risk_order()).limit(n)


def lookup_ip(risk: DataFrame, ip: str) -> DataFrame:
    """Profile of one address; empty when it was never observed."""
    return risk.where(F.col("source_ip") == ip)


def risk_bounds(risk: DataFrame) -> DataFrame:
    """Lowest and highest score and the number of tiers in use."""
    return risk.agg(
        F.min("risk_score").alias("min_score"),
        F.max("risk_score").alias("max_score"),
        F.count_distinct("risk_level").alias("tiers"),
        F.count(F.lit(1)).alias("sources"),
    )


def reputation_export(risk: DataFrame) -> DataFrame:
    """All sources, stamped with the time of the export."""
    return risk.withColumn("updated_at", F.current_timestamp())
