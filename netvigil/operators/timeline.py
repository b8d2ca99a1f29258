"""Hourly, daily and six-hour attack reports. Inputs: flows or a profile rollup."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netvigil.functions.measures import Measures
from netvigil.functions.scoring import is_attack, is_benign
from netvigil.functions.temporal import day_name, surge_window
from netvigil.operators.distributions import percent


def attack_rate():
    return percent(F.col("attack_flows"), F.col("total_flows")).alias("attack_rate_pct")


def hourly_timeline(table: DataFrame) -> DataFrame:
    """Total, attack and benign flows per hour with the mean duration."""
    m = Measures(table)
    grouped = table.groupBy("hour").agg(
        m.flows().alias("total_flows"),
        m.flows_where(is_attack()).alias("attack_flows"),
        m.flows_where(is_benign()).alias("benign_flows"),
        F.round(m.mean("flow_duration"), 2).alias("avg_flow_duration_ms"),
    )
    return grouped.select("*", attack_rate()).orderBy("hour")


def hourly_attack_intensity(table: DataFrame) -> DataFrame:
    """The hourly report without durations; the unused mean is pruned from the plan."""
    return hourly_timeline(table).drop("avg_flow_duration_ms")


def daily_cadence(table: DataFrame) -> DataFrame:
    """Attack flows per weekday and the number of classes seen (benign included)."""
    m = Measures(table)
    per_class = table.groupBy("day_of_week", "attack_type").agg(m.flows().alias("n"))
    grouped = per_class.groupBy("day_of_week").agg(
        F.sum("n").alias("total_flows"),
        F.sum(F.when(is_attack(), F.col("n")).otherwise(F.lit(0))).alias("attack_flows"),
        F.count("attack_type").alias("unique_attack_types"),
    )
    return grouped.select(
        "*", day_name(F.col("day_of_week")).alias("day_name"), attack_rate()
    ).orderBy("day_of_week")


def surge_windows(table: DataFrame) -> DataFrame:
    """The four six-hour windows, most attacked first."""
    m = Measures(table)
    grouped = table.groupBy(surge_window(F.col("hour")).alias("surge_window")).agg(
        m.flows().alias("total_flows"), m.flows_where(is_attack()).alias("attack_flows")
    )
    return grouped.select("*", attack_rate()).orderBy(F.desc("attack_flows"), "surge_window")
