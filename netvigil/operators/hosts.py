"""Attacking and targeted hosts. Inputs: flows or a pair rollup."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from netvigil.functions.measures import Measures, as_double
from netvigil.functions.scoring import is_attack
from netvigil.operators.rollup import stored_pairs
from netvigil.schema import ATTACK_CLASSES

MIB = 2**20


def attack_flows(table: DataFrame) -> DataFrame:
    return table.where(is_attack())


def leading_class(table: DataFrame) -> DataFrame:
    """Attack totals of every source and the class it uses most (ties: first name).

    Flows are first summed per (source, class), so the most frequent class
    falls out of the same pass and no second scan or join is needed.
    """
    m = Measures(table)
    per_class = attack_flows(table).groupBy("source_ip", "attack_type").agg(
        m.flows().alias("n"), m.total("total_bytes").alias("bytes"), m.total("packet_length").alias("length")
    )
    per_source = per_class.groupBy("source_ip").agg(
        F.sum("n").alias("attack_flows"),
        F.sum("bytes").alias("bytes"),
        F.sum("length").alias("length"),
        F.count("attack_type").alias("classes"),
        F.min(F.struct((-F.col("n")).alias("rank"), "attack_type")).alias("leading"),
    )
    return per_source.select(
        "source_ip", "attack_flows", "bytes", "length", "classes",
        F.col("leading.attack_type").alias("top_attack_type"), (-F.col("leading.rank")).alias("flows"),
    )


def top_attacking_ips(table: DataFrame, n: int = 50) -> DataFrame:
    """The ``n`` sources with most attack flows and the class each uses most."""
    return leading_class(table).select(
        "source_ip",
        F.col("attack_flows").alias("attack_flow_count"),
        F.round(as_double(F.col("bytes")) / MIB, 4).alias("total_bytes_sent_mb"),
        F.col("classes").alias("unique_attack_types"),
        F.round(as_double(F.col("length")) / F.col("attack_flows"), 2).alias("avg_packet_length"),
        "top_attack_type",
    ).orderBy(F.desc("attack_flow_count"), "source_ip").limit(n)


def modal_attack_type(table: DataFrame) -> DataFrame:
    """Most frequent attack class of every source, with its count; ties go to the first name."""
    m = Measures(table)
    counted = attack_flows(table).groupBy("source_ip", "attack_type").agg(m.flows().alias("flows"))
    order = Window.partitionBy("source_ip").orderBy(F.desc("flows"), "attack_type")
    return counted.withColumn("place", F.row_number().over(order)).where("place = 1").select(
        "source_ip", F.col("attack_type").alias("top_attack_type"), "flows"
    )


def with_modal_type(per_source: DataFrame, modal: DataFrame) -> DataFrame:
    """Attach the most frequent class to any per-source table."""
    return per_source.join(modal.select("source_ip", "top_attack_type"), "source_ip", "left")


def top_targeted_ips(table: DataFrame, n: int = 50) -> DataFrame:
    """The ``n`` destinations with most attack flows, their attackers and classes.

    Attackers and classes are counted apart, both from one stored pair rollup, so that flows are read once.
    """
    table = stored_pairs(table)
    m = Measures(table)
    parts = attack_flows(table).groupBy("destination_ip", "source_ip", "attack_type").agg(
        m.flows().alias("n"), m.total("total_bytes").alias("bytes"))
    # Summed per attacker first, which spreads a hot destination; classes travel along as a set of few names.
    per_attacker = parts.groupBy("destination_ip", "source_ip").agg(F.sum("n").alias("n"), F.sum("bytes").alias("bytes"))
    attackers = per_attacker.groupBy("destination_ip").agg(
        F.sum("n").alias("attack_flow_count"), F.count("source_ip").alias("unique_attackers"), F.sum("bytes").alias("bytes"))
    per_class = parts.groupBy("destination_ip", "attack_type").agg(F.sum("n").alias("n"))
    classes = per_class.groupBy("destination_ip").agg(F.count("attack_type").alias("unique_attack_types"))
    return attackers.join(classes, "destination_ip").select(
        "destination_ip", "attack_flow_count", "unique_attackers", "unique_attack_types",
        F.round(as_double(F.col("bytes")) / MIB, 4).alias("total_bytes_received_mb"),
    ).orderBy(F.desc("attack_flow_count"), "destination_ip").limit(n)


def ip_attack_crosstab(table: DataFrame, top_ips: int = 20) -> DataFrame:
    """Attack flows per source and class for the ``top_ips`` busiest attackers, in long form.

    Whatever classes occur are there. A source's classes travel with its total, so one aggregate serves both.
    """
    m = Measures(table)
    per_class = attack_flows(table).groupBy("source_ip", "attack_type").agg(m.flows().alias("flows"))
    per_source = per_class.groupBy("source_ip").agg(
        F.sum("flows").alias("total"), F.collect_list(F.struct("attack_type", "flows")).alias("classes"))
    busiest = per_source.orderBy(F.desc("total"), "source_ip").limit(top_ips)
    return busiest.select("source_ip", F.inline("classes"))


def crosstab_columns(crosstab: DataFrame, classes: list[str] = ATTACK_CLASSES) -> DataFrame:
    """The long crosstab with a column per named class, zeros filled; all other classes add up in ``Other``."""
    def where(condition) -> Column:
        return F.sum(F.when(condition, F.col("flows")).otherwise(F.lit(0)))

    known = F.coalesce(F.col("attack_type").isin(classes), F.lit(False))
    return crosstab.groupBy("source_ip").agg(
        *[where(F.col("attack_type") == name).alias(name) for name in classes], where(~known).alias("Other"))


def exclude_listed(table: DataFrame, blacklist: DataFrame) -> DataFrame:
    """Flows whose source is not on the blacklist.

    The list may grow with the data, so it carries no broadcast hint: the
    optimizer broadcasts it when its measured size allows, and otherwise joins
    by shuffle, splitting a dominant source across tasks. For the split the
    list must be a written table, not an aggregate still to be computed.
    """
    return table.join(blacklist.select("source_ip"), "source_ip", "left_anti")


def only_listed(table: DataFrame, blacklist: DataFrame) -> DataFrame:
    """Flows whose source is on the blacklist."""
    return table.join(blacklist.select("source_ip"), "source_ip", "left_semi")
