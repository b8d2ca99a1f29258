"""Row-wise verdict operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netvigil.functions.scoring import choose
from netvigil.functions.verdicts import RULE_VERDICTS, alert_severity, threshold_class
from netvigil.operators.distributions import percent
from netvigil.operators.hosts import leading_class


def rule_classifier(flows: DataFrame) -> DataFrame:
    """Class, confidence, tier and action of every flow by fixed thresholds."""
    judged = flows.withColumn("predicted_attack", threshold_class())
    verdict = F.col("predicted_attack")
    part = lambda i: choose(verdict, {k: v[i] for k, v in RULE_VERDICTS.items()}, None)
    return judged.select(
        "timestamp", "source_ip", "destination_ip", F.col("attack_type").alias("actual_attack"),
        "predicted_attack", part(0).alias("confidence"), part(1).alias("tier"), part(2).alias("action"),
    )


def source_severity(table: DataFrame) -> DataFrame:
    """Alert severity of every attacking source.

    The leading class of a source is the verdict, and its share of the source's
    attack flows is the confidence.
    """
    scored = leading_class(table).select(
        "source_ip", "top_attack_type", percent(F.col("flows"), F.col("attack_flows")).alias("confidence")
    )
    return scored.withColumn("severity", alert_severity(F.col("top_attack_type"), F.col("confidence")))
