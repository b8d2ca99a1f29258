"""Data-quality report: one aggregate pass per table, one row per check."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netvigil.functions.scoring import risk_tier, tier_action
from netvigil.schema import METRICS


def outside(column: str, low, high) -> Column:
    """True for values beyond the range; NULL is a separate matter and does not count."""
    return ~F.col(column).between(low, high)


def flow_checks() -> dict[str, Column]:
    checks = {
        f"{name}_missing": F.col(name).isNull() | (F.col(name) == "")
        for name in ("source_ip", "destination_ip", "attack_type")
    }
    checks |= {f"{name}_negative": F.col(name) < 0 for name in METRICS}
    checks["protocol_not_upper"] = F.col("protocol") != F.upper("protocol")
    checks["hour_out_of_range"] = outside("hour", 0, 23)
    checks["day_of_week_out_of_range"] = outside("day_of_week", 1, 7)
    return checks


def risk_checks() -> dict[str, Column]:
    return {
        "risk_score_out_of_range": outside("risk_score", 0, 100),
        "risk_level_disagrees": F.col("risk_level") != risk_tier(F.col("risk_score")),
        "action_disagrees": F.col("recommended_action") != tier_action(F.col("risk_level")),
    }


def rate_checks() -> dict[str, Column]:
    return {
        "attack_rate_out_of_range": outside("attack_rate_pct", 0, 100),
        "flows_do_not_add_up": F.col("attack_flows") + F.col("benign_flows") != F.col("total_flows"),
    }


def check_table(table: DataFrame, name: str, checks: dict[str, Column]) -> DataFrame:
    """Number of rows of ``table`` that violate each check."""
    counted = table.agg(
        F.count(F.lit(1)).alias("checked_rows"),
        *[F.count_if(F.coalesce(bad, F.lit(False))).alias(check) for check, bad in checks.items()],
    )
    return counted.unpivot("checked_rows", list(checks), "check_name", "violations").select(
        F.lit(name).alias("table_name"), "check_name", "checked_rows", "violations",
        (F.col("violations") == 0).alias("passed"),
    )


def quality_report(flows: DataFrame, risk: DataFrame, timeline: DataFrame) -> DataFrame:
    reports = [
        check_table(flows, "flows", flow_checks()),
        check_table(risk, "ip_risk_scores", risk_checks()),
        check_table(timeline, "hourly_timeline", rate_checks()),
    ]
    return reduce(DataFrame.unionByName, reports)
