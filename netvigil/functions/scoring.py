"""Severity, attack weight and risk expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from netvigil.schema import BENIGN

# Scoring tables.
SEVERITY_SCORE = {"Critical": 4, "High": 3, "Medium": 2}
SEVERITY_SCORE_DEFAULT = 1
SEVERITY_RANK = {"Critical": 0, "High": 1, "Medium": 2, "Low": 3}
ATTACK_WEIGHT = {"DDoS": 40, "Botnet": 30, "BruteForce": 25, "PortScan": 15}
FREQUENCY_CAP, DISPERSION_CAP, POINTS_PER_UNIT = 40, 20, 4
CLEAN_SOURCE_SCORE, MAX_SCORE = 10, 100
TIER_FLOORS = [(76, "Critical"), (51, "High"), (26, "Medium")]
LOWEST_TIER = "Low"
TIER_ACTION = {
    "Critical": "Auto-Block & Quarantine",
    "High": "Active Firewall Throttle",
    "Medium": "Rate-limit & Deep Inspection",
    "Low": "Standard Network Monitoring",
}


def choose(key: Column, table: dict, default) -> Column:
    """Look ``key`` up in a small literal table; unknown and NULL keys get ``default``."""
    cases = F
    for name, value in table.items():
        cases = cases.when(key == name, F.lit(value))
    return cases.otherwise(F.lit(default))


def is_attack() -> Column:
    return F.col("attack_type") != BENIGN


def is_benign() -> Column:
    return F.col("attack_type") == BENIGN


def severity_score() -> Column:
    return choose(F.col("severity"), SEVERITY_SCORE, SEVERITY_SCORE_DEFAULT)


def severity_rank() -> Column:
    """Sort position of a severity name, NULL when it is not a known one."""
    return choose(F.col("severity"), SEVERITY_RANK, None)


def attack_weight() -> Column:
    return choose(F.col("attack_type"), ATTACK_WEIGHT, 0)


def risk_score(attacks: Column, max_weight: Column, destinations: Column) -> Column:
    """0 to 100: capped attack frequency + worst attack weight + capped target spread.

    A source without attacks scores exactly the clean-source value, whatever
    the number of hosts it talks to.
    """
    frequency = F.least(F.lit(FREQUENCY_CAP).cast("long"), attacks * POINTS_PER_UNIT)
    dispersion = F.least(F.lit(DISPERSION_CAP).cast("long"), destinations * POINTS_PER_UNIT)
    composed = F.least(F.lit(MAX_SCORE).cast("long"), frequency + max_weight + dispersion)
    return F.when(attacks == 0, F.lit(CLEAN_SOURCE_SCORE).cast("long")).otherwise(composed)


def risk_tier(score: Column) -> Column:
    cases = F
    for floor, name in TIER_FLOORS:
        cases = cases.when(score >= floor, name)
    return cases.otherwise(LOWEST_TIER)


def tier_action(tier: Column) -> Column:
    return choose(tier, TIER_ACTION, TIER_ACTION[LOWEST_TIER])
