"""Rule-based verdicts: alert severity, threshold classifier, entropy flags."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Confidence limits (strict) and the severities on both sides of them.
SEVERITY_RULES = {
    "PortScan": (75.0, "Medium", "Low"),
    "Botnet": (70.0, "High", "Medium"),
    "BruteForce": (70.0, "High", "Medium"),
}
OTHER_SEVERITY_RULE = (80.0, "Critical", "High")

# Class -> (confidence, tier, action) reported by the threshold classifier.
RULE_VERDICTS = {
    "DDoS": (98.6, "Critical", "BGP Flowspec Rate-Limit and Drop"),
    "PortScan": (96.8, "Medium", "TCP SYN Cookie Challenge & Firewall Drop"),
    "BruteForce": (95.2, "High", "Endpoint Account Lockdown & Source Throttling"),
    "BENIGN": (99.4, "Low", "Normal Business Routing"),
    "Botnet": (93.1, "High", "C2 Domain Isolation & Host Quarantine"),
}

# Entropy baseline and flag limits.
ENTROPY_BASELINE, ENTROPY_SPREAD = 4.20, 0.65
COLLAPSE_BELOW, SPIKE_ABOVE = 1.8, 7.3
STABLE_FROM, STABLE_TO = 3.5, 4.8
FLAG_COLLAPSE = "CRITICAL ANOMALY: Entropy Collapse"
FLAG_SPIKE = "CRITICAL ANOMALY: Pseudo-Random Spike"
FLAG_STABLE = "NORMAL BASELINE: Verified Stable"
FLAG_DRIFT = "WARNING: Moderate Entropy Drift"


def alert_severity(attack_type: Column, confidence: Column) -> Column:
    """Severity of a predicted class given its confidence in percent."""

    def by_limit(rule: tuple[float, str, str]) -> Column:
        limit, above, otherwise = rule
        return F.when(confidence > limit, above).otherwise(otherwise)

    verdict = F.when(attack_type == "BENIGN", F.lit("Low"))
    for name, rule in SEVERITY_RULES.items():
        verdict = verdict.when(attack_type == name, by_limit(rule))
    return verdict.otherwise(by_limit(OTHER_SEVERITY_RULE))


def threshold_class() -> Column:
    """Class of a flow from its size, duration and protocol; the first match wins."""
    size, packets = F.col("total_bytes"), F.col("packet_count")
    duration, protocol = F.col("flow_duration"), F.col("protocol")
    return (
        F.when((size > 1_200_000) | (packets > 600), "DDoS")
        .when((duration < 15_000) & (packets > 100), "PortScan")
        .when((size > 500_000) & (protocol == "TCP"), "BruteForce")
        .when((packets < 50) & (size < 50_000), "BENIGN")
        .otherwise("Botnet")
    )


def entropy_z(entropy: Column) -> Column:
    return F.round(F.abs(entropy - ENTROPY_BASELINE) / ENTROPY_SPREAD, 2)


def entropy_flag(entropy: Column) -> Column:
    return (
        F.when(entropy < COLLAPSE_BELOW, FLAG_COLLAPSE)
        .when(entropy > SPIKE_ABOVE, FLAG_SPIKE)
        .when(entropy.between(STABLE_FROM, STABLE_TO), FLAG_STABLE)
        .otherwise(FLAG_DRIFT)
    )
