"""Column expressions against plain Python."""

import hashlib

import pytest
from pyspark.sql import functions as F

from netvigil.functions import hashing, scoring, temporal, verdicts


def evaluate(spark, column, rows, schema):
    frame = spark.createDataFrame(rows, schema).withColumn("result", column)
    return [r["result"] for r in frame.collect()]


def test_md5_modulo_matches_big_integers(spark):
    texts = ["10.0.0.1", "", "172.16.1.9", "x" * 300, "ünïcode"]
    for modulus in (1, 2, 7, 100, 70_000, 2**31 - 1):
        got = evaluate(spark, hashing.md5_mod(F.col("t"), modulus), [(t,) for t in texts], "t string")
        assert got == [int(hashlib.md5(t.encode()).hexdigest(), 16) % modulus for t in texts]


def test_md5_modulo_rejects_large_modulus():
    with pytest.raises(ValueError):
        hashing.md5_mod(F.lit("x"), 2**31)


@pytest.mark.parametrize("attack,confidence,expected", [
    ("BENIGN", 95.0, "Low"), ("DDoS", 85.0, "Critical"), ("DDoS", 80.0, "High"), ("DDoS", 65.0, "High"),
    ("PortScan", 80.0, "Medium"), ("PortScan", 75.0, "Low"), ("PortScan", 50.0, "Low"),
    ("Botnet", 75.0, "High"), ("Botnet", 70.0, "Medium"), ("BruteForce", 70.01, "High"),
    ("Unknown_5", 80.5, "Critical"), ("Unknown_5", 10.0, "High"),
])
def test_alert_severity(spark, attack, confidence, expected):
    column = verdicts.alert_severity(F.col("a"), F.col("c"))
    assert evaluate(spark, column, [(attack, confidence)], "a string, c double") == [expected]


@pytest.mark.parametrize("size,packets,duration,protocol,expected", [
    (1_200_001, 1, 1, "UDP", "DDoS"), (1, 601, 1, "UDP", "DDoS"), (1_200_000, 600, 14_999, "TCP", "PortScan"),
    (500_001, 100, 1, "TCP", "BruteForce"), (500_001, 100, 1, "UDP", "Botnet"), (49_999, 49, 50_000, "TCP", "BENIGN"),
    (50_000, 49, 50_000, "TCP", "Botnet"),
])
def test_threshold_class(spark, size, packets, duration, protocol, expected):
    rows = [(size, packets, duration, protocol)]
    schema = "total_bytes long, packet_count long, flow_duration long, protocol string"
    assert evaluate(spark, verdicts.threshold_class(), rows, schema) == [expected]


def test_severity_score_defaults_to_one(spark):
    rows = [("Critical",), ("High",), ("Medium",), ("Low",), (None,), ("odd",)]
    assert evaluate(spark, scoring.severity_score(), rows, "severity string") == [4, 3, 2, 1, 1, 1]


@pytest.mark.parametrize("attacks,weight,destinations,score,tier", [
    (0, 0, 9, 10, "Low"), (10, 40, 5, 100, "Critical"), (1, 15, 1, 23, "Low"), (3, 30, 1, 46, "Medium"),
    (5, 30, 1, 54, "High"), (50, 40, 50, 100, "Critical"), (4, 40, 5, 76, "Critical"), (4, 15, 5, 51, "High"),
])
def test_risk_score(spark, attacks, weight, destinations, score, tier):
    column = scoring.risk_score(F.col("a"), F.col("w"), F.col("d"))
    assert evaluate(spark, column, [(attacks, weight, destinations)], "a long, w int, d long") == [score]
    assert evaluate(spark, scoring.risk_tier(F.col("s")), [(score,)], "s long") == [tier]


def test_surge_window_and_day_name(spark):
    hours = [(0,), (5,), (6,), (11,), (12,), (17,), (18,), (23,), (None,)]
    assert evaluate(spark, temporal.surge_window(F.col("h")), hours, "h int") == [
        "00-05", "00-05", "06-11", "06-11", "12-17", "12-17", "18-23", "18-23", "18-23"]
    assert evaluate(spark, temporal.day_name(F.col("d")), [(1,), (7,), (None,)], "d int") == ["Sunday", "Saturday", None]


def test_entropy_flags_at_the_limits(spark):
    values = [(1.79,), (1.8,), (3.5,), (4.8,), (4.81,), (7.3,), (7.31,)]
    flags = evaluate(spark, verdicts.entropy_flag(F.col("h")), values, "h double")
    drift, stable = verdicts.FLAG_DRIFT, verdicts.FLAG_STABLE
    assert flags == [verdicts.FLAG_COLLAPSE, drift, stable, stable, drift, drift, verdicts.FLAG_SPIKE]
    assert evaluate(spark, verdicts.entropy_z(F.col("h")), [(4.2,), (2.9,)], "h double") == [0.0, 2.0]
