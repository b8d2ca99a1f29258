"""Schemas and vocabularies of the flow tables."""

from __future__ import annotations

from pyspark.sql import types as T

# The time format of raw logs, as a pattern and as a regular expression.
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"
TIMESTAMP_SHAPE = r"^\d{4}-\d\d-\d\d \d\d:\d\d:\d\d$"

# Class, protocol and severity vocabularies.
BENIGN = "BENIGN"
ATTACK_CLASSES = ["Botnet", "BruteForce", "DDoS", "PortScan"]
PROTOCOLS = ["TCP", "UDP", "ICMP"]
SEVERITIES = ["Critical", "High", "Medium", "Low"]

METRICS = ["flow_duration", "packet_length", "total_bytes", "packet_count"]

RAW_COLUMNS = [
    "timestamp", "source_ip", "destination_ip", "protocol",
    "flow_duration", "packet_length", "total_bytes", "packet_count",
    "attack_type", "severity",
]

# Raw logs are read as text in one pass; types are settled by the cleaning step.
RAW_SCHEMA = T.StructType([T.StructField(name, T.StringType()) for name in RAW_COLUMNS])

# The columns that identify one flow.
FLOW_KEY = ["timestamp", "source_ip", "destination_ip", "protocol", "flow_duration", "total_bytes"]

FLOW_SCHEMA = T.StructType([
    T.StructField("source_ip", T.StringType()),
    T.StructField("destination_ip", T.StringType()),
    T.StructField("protocol", T.StringType()),
    T.StructField("flow_duration", T.LongType()),
    T.StructField("packet_length", T.LongType()),
    T.StructField("total_bytes", T.LongType()),
    T.StructField("packet_count", T.LongType()),
    T.StructField("attack_type", T.StringType()),
    T.StructField("severity", T.StringType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("hour", T.IntegerType()),
    T.StructField("day_of_week", T.IntegerType()),
])

DOCUMENT_SCHEMA = T.StructType([
    T.StructField(name, T.LongType() if name in METRICS else T.StringType()) for name in RAW_COLUMNS
])
