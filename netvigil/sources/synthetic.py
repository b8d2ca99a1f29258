"""Synthetic raw flows with class-dependent metrics, generated in parallel.

Every value of a row is drawn from the md5 of (seed, row number), so any row
can be produced on any task, twice alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from netvigil.functions.hashing import hex_chunk
from netvigil.schema import RAW_COLUMNS

# Class mix in percent, per-class ranges and pools.
CLASS_MIX = [("BENIGN", 40), ("DDoS", 25), ("PortScan", 15), ("BruteForce", 10), ("Botnet", 10)]
DURATION = {"BENIGN": (15_000, 800_000), "DDoS": (500, 50_000), "PortScan": (100, 5_000),
            "BruteForce": (50_000, 1_200_000), "Botnet": (100_000, 3_000_000)}
PACKETS = {"BENIGN": (5, 150), "DDoS": (500, 10_000), "PortScan": (1, 5),
           "BruteForce": (50, 600), "Botnet": (20, 400)}
LENGTH = {"BENIGN": (200, 1500), "DDoS": (64, 512), "PortScan": (40, 64),
          "BruteForce": (100, 800), "Botnet": (150, 1200)}
PROTOCOL_CHOICES = {"BENIGN": ["TCP", "TCP", "UDP"], "DDoS": ["TCP", "UDP"], "PortScan": ["TCP"],
                    "BruteForce": ["TCP"], "Botnet": ["TCP", "UDP", "ICMP"]}
SEVERITY_CHOICES = {"BENIGN": ["Low"], "DDoS": ["High", "Critical"], "PortScan": ["Low", "Medium"],
                    "BruteForce": ["Medium", "High"], "Botnet": ["High", "Critical"]}
# Percentage of a class's flows that come from the persistent attackers.
PERSISTENT_SHARE = {"DDoS": 70, "PortScan": 60, "BruteForce": 50, "Botnet": 100}
PERSISTENT, OCCASIONAL, CLIENTS, SERVERS = 100, 300, 1500, 30
START = "2026-08-26 10:00:00"
# Mean step of the clock and the jitter around it, so that steps stay in 10..200 ms.
STEP_MS, JITTER_MS = 105, 96


DRAWS = 10


def with_draws(rows: DataFrame, seed: int) -> DataFrame:
    """Add columns u0 .. u9: independent 32-bit draws per row, four from each digest."""
    digests = range((DRAWS + 3) // 4)
    text = lambda j: F.concat_ws(":", F.lit(str(seed)), F.col("row").cast("string"), F.lit(str(j)))
    digested = rows.select("row", *[F.md5(text(j)).alias(f"digest{j}") for j in digests])
    return digested.select("row", *[hex_chunk(F.col(f"digest{i // 4}"), i % 4).alias(f"u{i}") for i in range(DRAWS)])


def ipv4(*parts) -> Column:
    columns = [p.cast("string") if isinstance(p, Column) else F.lit(str(p)) for p in parts]
    return F.concat_ws(".", *columns)


def persistent_ip(i: Column) -> Column:
    return (
        F.when(i < 50, ipv4(192, 168, 1, i + 10))
        .when(i < 80, ipv4(45, 33, i * 37 % 254 + 1, i * 101 % 254 + 1))
        .otherwise(ipv4(185, 220, 101, i - 79))
    )


def occasional_ip(i: Column) -> Column:
    return ipv4(i * 53 % 210 + 11, i * 37 % 254 + 1, i * 101 % 254 + 1, i * 151 % 254 + 1)


def client_ip(i: Column) -> Column:
    return (
        F.when(i < 500, ipv4(10, 0, i % 20 + 1, i * 37 % 254 + 1))
        .when(i < 1000, ipv4(172, 16, i % 10 + 1, i * 37 % 254 + 1))
        .otherwise(ipv4(192, 168, 100, i * 37 % 254 + 1))
    )


def server_ip(i: Column) -> Column:
    return F.when(i < 20, ipv4(10, 0, 0, i + 1)).otherwise(ipv4(172, 16, 1, i - 19))


def per_class(values: dict[str, Column]) -> Column:
    cases = F
    for name, value in values.items():
        cases = cases.when(F.col("attack_type") == name, value)
    return cases


def pick(draw: Column, options: list[str]) -> Column:
    return F.get(F.array(*[F.lit(o) for o in options]), (draw % len(options)).cast("int"))


def generate_flows(rows: DataFrame, id_column: str = "id", seed: int = 42) -> DataFrame:
    """One raw flow per row number in ``rows`` (numbers start at 0)."""
    u = [F.col(f"u{i}") for i in range(DRAWS)]
    drawn = with_draws(rows.select(F.col(id_column).cast("long").alias("row")), seed)

    classes, upper = F, 0
    for name, weight in CLASS_MIX:
        upper += weight
        classes = classes.when(u[0] % 100 < upper, name)
    spread = lambda draw, ranges: per_class(
        {name: draw % (high - low + 1) + low for name, (low, high) in ranges.items()})
    attacker = {
        name: F.when(u[1] % 100 < share, persistent_ip(u[2] % PERSISTENT)).otherwise(occasional_ip(u[2] % OCCASIONAL))
        for name, share in PERSISTENT_SHARE.items()
    }
    elapsed = F.floor((F.col("row") * STEP_MS + u[9] % JITTER_MS) / 1000)
    clock = F.lit(START).cast("timestamp_ntz") + F.make_dt_interval(secs=elapsed)
    shaped = drawn.withColumn("attack_type", classes).select(
        F.date_format(clock, "yyyy-MM-dd HH:mm:ss").alias("timestamp"),
        per_class({"BENIGN": client_ip(u[2] % CLIENTS)} | attacker).alias("source_ip"),
        server_ip(u[3] % SERVERS).alias("destination_ip"),
        per_class({c: pick(u[4], o) for c, o in PROTOCOL_CHOICES.items()}).alias("protocol"),
        spread(u[5], DURATION).alias("flow_duration"),
        spread(u[6], PACKETS).alias("packet_count"),
        spread(u[7], LENGTH).alias("packet_length"),
        "attack_type",
        per_class({c: pick(u[8], o) for c, o in SEVERITY_CHOICES.items()}).alias("severity"),
    )
    sized = shaped.withColumn("total_bytes", F.col("packet_count") * F.col("packet_length"))
    return sized.select(*[F.col(name).cast("string").alias(name) for name in RAW_COLUMNS])


def generate_range(spark: SparkSession, n: int, seed: int = 42, partitions: int | None = None) -> DataFrame:
    """``n`` synthetic raw flows."""
    return generate_flows(spark.range(0, n, 1, partitions), "id", seed)
