"""Pre-summed tables from which the reports are derived.

Reports over class, protocol, severity and time share one small rollup, and
host reports share one table of host pairs. A job scans the flows once for
each of the two instead of once per report.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from netvigil.functions.measures import FLOW_COUNT, Measures, sum_name
from netvigil.session import materialize

PROFILE_KEYS = ["attack_type", "protocol", "severity", "hour", "day_of_week"]
PAIR_KEYS = ["source_ip", "destination_ip", "attack_type"]
SUMMED = ["flow_duration", "packet_length", "total_bytes"]


def rollup(table: DataFrame, keys: list[str], metrics: list[str] = SUMMED) -> DataFrame:
    """Counts and exact sums per key; accepts flows or a finer rollup."""
    m = Measures(table)
    return table.groupBy(*keys).agg(
        m.flows().alias(FLOW_COUNT), *[m.total(name).alias(sum_name(name)) for name in metrics]
    )


def profile_rollup(flows: DataFrame) -> DataFrame:
    """Input of the distribution and timeline reports."""
    return rollup(flows, PROFILE_KEYS)


def stored_pairs(table: DataFrame) -> DataFrame:
    """A pair rollup that several branches can read: a given rollup as it is, flows rolled up and written once."""
    return table if Measures(table).rolled else materialize(pair_rollup(table), "pairs")


def pair_rollup(flows: DataFrame) -> DataFrame:
    """Input of the host, risk and graph reports: one row per (source, destination, class)."""
    return rollup(flows, PAIR_KEYS, ["packet_length", "total_bytes"])
