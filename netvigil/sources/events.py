"""Adapter: generic ``events`` rows become raw flow logs.

The mapping is deterministic and plants the defects the cleaning step must
handle: blank addresses, negative and non-numeric durations, padded and
mixed-case text, and repeated records.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from netvigil.schema import RAW_COLUMNS


_KEYED = ["event_id", "ts", "user_id", "event_type", "value",
          """CAST(trim(BOTH '{"k: }' FROM props) AS BIGINT) AS k"""]

_MAPPED = [
    "event_id",
    "date_format(ts, 'yyyy-MM-dd HH:mm:ss') AS timestamp",
    """CASE WHEN event_id % 97 = 0 THEN ''
            WHEN user_id % 15 = 0 THEN concat('172.16.1.', k % 10)
            ELSE concat_ws('.', '10', user_id DIV 256, user_id % 256, day(ts)) END AS source_ip""",
    "concat('172.16.1.', (event_id * 7 + k) % 20) AS destination_ip",
    "CASE event_id % 3 WHEN 0 THEN ' tcp' WHEN 1 THEN 'UDP' ELSE 'Icmp ' END AS protocol",
    """CASE WHEN event_id % 89 = 0 THEN '-1' WHEN event_id % 83 = 0 THEN 'n/a'
            ELSE CAST(floor(value * 1000) AS STRING) END AS flow_duration""",
    "CAST(40 + k * 14 AS STRING) AS packet_length",
    "CAST((40 + k * 14) * (1 + event_id % 500) AS STRING) AS total_bytes",
    "CAST(1 + event_id % 500 AS STRING) AS packet_count",
    """CASE event_type WHEN 'view' THEN 'BENIGN' WHEN 'error' THEN 'DDoS' WHEN 'click' THEN ' PortScan'
            WHEN 'signup' THEN 'Botnet' ELSE 'BruteForce' END AS attack_type""",
    """CASE event_type WHEN 'view' THEN 'Low'
            WHEN 'click' THEN if(event_id % 2 = 0, 'Low', 'Medium')
            WHEN 'purchase' THEN if(event_id % 2 = 0, 'Medium', 'High')
            ELSE if(event_id % 2 = 0, 'High', 'Critical') END AS severity""",
]

# Every 50th record is logged twice; repeating it in place keeps this one scan.
_COPIES = "explode(array_repeat(1, if(event_id % 50 = 0, 2, 1))) AS copy"


def raw_flows_from_events(events: DataFrame, keep: str | None = None) -> DataFrame:
    """Raw flow logs, all fields as text, from one scan of the events. ``keep``: one more column, "expression AS name"."""
    mapped = events.selectExpr(*_KEYED).selectExpr(*_MAPPED)
    more = [] if keep is None else [keep.rpartition(" AS ")[2]]
    return mapped.selectExpr("*", _COPIES, *([keep] if keep else [])).select(*RAW_COLUMNS, *more)
