import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from netvigil.schema import FLOW_SCHEMA, RAW_SCHEMA  # noqa: E402
from netvigil.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
        spark__driver__memory="6g",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def raw_row(**changes):
    row = dict(timestamp="2024-01-07 10:30:00", source_ip="10.0.0.1", destination_ip="172.16.1.1", protocol="TCP",
               flow_duration="100", packet_length="50", total_bytes="500", packet_count="10",
               attack_type="DDoS", severity="High")
    return tuple((row | changes)[name] for name in RAW_SCHEMA.names)


@pytest.fixture(scope="session")
def make_raw(spark):
    return lambda *rows: spark.createDataFrame([raw_row(**r) for r in rows], RAW_SCHEMA)


@pytest.fixture(scope="session")
def make_flows(spark):
    """Clean flows from dictionaries; missing columns get defaults."""
    from datetime import datetime

    base = dict(source_ip="10.0.0.1", destination_ip="172.16.1.1", protocol="TCP", flow_duration=100, packet_length=50,
                total_bytes=500, packet_count=10, attack_type="DDoS", severity="High",
                timestamp=datetime(2024, 1, 7, 10, 30), hour=10, day_of_week=1)

    def make(*rows):
        return spark.createDataFrame([tuple((base | r)[n] for n in FLOW_SCHEMA.names) for r in rows], FLOW_SCHEMA)

    return make


@pytest.fixture(scope="session")
def rows_of():
    def rows(df, *columns):
        picked = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in picked.collect()), key=str)

    return rows
