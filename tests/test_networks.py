"""Locations by longest prefix against plain comparisons, hot networks, odd rows and the plan."""

import ipaddress
import random

import pytest

from pyspark.sql import functions as F

from netvigil.operators import networks as net
from netvigil.session import materialize

SCHEMA = "network string, country string, asn string"


def located(addresses, rows):
    parsed = []
    for text, *about in rows:
        try:
            parsed.append((ipaddress.ip_network(text.strip(), strict=False), tuple(about)))
        except (ValueError, AttributeError):
            continue
    found = []
    for ip in addresses:
        try:
            inside = [(-n.prefixlen, str(n), about) for n, about in parsed if ipaddress.ip_address(ip) in n]
        except ValueError:
            inside = []
        found.append((ip, *(min(inside)[1:2] + min(inside)[2] if inside else (None, None, None))))
    return sorted(found, key=str)


def test_longest_prefix_equals_plain_comparison(spark):
    rng = random.Random(4)
    octets = lambda: ".".join(str(rng.choice([10, 11, 172, 0, 255, rng.randrange(256)])) for _ in range(4))
    rows = [(f"{octets()}/{rng.randrange(33)}", f"c{i % 7}", f"as{i}") for i in range(300)]
    rows += [("10.0.0.0/8", "b", "x"), ("10.9.9.9/8", "a", "y"), (" 172.16.0.0/12 ", "z", "z"),
             ("10.0.0.0/33", "bad", "1"), ("10.0.0/8", "bad", "2"), ("300.0.0.0/8", "bad", "3"), ("text", "bad", "4"), (None, "bad", "5")]
    addresses = [octets() for _ in range(400)] + ["10.1.2.3", "0.0.0.0", "255.255.255.255"]
    table = spark.createDataFrame([(ip,) for ip in addresses], "source_ip string")
    got = net.with_network(table, spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(map(tuple, got), key=str) == located(addresses, [r for r in rows if r[1] != "bad"])


def test_a_default_network_takes_the_rest_and_hosts_are_networks(spark):
    rows = [("0.0.0.0/0", "rest", "a"), ("10.0.0.7/32", "host", "b"), ("10.0.0.0/31", "pair", "c")]
    table = spark.createDataFrame([("10.0.0.7",), ("10.0.0.1",), ("10.0.0.2",), ("not an address",), (None,), ("1.2.3",), ("1.2.3.256",)],
                                  "source_ip string")
    got = {r.source_ip: r.country for r in net.with_network(table, spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {"10.0.0.7": "host", "10.0.0.1": "pair", "10.0.0.2": "rest", "not an address": None, None: None, "1.2.3": None,
                   "1.2.3.256": None}


def test_without_networks_nothing_is_located(spark):
    table = spark.createDataFrame([("10.0.0.7", 1), ("10.0.0.7", 2)], "source_ip string, n int")
    got = net.with_network(table, spark.createDataFrame([], SCHEMA)).collect()
    assert sorted(r.n for r in got) == [1, 2] and {r.country for r in got} == {None}
    assert net.with_network(table.limit(0), spark.createDataFrame([("10.0.0.0/8", "a", "b")], SCHEMA)).count() == 0


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_a_hot_network_is_spread_and_nothing_is_nested(spark, no_broadcast):
    table = materialize(spark.range(20_000).selectExpr("concat('10.', id % 250, '.', id DIV 250, '.1') AS source_ip"), "hosts")
    networks = spark.createDataFrame([("10.0.0.0/8", "ten", "a"), ("10.3.0.0/16", "three", "b")], SCHEMA)
    found = net.longest_prefix(table, networks)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "salt" in plan
    counts = {r.country: r["count"] for r in found.selectExpr("about.country AS country").groupBy("country").count().collect()}
    assert counts == {"ten": 20_000 - 80, "three": 80}


def test_scores_are_made_once_and_matches_are_not_sorted(spark, capfd):
    """The plan of the located sources reads written scores only, and lengths are aggregated without a sort."""
    risk = spark.createDataFrame([("10.0.0.1", 3, 50, "High"), ("11.0.0.1", 1, 10, "Low")],
                                 "source_ip string, total_flows long, risk_score int, risk_level string")
    networks = spark.createDataFrame([("10.0.0.0/8", "a", "b", "c", 1.0, 2.0, "d"), ("10.0.0.0/30", "e", "f", "g", 1.0, 2.0, "h")],
                                     "network string, country string, country_code string, city string, latitude double, "
                                     "longitude double, asn string")
    located = net.geo_by_network(risk, networks)
    assert {r.source_ip: r.network for r in located.collect()} == {"10.0.0.1": "10.0.0.0/30", "11.0.0.1": None}
    located.explain()
    assert "LocalTableScan" not in (plan := capfd.readouterr().out) and "Scan ExistingRDD" not in plan
    net.longest_prefix(risk, networks).explain()
    assert "SortAggregate" not in capfd.readouterr().out


def test_odd_addresses(spark):
    odd = ["1.2.3.4", " 1.2.3.4 ", "255.255.255.255", "256.1.1.1", "1.1.1.999", "1.2.3", "1.2.3.4.5", "a.b.c.d", "", None, "0.0.0.0",
           "1.2.3.4\t", "01.002.3.4"]
    rows = spark.createDataFrame([(t,) for t in odd], "ip string").select(net.address_number(F.col("ip"))).collect()
    first = 1 * 256 ** 3 + 2 * 256 ** 2 + 3 * 256 + 4
    assert [r[0] for r in rows] == [first, first, 2 ** 32 - 1, None, None, None, None, None, None, None, 0, first, first]
