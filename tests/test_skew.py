"""A source and a host with a third of all rows each: same results, and joins that split the hot key."""

import pytest
from pyspark.sql import functions as F

from netvigil.operators import graph, hosts, risk, rollup, sharding
from netvigil.session import fresh_path, materialize

ROWS = 120_000
SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "32KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
    "spark.sql.files.openCostInBytes": "0",
}


@pytest.fixture(scope="module")
def flows(spark):
    i = F.col("id")
    made = spark.range(0, ROWS, 1, 16).select(
        F.when(i % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), (i * 7919 % 20_011).cast("string"))).alias("source_ip"),
        F.when(i % 3 == 1, "target").otherwise(F.concat(F.lit("s"), (i * 104_729 % 20_011).cast("string"))).alias("destination_ip"),
        F.when(i % 5 == 0, "BENIGN").when(i % 5 == 1, "DDoS").otherwise("PortScan").alias("attack_type"),
        (i % 1400).alias("packet_length"), (i % 999_983).alias("total_bytes"), i.alias("flow_duration"),
    )
    return materialize(made, "skewed")


@pytest.fixture
def tiny_thresholds(spark):
    before = {key: spark.conf.get(key) for key in SMALL}
    for key, value in SMALL.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


def final_plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_blacklist_join_splits_the_hot_source(spark, flows, tiny_thresholds):
    listed = spark.range(0, 20_011, 2).select(F.concat(F.lit("s"), F.col("id").cast("string")).alias("source_ip"))
    kept = hosts.exclude_listed(flows, listed)
    assert "SortMergeJoin(skew=true)" in final_plan(kept)
    sources = [r[0] for r in flows.select("source_ip").collect()]
    assert kept.count() == sum(1 for ip in sources if ip == "hot" or int(ip[1:]) % 2)


def test_edge_labels_split_the_hot_hosts(flows, tiny_thresholds):
    pairs = materialize(rollup.pair_rollup(flows), "pairs")
    edges, degree = graph.graph_edges(pairs), graph.graph_degree(graph.host_links(pairs))
    labelled = graph.label_edges(edges, degree)
    assert final_plan(labelled).count("SortMergeJoin(skew=true)") == 2
    rows = edges.collect()
    sources, targets = {r["source_ip"] for r in rows}, {r["destination_ip"] for r in rows}
    got = labelled.collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r["source_role"] == "Pivot") == (r["source_ip"] in targets)
        assert (r["destination_role"] == "Pivot") == (r["destination_ip"] in sources)


def test_hops_split_the_hot_hosts(flows, tiny_thresholds):
    links = materialize(graph.host_links(flows).repartition(8), "links")  # several files, several map tasks
    degree = graph.graph_degree(links)
    hops = graph.lateral_hops(links, degree)
    # "target" attacks nobody and "hot" is never attacked, so neither is a pivot, yet both are hot join keys.
    assert "SortMergeJoin(skew=true)" in final_plan(hops)
    rows = links.collect()
    pivots = {r["source_ip"] for r in rows} & {r["destination_ip"] for r in rows}
    assert hops.count() == sum((r["source_ip"] in pivots) + (r["destination_ip"] in pivots) for r in rows)


def test_hot_source_and_target_totals(flows):
    rows = [r for r in flows.collect()]
    hot = [r for r in rows if r["source_ip"] == "hot"]
    profile = risk.lookup_ip(risk.ip_risk_scores(flows), "hot").first()
    assert profile["total_flows"] == len(hot) and profile["unique_destinations"] == len({r["destination_ip"] for r in hot})
    top = hosts.top_targeted_ips(flows, 1).first()
    mine = [r for r in rows if r["destination_ip"] == "target" and r["attack_type"] != "BENIGN"]
    assert (top["destination_ip"], top["attack_flow_count"]) == ("target", len(mine))
    assert top["unique_attackers"] == len({r["source_ip"] for r in mine})
    assert hosts.top_attacking_ips(flows, 1).first()["source_ip"] == "hot"


def test_salted_buckets_spread_a_hot_source_and_join_without_a_shuffle(spark, flows, tiny_thresholds):
    hot = sharding.hot_sources(flows, 8)
    assert [r[0] for r in hot.collect()] == ["hot"]
    names = [f"t_{fresh_path(spark, 'x')[-8:]}" for _ in range(2)]
    side = flows.groupBy("source_ip").agg(F.sum("packet_length").alias("lengths"))
    salted = sharding.write_salted(flows, hot, names[0], fresh_path(spark, "salted"), 8, 6)
    other = sharding.write_salted_side(side, hot, names[1], fresh_path(spark, "side"), 8, 6)
    joined = salted.join(other, ["source_ip", "salt"])
    assert "Exchange" not in final_plan(joined)
    assert joined.where("source_ip = 'hot'").select(F.spark_partition_id()).distinct().count() > 2
    summed = lambda df: tuple(df.agg(F.count("*"), F.sum("lengths"), F.sum("total_bytes")).first())
    assert summed(joined) == summed(flows.join(side, "source_ip"))
