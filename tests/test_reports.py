"""Distribution, timeline, host and risk reports."""

import random
from collections import Counter, defaultdict

import pytest

from netvigil.ml import evaluation
from netvigil.operators import distributions, enrich, graph, hosts, quality, risk, rollup, sharding, timeline, verdicts
from netvigil.session import fresh_path


@pytest.fixture(scope="module")
def sample(make_flows):
    """600 random flows in which one source sends, and one host receives, a third or more."""
    rng = random.Random(11)
    classes = ["BENIGN", "DDoS", "PortScan", "Botnet", "BruteForce", "Worm"]
    rows = []
    for i in range(600):
        rows.append(dict(
            source_ip="10.0.0.1" if i % 3 == 0 else f"10.0.{rng.randrange(3)}.{rng.randrange(30)}",
            destination_ip="172.16.1.1" if i % 2 == 0 else f"172.16.1.{rng.randrange(8)}",
            attack_type=rng.choice(classes), protocol=rng.choice(["TCP", "UDP"]),
            severity=rng.choice(["Low", "High", None]), total_bytes=rng.randrange(10**6),
            packet_length=rng.randrange(1500), flow_duration=rng.randrange(10**6),
            hour=rng.choice([None, *range(24)]), day_of_week=rng.choice([None, *range(1, 8)]),
        ))
    return make_flows(*rows).cache()


def test_reports_agree_on_flows_and_rollups(sample, rows_of):
    profile, pairs = rollup.profile_rollup(sample), rollup.pair_rollup(sample)
    for report in (distributions.attack_distribution, distributions.protocol_distribution,
                   distributions.severity_distribution, timeline.hourly_timeline, timeline.daily_cadence,
                   timeline.surge_windows, timeline.hourly_attack_intensity):
        assert rows_of(report(sample)) == rows_of(report(profile)), report.__name__
    for report in (hosts.top_attacking_ips, hosts.top_targeted_ips, hosts.ip_attack_crosstab, hosts.modal_attack_type,
                   risk.ip_risk_scores, risk.ip_risk_signals, distributions.kpi_overview, verdicts.source_severity):
        assert rows_of(report(sample)) == rows_of(report(pairs)), report.__name__


def test_top_attackers_against_brute_force(sample):
    attacks = [r for r in sample.collect() if r["attack_type"] != "BENIGN"]
    by_source = defaultdict(list)
    for r in attacks:
        by_source[r["source_ip"]].append(r)
    expected = sorted(by_source.items(), key=lambda kv: (-len(kv[1]), kv[0]))[:7]
    got = hosts.top_attacking_ips(sample, 7).collect()
    assert [r["source_ip"] for r in got] == [ip for ip, _ in expected]
    for row, (_, flows) in zip(got, expected):
        counts = Counter(f["attack_type"] for f in flows)
        assert row["attack_flow_count"] == len(flows)
        assert row["unique_attack_types"] == len(counts)
        assert row["top_attack_type"] == min(counts, key=lambda c: (-counts[c], c))
        assert row["total_bytes_sent_mb"] == pytest.approx(sum(f["total_bytes"] for f in flows) / 2**20, abs=1e-4)


def test_targets_and_crosstab_against_brute_force(sample):
    attacks = [r for r in sample.collect() if r["attack_type"] != "BENIGN"]
    for row in hosts.top_targeted_ips(sample, 3).collect():
        mine = [r for r in attacks if r["destination_ip"] == row["destination_ip"]]
        assert row["attack_flow_count"] == len(mine)
        assert row["unique_attackers"] == len({r["source_ip"] for r in mine})
        assert row["unique_attack_types"] == len({r["attack_type"] for r in mine})
    totals = Counter(r["source_ip"] for r in attacks)
    busiest = sorted(totals, key=lambda s: (-totals[s], s))[:5]
    table = hosts.ip_attack_crosstab(sample, 5)
    counts = Counter((r["source_ip"], r["attack_type"]) for r in attacks if r["source_ip"] in busiest)
    assert {(r["source_ip"], r["attack_type"]): r["flows"] for r in table.collect()} == counts
    assert any(name == "Worm" for _, name in counts)
    for row in hosts.crosstab_columns(table).collect():  # the unknown class is in Other, so the columns add up
        assert sum(tuple(row)[1:]) == totals[row["source_ip"]] and row["Other"] == counts[row["source_ip"], "Worm"]


def test_huge_records_abort_no_report(make_flows):
    """Two records of 9e18 bytes overflow a long sum; every report takes them."""
    flows = make_flows(*[dict(source_ip="10.0.0.1", destination_ip=f"172.16.1.{i}", total_bytes=9 * 10**18, flow_duration=9 * 10**18,
                              packet_length=9 * 10**18) for i in (1, 1, 2)])
    exact = 27 * 10**18
    for table in (flows, rollup.pair_rollup(flows)):
        assert hosts.top_attacking_ips(table).first()["total_bytes_sent_mb"] == round(exact / 2**20, 4)
        assert hosts.top_targeted_ips(table).first()["total_bytes_received_mb"] == round(exact * 2 / 3 / 2**20, 4)
        assert risk.ip_risk_signals(table).first()["avg_bytes_per_flow"] == 9e18
        assert graph.graph_edges(table).count() == 2
    for table in (flows, rollup.profile_rollup(flows)):
        assert distributions.attack_distribution(table).first()["total_bytes_gb"] == round(exact / 2**30, 6)
        assert timeline.hourly_timeline(table).count() == 1


def test_risk_against_brute_force(sample):
    weight = {"DDoS": 40, "Botnet": 30, "BruteForce": 25, "PortScan": 15}
    by_source = defaultdict(list)
    for r in sample.collect():
        by_source[r["source_ip"]].append(r)
    table = {r["source_ip"]: r for r in risk.ip_risk_scores(sample).collect()}
    assert set(table) == set(by_source)
    for ip, flows in by_source.items():
        attacks = sum(f["attack_type"] != "BENIGN" for f in flows)
        targets = len({f["destination_ip"] for f in flows})
        score = min(100, min(40, 4 * attacks) + max(weight.get(f["attack_type"], 0) for f in flows) + min(20, 4 * targets))
        assert table[ip]["risk_score"] == (score if attacks else 10)
        assert (table[ip]["total_flows"], table[ip]["attack_count"]) == (len(flows), attacks)


def test_ties_are_settled_by_name(make_flows):
    flows = make_flows(
        dict(source_ip="b", attack_type="DDoS"), dict(source_ip="b", attack_type="Botnet"),
        dict(source_ip="a", attack_type="PortScan"), dict(source_ip="a", attack_type="DDoS"), dict(source_ip="c"),
    )
    assert [tuple(r)[0] for r in hosts.top_attacking_ips(flows, 1).collect()] == ["a"]
    modal = {r["source_ip"]: r["top_attack_type"] for r in hosts.modal_attack_type(flows).collect()}
    assert modal == {"a": "DDoS", "b": "Botnet", "c": "DDoS"}


def test_shares_and_buckets(sample):
    for report in (distributions.attack_distribution, distributions.severity_distribution, distributions.protocol_distribution):
        assert sum(r["pct_share"] for r in report(sample).collect()) == pytest.approx(100, abs=1)
    assert timeline.surge_windows(sample).count() == 4
    rates = [r["attack_rate_pct"] for r in timeline.hourly_timeline(sample).collect()]
    assert len(rates) <= 25 and all(0 <= r <= 100 for r in rates)


def test_lookup(sample):
    table = risk.ip_risk_scores(sample, ordered=False)
    assert risk.lookup_ip(table, "10.0.0.1").count() == 1
    assert risk.lookup_ip(table, "203.0.113.1").count() == 0


def test_order_of_the_risk_table(sample):
    rows = [(-r["risk_score"], -r["attack_count"], r["source_ip"]) for r in risk.ip_risk_scores(sample).collect()]
    assert rows == sorted(rows)


def test_blacklist(sample, spark):
    listed = spark.createDataFrame([("10.0.0.1",), ("10.0.0.1",), ("nowhere",)], "source_ip string")
    kept, blocked = hosts.exclude_listed(sample, listed), hosts.only_listed(sample, listed)
    assert kept.where("source_ip = '10.0.0.1'").count() == 0
    assert kept.count() + blocked.count() == sample.count()


def test_blacklist_is_not_forced_into_memory(spark, sample):
    """A long list is joined by shuffle: no broadcast hint stands in the plan."""
    listed = spark.range(10).selectExpr("concat('10.0.0.', id) AS source_ip")
    logical = hosts.exclude_listed(sample, listed)._jdf.queryExecution().logical().toString()
    assert "broadcast" not in logical.lower()


def test_quality_report_finds_defects(sample, make_flows):
    bad = make_flows(dict(source_ip=""), dict(protocol="tcp", total_bytes=-1), dict(hour=24), dict(day_of_week=0), {})
    found = {r["check_name"]: r["violations"] for r in quality.check_table(bad, "flows", quality.flow_checks()).collect()}
    assert {k: v for k, v in found.items() if v} == {
        "source_ip_missing": 1, "protocol_not_upper": 1, "total_bytes_negative": 1,
        "hour_out_of_range": 1, "day_of_week_out_of_range": 1}
    report = quality.quality_report(
        sample, risk.ip_risk_scores(sample, ordered=False), timeline.hourly_timeline(sample))
    assert report.where("NOT passed").count() == 0


def test_geo_table_and_filters(sample):
    table = risk.ip_risk_scores(sample, ordered=False)
    geo = enrich.geo_enriched(table)
    assert geo.count() == table.count()
    by_vector = sum(enrich.geo_filtered(geo, vector=v).count() for v in enrich.GEO_VECTORS)
    assert by_vector == geo.count()
    assert enrich.volume_by(geo, "country", 3).count() == 3


def test_unknown_class_uses_the_fallback_row(make_flows):
    rows = enrich.with_technique(make_flows(dict(attack_type="Worm"), dict(attack_type="PortScan"))).collect()
    assert sorted(r["technique_id"] for r in rows) == ["T1046", "T1498"]
    texts = [("Botnet", "stop {IP}", "watch {IP}", "route {HASH}"), ("DDoS", "drop {IP}", "", "")]
    flows = make_flows(dict(source_ip="10.1.2.3", attack_type="Botnet"), dict(source_ip="10.1.2.4", attack_type="Worm"))
    rules = {r["source_ip"]: tuple(r)[2:] for r in enrich.mitigation_rules(flows, texts).collect()}
    assert rules["10.1.2.3"][:2] == ("stop 10.1.2.3", "watch 10.1.2.3") and "{" not in rules["10.1.2.3"][2]
    assert rules["10.1.2.4"] == ("drop 10.1.2.4", "", "")


def test_sharded_write_is_whole_and_spread(spark, sample):
    path = fresh_path(spark, "shards")
    sharding.write_sharded(sample, path, shards=2, writers_per_shard=4)
    written = spark.read.parquet(path)
    assert written.count() == sample.count()
    assert written.groupBy("source_ip").agg({"shard": "max"}).count() == written.select("source_ip", "shard").distinct().count()


def test_bucketed_table_needs_no_shuffle(spark, sample):
    path = fresh_path(spark, "bucketed")
    stored = sharding.write_bucketed(sample, f"bucketed_{path[-6:]}", path, buckets=4)
    per_source = stored.groupBy("source_ip").count()
    assert "Exchange" not in per_source._jdf.queryExecution().executedPlan().toString()
    assert per_source.count() == sample.select("source_ip").distinct().count()


def test_distinct_counts_expand_no_row(spark, sample):
    path = fresh_path(spark, "flows")
    sample.write.parquet(path)
    flows = spark.read.parquet(path)
    for report in (hosts.top_targeted_ips, risk.ip_risk_signals):
        assert "Expand" not in report(flows)._jdf.queryExecution().executedPlan().toString()


def test_evaluation_keeps_labels_that_were_not_in_training(spark):
    outcomes = spark.createDataFrame([(0, 0, 5), (0, 2, 1), (2, 0, 3), (1, 1, 4), (7, 2, 2)], "label int, prediction int, n long")
    matrix = evaluation.confusion_matrix(outcomes, ["a", "b"])
    cells = {(r["actual"], r["predicted"]): r["n"] for r in matrix.collect()}
    assert cells == {("a", "a"): 5, ("a", "b"): 0, ("b", "a"): 0, ("b", "b"): 4, ("a", "Unknown_2"): 1,
                     ("Unknown_2", "a"): 3, ("Unknown_7", "Unknown_2"): 2}
    labels = spark.createDataFrame([(0, "a"), (1, "b"), (5, "c")], "label int, attack_type string")
    support = {r["attack_type"]: r["support"] for r in evaluation.class_report(outcomes, labels).collect()}
    assert support == {"a": 6, "b": 4, "c": 0, "Unknown_2": 3, "Unknown_7": 2}
