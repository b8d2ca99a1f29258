"""Timings of the headline operators; prints one JSON line.

The clean flow table is written once (``etl_clean``), as the jobs do, and the
operators read it from Parquet. Each entry is the fastest of three runs, so that
one-off compilation in a fresh JVM does not dominate.
"""

from __future__ import annotations

import json
import os
import re
import time

from netvigil import registry
from netvigil.ml import evaluation, features, inference, training
from netvigil.operators import (
    distributions, enrich, entropy, graph, hosts, networks, risk, rollup, sharding, timeline, verdicts,
)
from netvigil.session import build_session, fresh_path, materialize
from netvigil.sinks import tables

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = 3


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(action) -> float:
    best = float("inf")
    for _ in range(RUNS):
        started = time.perf_counter()
        action()
        best = min(best, time.perf_counter() - started)
    return round(best, 3)


def main() -> None:
    spark = build_session(
        "bench", f"local[{CPUS}]", spark__sql__shuffle__partitions=CPUS,
        spark__ui__enabled="false", spark__driver__memory="8g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()
    seconds: dict[str, float] = {}

    def etl() -> None:
        nonlocal flows
        flows = tables.write_table(registry.flows(spark, SF_DIR), fresh_path(spark, "clean"))

    flows = None
    seconds["etl_clean"] = timed(etl)
    scored = lambda: risk.ip_risk_scores(flows, ordered=False)
    links = lambda: graph.host_links(flows)
    plans = {
        "clean_funnel": lambda: registry.queries()["clean_funnel"](spark, SF_DIR),
        "attack_distribution": lambda: distributions.attack_distribution(flows),
        "protocol_distribution": lambda: distributions.protocol_distribution(flows),
        "severity_distribution": lambda: distributions.severity_distribution(flows),
        "kpi_overview": lambda: distributions.kpi_overview(flows),
        "hourly_timeline": lambda: timeline.hourly_timeline(flows),
        "daily_cadence": lambda: timeline.daily_cadence(flows),
        "surge_windows": lambda: timeline.surge_windows(flows),
        "top_attacking_ips": lambda: hosts.top_attacking_ips(flows),
        "top_targeted_ips": lambda: hosts.top_targeted_ips(flows),
        "crosstab": lambda: hosts.ip_attack_crosstab(flows),
        "ip_risk_scores": lambda: risk.ip_risk_scores(flows),
        "blacklist_filter": lambda: hosts.exclude_listed(flows, materialize(registry.critical_sources(flows), "blacklist")),
        "geo_enriched": lambda: enrich.geo_enriched(scored()),
        "mitigation_rules": lambda: enrich.mitigation_rules(flows.select("source_ip", "attack_type").distinct(), registry.RULES),
        "rule_classifier": lambda: verdicts.rule_classifier(flows),
        "graph_summary": lambda: graph.graph_summary(links()),
        "graph_edges": lambda: graph.graph_edges(flows),
        "packet_entropy": lambda: entropy.packet_entropy(flows),
        "entropy_drift": lambda: entropy.entropy_drift(flows),
        "partition_balance": lambda: sharding.partition_balance(flows),
        "graph_edges_labeled": lambda: graph.label_edges(graph.graph_edges(flows), graph.graph_degree(links())),
        "lateral_hops": lambda: graph.lateral_hops(links(), graph.graph_degree(links())),
        "quality_report": lambda: registry.queries()["quality_report"](spark, SF_DIR),
        "sharded_write": lambda: registry.queries()["sharded_write"](spark, SF_DIR),
        "bucketed_sources": lambda: registry.queries()["bucketed_sources"](spark, SF_DIR),
        "json_mirror": lambda: registry.queries()["json_mirror"](spark, SF_DIR),
        "geo_by_network": lambda: networks.geo_by_network(scored(), registry.networks(spark, SF_DIR)),
        "salted_join": lambda: registry.queries()["salted_join"](spark, SF_DIR),
        "pair_rollup": lambda: rollup.pair_rollup(flows),
        "profile_rollup": lambda: rollup.profile_rollup(flows),
    }
    for name, plan in plans.items():
        seconds[name] = timed(lambda: run(plan()))

    fitted, table, trained = None, None, {}

    def build_features() -> None:
        nonlocal fitted, table
        fitted = features.fit_features(flows)
        table = materialize(features.feature_table(fitted, flows), "features")

    def fit(kind: str) -> None:
        trained[kind] = training.train(features.training_part(table), kind)

    seconds["features"] = timed(build_features)
    seconds["train_decision_tree"] = timed(lambda: fit(training.DECISION_TREE))
    seconds["train_random_forest"] = timed(lambda: fit(training.RANDOM_FOREST))
    forest = trained[training.RANDOM_FOREST]
    held_out = features.test_part(table)
    seconds["evaluate"] = timed(
        lambda: run(evaluation.overall_metrics(evaluation.outcome_counts(forest.model.transform(held_out)))))
    scorer = training.scoring_pipeline(fitted, forest)
    seconds["predict_all"] = timed(lambda: run(inference.predict(flows, scorer)))
    seconds["stream_entropy"] = timed(lambda: run(registry.stream_entropy(spark, SF_DIR)))
    seconds["stream_blacklist"] = timed(lambda: registry.stream_blacklist(spark, SF_DIR))

    scale = re.search(r"sf([0-9.]+)", SF_DIR)
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": float(scale.group(1)) if scale else None,
    }))


if __name__ == "__main__":
    main()
