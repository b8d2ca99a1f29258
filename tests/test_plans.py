"""What the physical plans must look like, whatever the size of the data."""

import pytest

from netvigil.operators import clean, distributions, graph, hosts, risk, rollup, timeline
from netvigil.session import materialize


@pytest.fixture(scope="module")
def written(spark, make_flows):
    return materialize(make_flows(dict(), dict(source_ip="b", destination_ip="10.0.0.1", attack_type="BENIGN")), "plans")


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def scanned(plan: str) -> list[str]:
    """Column lists of the file scans."""
    return [line.split("FileScan parquet [")[1].split("]")[0] for line in plan.splitlines() if "FileScan parquet" in line]


def test_reports_scan_once_and_only_their_columns(written):
    cases = {
        distributions.protocol_distribution: {"protocol", "attack_type"},
        distributions.severity_distribution: {"severity"},
        timeline.hourly_attack_intensity: {"hour", "attack_type"},
        hosts.top_attacking_ips: {"source_ip", "attack_type", "total_bytes", "packet_length"},
        risk.ip_risk_scores: {"source_ip", "destination_ip", "attack_type"},
    }
    for report, columns in cases.items():
        scans = scanned(plan_of(report(written)))
        assert len(scans) == 1, report.__name__
        assert {c.split("#")[0] for c in scans[0].split(",")} == columns, report.__name__


def test_reports_of_two_branches_read_the_flows_once(written, spark):
    source = written.inputFiles()[0].rpartition("/")[0]
    for report in (hosts.top_targeted_ips, risk.ip_risk_signals):
        assert not [name for name in report(written).inputFiles() if source in name], report.__name__  # a stored pair rollup only
    assert len(scanned(plan_of(hosts.ip_attack_crosstab(written)))) == 1
    pairs = materialize(rollup.pair_rollup(written), "pairs")
    assert rollup.stored_pairs(pairs) is pairs  # a rollup is not rolled up again


def test_class_filter_and_lookup_reach_the_scan(written, spark):
    assert "PushedFilters: [IsNotNull(attack_type), Not(EqualTo(attack_type,BENIGN))" in plan_of(hosts.attack_flows(written))
    table = materialize(risk.ip_risk_scores(written), "risk")
    assert "EqualTo(source_ip,b)" in plan_of(risk.lookup_ip(table, "b"))


def test_every_aggregate_combines_before_its_shuffle(written):
    for df in (rollup.profile_rollup(written), rollup.pair_rollup(written), graph.graph_degree(graph.host_links(written)),
               hosts.top_targeted_ips(written), distributions.kpi_overview(written)):
        plan = plan_of(df)
        assert "partial_" in plan
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_top_lists_do_not_sort_everything(written):
    for df in (hosts.top_attacking_ips(written), hosts.top_targeted_ips(written),
               risk.top_risk_actors(risk.ip_risk_scores(written, ordered=False), 10)):
        assert "TakeOrderedAndProject" in plan_of(df)


def test_risk_needs_no_row_expansion(written):
    plan = plan_of(risk.ip_risk_scores(written, ordered=False))
    assert "Expand" not in plan and plan.count("Exchange hashpartitioning") == 2


def test_no_python_workers_and_no_cross_joins():
    from pathlib import Path

    import netvigil

    for path in Path(netvigil.__file__).parent.rglob("*.py"):
        if "llm" in path.parts:  # its operators say for themselves which style they use
            continue
        text = path.read_text()
        for word in ("crossJoin", "localCheckpoint", "pandas_udf", ".rdd", "toPandas"):
            assert word not in text, (path, word)
        if path.name != "windows.py":  # state with corrections has no form without Python
            assert "mapInArrow" not in text and "InPandas" not in text, path


def test_generated_code_stays_compilable(spark, capsys):
    """Methods above 8000 bytes are interpreted by the JVM and cost three times as much."""
    from netvigil import registry

    raw = registry.raw_flows(spark, "/root/testdata/sf0.001")
    clean.valid_flows(clean.typed_flows(raw)).explain("codegen")
    sizes = [int(part.split(";")[0]) for part in capsys.readouterr().out.split("maxMethodCodeSize:")[1:]]
    assert sizes and max(sizes) < 8000
