"""Attack graph and packet-length entropy."""

import math
import random
from collections import Counter, defaultdict
from datetime import datetime, timedelta

from netvigil.operators import entropy, graph, rollup


def edges(*pairs):
    return [dict(source_ip=s, destination_ip=d) for s, d in pairs]


def test_pivot(make_flows, rows_of):
    flows = make_flows(*edges(("A", "P"), ("P", "T"), ("P", "U")), dict(source_ip="T", destination_ip="A", attack_type="BENIGN"))
    links = graph.host_links(flows)
    degree = graph.graph_degree(links)
    assert rows_of(degree) == [("A", 0, 1, "Adversary"), ("P", 1, 2, "Pivot"), ("T", 1, 0, "Target"), ("U", 1, 0, "Target")]
    assert rows_of(graph.graph_pivots(degree)) == [("P", 1, 2, 2)]
    assert tuple(graph.graph_summary(links).first()) == (4, 3, 1, 2, 2)
    assert rows_of(graph.lateral_hops(links, degree)) == [
        ("P", "egress", "T", 1), ("P", "egress", "U", 1), ("P", "ingress", "A", 1)]
    assert rows_of(graph.lateral_paths(links, ["P"]), "source_ip", "pivot", "asset") == []  # P starts no path
    assert rows_of(graph.lateral_paths(links, ["A", "P"]), "source_ip", "pivot", "asset") == [("A", "P", "T"), ("A", "P", "U")]
    labelled = graph.label_edges(graph.graph_edges(flows), degree)
    assert rows_of(labelled, "source_ip", "destination_ip", "source_role", "destination_role") == [
        ("A", "P", "Adversary", "Pivot"), ("P", "T", "Pivot", "Target"), ("P", "U", "Pivot", "Target")]


def test_graph_without_edges(make_flows):
    flows = make_flows(dict(attack_type="BENIGN"))
    assert tuple(graph.graph_summary(graph.host_links(flows)).first()) == (0, 0, 0, 0, 0)


def test_factored_paths_against_brute_force(make_flows):
    rng = random.Random(3)
    pairs = [(f"h{rng.randrange(12)}", f"h{rng.randrange(12)}") for _ in range(60)] + [(f"x{i}", "h1") for i in range(40)]
    flows = make_flows(*edges(*pairs))
    unique = set(pairs)
    expected = {(a, b, d) for a, b in unique for c, d in unique if b == c}
    links = graph.host_links(flows)
    degree = graph.graph_degree(links)
    sides = defaultdict(lambda: {"ingress": set(), "egress": set()})
    for r in graph.lateral_hops(links, degree).collect():
        sides[r["pivot"]][r["hop"]].add(r["peer"])
    rebuilt = {(a, p, d) for p, s in sides.items() for a in s["ingress"] for d in s["egress"]}
    assert rebuilt == expected
    assert graph.graph_summary(links).first()["two_hop_walks"] == len(expected)
    assert {r["host"]: r["two_hop_walks"] for r in graph.graph_pivots(degree).collect()} == dict(
        Counter(p for _, p, _ in expected))
    simple = {(a, b, d) for a, b, d in expected if len({a, b, d}) == 3}
    written = graph.lateral_paths(links, sorted({a for a, _ in unique}))
    assert {(r["source_ip"], r["pivot"], r["asset"]) for r in written.collect()} == simple


def test_graph_is_the_same_on_pairs(make_flows, rows_of):
    flows = make_flows(*edges(("A", "P"), ("A", "P"), ("P", "T")), dict(attack_type="BENIGN"))
    pairs = rollup.pair_rollup(flows)
    assert rows_of(graph.graph_edges(flows)) == rows_of(graph.graph_edges(pairs))
    assert rows_of(graph.host_links(flows)) == rows_of(graph.host_links(pairs))


def lengths(start, *values):
    return [dict(timestamp=start, packet_length=v) for v in values]


def test_entropy_of_known_distributions(make_flows):
    noon = datetime(2024, 1, 1, 12)
    rows = lengths(noon, *[7] * 33) + lengths(noon + timedelta(hours=1), *[1, 2] * 10)
    rows += lengths(noon + timedelta(hours=2), *range(256)) + [dict(timestamp=None)]
    got = [(r["flows"], r["distinct_lengths"], r["entropy"]) for r in
           entropy.packet_entropy(make_flows(*rows)).orderBy("window_start").collect()]
    assert got == [(33, 1, 0.0), (20, 2, 1.0), (256, 256, 8.0)]
    assert math.copysign(1, got[0][2]) == 1


def test_drift_against_brute_force(make_flows):
    rng, start = random.Random(8), datetime(2024, 1, 1)
    rows = [dict(timestamp=start + timedelta(minutes=30 * rng.randrange(100)), packet_length=rng.randrange(9)) for _ in range(900)]
    groups = defaultdict(Counter)
    for r in rows:
        groups[r["timestamp"].replace(minute=0)][r["packet_length"]] += 1
    h = {}
    for window, counts in sorted(groups.items()):
        n = sum(counts.values())
        h[window] = -sum(c / n * math.log2(c / n) for c in counts.values())
    windows = list(h)
    for row in entropy.entropy_drift(make_flows(*rows), windows=5).collect():
        i = windows.index(row["window_start"])
        last = [h[w] for w in windows[max(0, i - 4): i + 1]]
        assert abs(row["entropy"] - h[row["window_start"]]) < 1e-4
        assert abs(row["moving_avg"] - sum(last) / len(last)) < 1e-4
