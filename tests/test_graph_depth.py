"""Levels of attack graphs against plain searches, with cycles, loops and graphs kept apart."""

import random

import pytest

from netvigil.operators import graph
from netvigil.operators.graph_depth import graph_depth, graph_levels


def search(hops, entries):
    level, frontier = {host: 0 for host in entries}, set(entries)
    while frontier:
        found = {b for a, b in hops if a in frontier} - set(level)
        level |= {host: 1 + max(level[h] for h in frontier) for host in found}
        frontier = found
    return level


def plain_levels(links):
    hops = {(a, b) for a, b in links if a != b}
    hosts = {h for hop in hops for h in hop}
    level = search(hops, hosts - {b for _, b in hops})
    rest = hosts - set(level)
    among = {(a, b) for a, b in hops if a in rest and b in rest}
    reaches = {h: set(search(among, [h])) for h in rest}
    entries = [h for h in rest if not any(h in reaches[r] for r in rest if r < h)]
    return level | search(among, entries)


def frame(spark, links):
    return spark.createDataFrame(links, "source_ip string, destination_ip string")


@pytest.mark.parametrize("links, depth", [
    ([("a", "p"), ("p", "a")], 1),
    ([("a", "b"), ("b", "c"), ("c", "d"), ("d", "e")], 4),
    ([("a", "b"), ("b", "c"), ("c", "a")], 2),
    ([("a", "a")], 0),
    ([], 0),
    ([("x", "p"), ("p", "q"), ("q", "p"), ("x", "t"), ("p", "p")], 2),
])
def test_depth(spark, links, depth):
    assert graph_depth(frame(spark, links)).first()["max_depth"] == depth
    levels = {r.host: r.level for r in graph_levels(frame(spark, links)).collect()}
    assert levels == plain_levels(links)


def test_summary_counts_real_hops(make_flows):
    chain = [dict(source_ip=a, destination_ip=b) for a, b in ("ab", "bc", "cd", "de")]
    assert graph.graph_summary(graph.host_links(make_flows(*chain))).first()["max_depth"] == 4


def test_random_graphs_apart_equal_a_plain_search(spark):
    rng = random.Random(8)
    rows, want = [], {}
    for number in range(12):
        links = [(f"h{rng.randrange(14)}", f"h{rng.randrange(14)}") for _ in range(rng.randrange(1, 30))]
        rows += [(number, a, b) for a, b in links]
        want |= {(number, host): level for host, level in plain_levels(links).items()}
    rows += [(None, "h1", "h2"), (0, *rows[0][1:])]
    links = spark.createDataFrame(rows, "graph int, source_ip string, destination_ip string")
    levels = graph_levels(links, ["graph"])
    assert {(r.graph, r.host): r.level for r in levels.collect()} == want
    depth = {r.graph: r.max_depth for r in graph_depth(links, ["graph"]).collect()}
    assert depth == {g: max(v for (n, _), v in want.items() if n == g) for g in {g for g, _ in want}}
