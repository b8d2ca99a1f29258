"""Operator 7 against brute force."""

import numpy as np
import pytest

from netvigil.llm import nn_descent as nn
from netvigil.llm.common import read_table
from tests.llm.test_joins import groups_of


def brute_force(rows, threshold=0.95):
    vectors = [nn.normalised(v) for _, v in rows]
    links = [(i, j) for i in range(len(rows)) for j in range(i) if vectors[i] is not None and vectors[j] is not None
             and len(vectors[i]) == len(vectors[j]) and (vectors[i] @ vectors[j] >= threshold or list(rows[i][1]) == list(rows[j][1]))]
    counts = [0] * len(rows)
    for i, j in links:
        counts[i] += 1
        counts[j] += 1
    groups = groups_of(range(len(rows)), links)
    smallest = {}
    for i, (vec_id, _) in enumerate(rows):
        if vec_id is not None:
            smallest[groups[i]] = min(vec_id, smallest.get(groups[i], vec_id))
    return sorted([(vec_id, counts[i], smallest.get(groups[i]), vec_id == smallest.get(groups[i]))
                   for i, (vec_id, _) in enumerate(rows)], key=str)


def test_links_by_brute_force(spark):
    pick = np.random.default_rng(4)
    rows = []

    def add(vector):
        rows.append((len(rows) * 3 % 1009, None if vector is None else [None if v is None else float(v) for v in vector]))

    for size in [1] * 150 + [2] * 20 + [3, 9, 40, 130]:
        base = pick.standard_normal(16)
        for _ in range(size):
            add(base + pick.standard_normal(16) * pick.choice([0.02, 0.1, 0.2]))
    copy = rows[5][1]
    for _ in range(30):
        add(copy)
    for odd in (None, [], [0.0] * 16, [1.0, None] * 8, [float("nan")] * 16, [float("inf")] + [1.0] * 15, [1e-300] * 16,
                [1e300] * 16, [1.0, 2.0], [2.0, 4.0], [2.0, 4.0], [5.0]):
        add(odd)
    docs = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<double>, id string, size int")
    got = sorted((tuple(r) for r in nn.link_vectors(docs).collect()), key=str)
    assert got == brute_force(rows)
    assert nn.link_vectors(docs.limit(0)).count() == 0
    assert nn.link_vectors(docs.where("embedding IS NULL")).count() == 1


def test_blocks_and_labels(spark):
    """Components of many blocks, and chains in which most pairs do not link."""
    angles = [0.2 * i for i in range(25)] + [0.01 * i + 10 for i in range(40)]
    rows = [(i, [float(np.cos(a)), float(np.sin(a))]) for i, a in enumerate(angles)]
    points = spark.createDataFrame([(i, i, 2, 1, bytearray(nn.normalised(v).tobytes())) for i, v in rows],
                                   "id long, rep long, dim int, size long, vector binary")
    grouped = spark.createDataFrame([(i, 0) for i, _ in rows], "vertex long, component long")
    counts = {}
    for r in nn.links_within(points, grouped, 0.95, block=6).collect():
        counts[r.id] = counts.get(r.id, 0) + r.n_links
    want = {i: c for i, c, *_ in brute_force(rows) if c}
    assert counts == want
    assert nn.local_components(np.array([[0, 1, 0], [1, 0, 0], [0, 0, 0]], bool)).tolist() == [0, 0, 2]


def test_recall_on_the_small_table(spark):
    table = read_table(spark, "/root/testdata/sf0.01", "embeddings")
    rows = [(r.vec_id, r.embedding) for r in table.collect()]
    want = {i: (c, g) for i, c, g, _ in brute_force(rows)}
    got = {r.vec_id: (r.n_links, r.component_id) for r in nn.link_vectors(table).collect()}
    assert got.keys() == want.keys()
    assert sum(c for c, _ in got.values()) >= 0.9 * sum(c for c, _ in want.values())
    assert all(c <= want[i][0] for i, (c, _) in got.items())


@pytest.mark.parametrize("values", [None, [], [0.0], [None, 1.0], [float("nan")], [float("-inf")]])
def test_vectors_that_link_with_nothing(values):
    assert nn.normalised(values) is None


def test_full_lists_hide_no_component(spark):
    """Two groups of close copies that link with each other: every list is full of the own group."""
    pick = np.random.default_rng(21)
    first = np.eye(16)[0]
    second = 0.96 * first + np.sqrt(1 - 0.96 ** 2) * np.eye(16)[1]
    rows = [(i, (base + pick.standard_normal(16) * 1e-4).tolist()) for i, base in enumerate([first, second] * 50)]
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted((tuple(r) for r in nn.link_vectors(docs, attempts=1).collect()), key=str)
    assert got == brute_force(rows) and {r[1] for r in got} == {99}


def test_short_recall_is_an_error(spark, monkeypatch):
    rows = [(i, np.eye(8)[i // 2].tolist() if i % 2 else (np.eye(8)[i // 2] + 0.01).tolist()) for i in range(16)]
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    nothing = spark.createDataFrame([], "vertex long, component long")
    monkeypatch.setattr(nn, "linked_groups", lambda *_: nothing)
    with pytest.raises(RuntimeError, match="links found"):
        nn.link_vectors(docs)


def test_audit_counts_rare_links():
    assert nn.is_short([(10_000, 200, 0, 3), (50, 50, 100, 100)], 0.97)
    assert not nn.is_short([(10_000, 200, 0, 0), (50, 50, 100, 100)], 0.97)
