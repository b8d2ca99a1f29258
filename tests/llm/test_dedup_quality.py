"""Operators 6 and 9."""

import zlib

import numpy as np
import pytest

from netvigil.llm import exact_dedup, quality_gam
from netvigil.llm.common import read_table

SF_DIR = "/root/testdata/sf0.01"


def test_exact_dedup_by_brute_force(spark):
    texts = ["a", "A", "a ", None, "", "b", "a", "a", "b", None] + ["hot"] * 50 + [f"t{i % 7}" for i in range(30)]
    rows = [(i, t, i, "x") for i, t in enumerate(texts)] + [(None, "b", 1, "x"), (None, "only null", 1, "x"), (49, "hot", 2, "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept long, keep_id string")
    groups = {}
    for row in rows:
        groups.setdefault(row[1] or "", []).append(row[0])
    keep = {t: max((i for i in ids if i is not None), default=None) for t, ids in groups.items()}
    for heavy, tracked in ((256, 4096), (1, 64)):  # with one heavy digest the others take the shuffle
        got = exact_dedup.decide(docs, heavy=heavy, tracked=tracked).collect()
        want = [(i, keep[t or ""], len(groups[t or ""]), i == keep[t or ""]) for i, t, *_ in rows]
        assert sorted((tuple(r)[:4] for r in got), key=str) == sorted(want, key=str)
        left = exact_dedup.deduplicate(docs, heavy=heavy, tracked=tracked)
        assert left.columns == docs.columns
        assert sorted(map(tuple, left.collect()), key=str) == sorted((r for r in rows if r[0] == keep[r[1] or ""]), key=str)
    assert exact_dedup.decide(docs.limit(0)).count() == 0
    assert exact_dedup.deduplicate(docs.limit(0)).count() == 0


def test_exact_dedup_is_native(spark):
    docs = read_table(spark, SF_DIR, "documents")
    plan = exact_dedup.decide(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_shallow_tree_is_greedy_least_squares():
    gradient, weight, rows = np.array([5.0, 5, 5, -5, -5, -5]), np.ones(6) * 10, np.ones(6) * 100
    step = quality_gam.shallow_tree(gradient, weight, rows, leaves=2)
    assert step[:3] == pytest.approx(15 / 31) and step[3:] == pytest.approx(-15 / 31)
    assert (quality_gam.shallow_tree(gradient, weight, np.ones(6)) == 0).all()  # too few rows for any cut


def test_pairs_learn_what_single_features_cannot():
    pick = np.random.default_rng(1)
    features = pick.random((4000, len(quality_gam.FEATURES)))
    labels = ((features[:, 3] > 0.5) ^ (features[:, 7] > 0.5)).astype(int)
    model = quality_gam.fit(features[:3000], labels[:3000])
    assert {3, 7} in [{f, g} for f, g, *_ in model.pairs]
    assert ((model.score(features[3000:]) >= 0.5) == labels[3000:]).mean() > 0.95


def test_quality_on_held_out_labels(spark):
    docs, labels = read_table(spark, SF_DIR, "documents"), read_table(spark, SF_DIR, "labels")
    model = quality_gam.train(docs, labels)
    known = {r.doc_id: r.quality for r in labels.collect() if zlib.crc32(str(r.doc_id).encode()) % 4 == 2}
    scores = {r.doc_id: r.score for r in quality_gam.score(docs, model).collect()}
    assert len(scores) == docs.count() and all(0 <= s <= 1 for s in scores.values())
    assert np.mean([(scores[d] >= quality_gam.ACCEPTED) == q for d, q in known.items()]) > 0.97
    left = quality_gam.accepted(docs, model)
    assert left.columns == docs.columns
    assert {r.doc_id for r in left.collect()} == {d for d, s in scores.items() if s >= quality_gam.ACCEPTED}


def test_quality_of_odd_rows(spark):
    rows = [(1, "Good words here, and more of them.", 1), (2, None, 0), (2, "", 0), (None, "x", 1), (3, "\n \t", 0),
            (4, "w " * 100_000, 0), (5, "😀", 1), (5, "😀", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score long")
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, None), (None, 1), (4, 0), (9, 1)], "doc_id long, quality int")
    model = quality_gam.train(docs, labels)
    got = quality_gam.score(docs, model).collect()
    assert sorted((str(r.doc_id) for r in got)) == sorted(str(r[0]) for r in rows)
    assert all(0 <= r.score <= 1 for r in got)
    for one in (labels.limit(0), labels.where("quality = 1")):
        same = {r.score for r in quality_gam.score(docs, quality_gam.train(docs, one)).collect()}
        assert len(same) == 1
    assert quality_gam.score(docs.limit(0), model).count() == 0
    assert quality_gam.accepted(docs.limit(0), model).count() == 0
