"""Fitted trees as tables against walks over single rows and against the models."""

import random

import pytest
from pyspark.ml.classification import DecisionTreeClassifier, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler, VectorIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from netvigil.ml import trees


@pytest.fixture(scope="module")
def table(spark):
    """Two numbers and a category (as MLlib's metadata tells) with three classes."""
    rng = random.Random(5)
    rows = [(float(rng.randrange(50)), rng.random(), float(rng.randrange(6))) for _ in range(400)]
    rows = [(a, b, c, float((a > 20) + (c in (1.0, 4.0) and b > 0.3))) for a, b, c in rows]
    frame = VectorAssembler(inputCols=["a", "b", "c"], outputCol="raw").transform(
        spark.createDataFrame(rows, "a double, b double, c double, label double"))
    return VectorIndexer(inputCol="raw", outputCol="features", maxCategories=8).fit(frame).transform(frame)


MODELS = [lambda: DecisionTreeClassifier(maxDepth=4, seed=1), lambda: RandomForestClassifier(numTrees=7, maxDepth=3, seed=1)]


@pytest.mark.parametrize("estimator", MODELS, ids=["tree", "forest"])
def test_tables_equal_models_and_plain_walks(spark, table, estimator):
    model = estimator().fit(table)
    nodes = trees.node_table(spark, model)
    assert nodes.where("categories IS NOT NULL").count() > 0 and nodes.where("threshold IS NOT NULL").count() > 0
    depth = trees.levels(nodes)
    assert depth == max(t.depth for t in getattr(model, "trees", [model]))
    by_key = {(n.tree, n.node): n for n in nodes.collect()}
    rows = table.withColumn("row_id", F.monotonically_increasing_id())

    def walk(entries, tree):
        node = by_key[tree, 0]
        while node.left is not None:
            value = entries[node.feature]
            left = value in node.categories if node.categories is not None else value <= node.threshold
            node = by_key[tree, node.left if left else node.right]
        return node.shares

    count = len({t for t, _ in by_key})
    found = {r.row_id: r.probabilities for r in trees.votes(rows, nodes, depth, 3, "row_id").collect()}
    for r in rows.select("row_id", vector_to_array("features").alias("entries")).collect():
        shares = [walk(r.entries, tree) for tree in range(count)]
        assert found[r.row_id] == pytest.approx([sum(s[i] for s in shares) / count for i in range(3)])
    judged = trees.disagreements(model.transform(table), model, "label").collect()
    assert sum(r.scored for r in judged) == 400 and {(r.other_class, r.other_probability) for r in judged} == {(0, 0)}


def test_a_changed_model_is_noticed(table):
    tree, other = (DecisionTreeClassifier(maxDepth=d, seed=1).fit(table) for d in (4, 1))
    judged = trees.disagreements(other.transform(table), tree, "label").collect()
    assert sum(r.other_class for r in judged) > 0 and sum(r.other_probability for r in judged) > 0
