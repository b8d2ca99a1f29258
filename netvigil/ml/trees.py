"""Tree classifiers as tables: one row per node, evaluated by joins level by level.

Predictions of a fitted tree or forest can be checked, explained or made where
MLlib is not at hand: rows start at the root of every tree and move to a child by
a join on (tree, node) per level, until all stand on leaves.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from netvigil.session import fresh_path, materialize

TOLERANCE = 1e-9


def node_table(spark: SparkSession, model) -> DataFrame:
    """The nodes of a fitted tree or forest as a written table, read from its saved form.

    ``left`` and ``right`` are NULL in a leaf. A split on a number goes left up to ``threshold``, one on a
    category for those in ``categories``. ``shares`` are the shares of the classes among the training rows.
    """
    path = fresh_path(spark, "model")
    model.write().save(path)
    saved = spark.read.parquet(f"{path}/data")
    one = saved.select(F.col("treeID").alias("tree"), "nodeData.*") if "nodeData" in saved.columns else saved.select(
        F.lit(0).alias("tree"), "*")
    total = F.aggregate("impurityStats", F.lit(0.0), lambda a, b: a + b)
    inner, numeric = F.col("leftChild") >= 0, F.col("split.numCategories") < 0
    nodes = one.select(
        "tree", F.col("id").alias("node"), F.when(inner, F.col("leftChild")).alias("left"), F.when(inner, F.col("rightChild")).alias("right"),
        F.when(inner, F.col("split.featureIndex")).alias("feature"),
        F.when(inner & numeric, F.get("split.leftCategoriesOrThreshold", F.lit(0))).alias("threshold"),
        F.when(inner & ~numeric, F.col("split.leftCategoriesOrThreshold")).alias("categories"),
        F.transform("impurityStats", lambda n: n / total).alias("shares"))
    return materialize(nodes, "nodes")


def levels(nodes: DataFrame) -> int:
    """Levels below the roots, found from parent to child. A tree has at most some thirty."""
    children = nodes.select("tree", F.explode(F.array("left", "right")).alias("node"), F.col("node").alias("parent")).where("node IS NOT NULL")
    below, found = nodes.join(children, ["tree", "node"], "left_anti").select("tree", "node"), 0
    while True:
        below = materialize(children.join(below.withColumnRenamed("node", "parent"), ["tree", "parent"], "left_semi").select(
            "tree", "node"), "level")
        if below.isEmpty():
            return found
        found += 1


def leaf_shares(rows: DataFrame, nodes: DataFrame, depth: int, features: str = "features") -> DataFrame:
    """Every row with every tree and the class shares of the leaf it ends on (``tree``, ``shares``).

    The node table is read from files, so the optimizer knows its size and chooses the joins by it.
    """
    children = nodes.select("tree", F.explode(F.array("left", "right")).alias("node")).where("node IS NOT NULL")
    roots = nodes.select("tree", "node").join(children, ["tree", "node"], "left_anti").collect()  # one per tree
    every = F.array(*[F.struct(F.lit(r.tree).alias("tree"), F.lit(r.node).alias("node")) for r in roots])
    moving = rows.select("*", vector_to_array(F.col(features)).alias("entries"), F.explode(every).alias("root")).select(
        *rows.columns, "entries", "root.*")
    splits = nodes.select("tree", "node", "left", "right", "feature", "threshold", "categories")
    value = F.get("entries", F.col("feature"))
    goes_left = F.when(F.col("categories").isNotNull(), F.array_contains("categories", value)).otherwise(value <= F.col("threshold"))
    for _ in range(depth):
        at = moving.join(splits, ["tree", "node"])
        child = F.when(F.col("left").isNull(), F.col("node")).when(goes_left, F.col("left")).otherwise(F.col("right"))
        moving = at.select(*rows.columns, "entries", "tree", child.alias("node"))
    return moving.join(nodes.select("tree", "node", "shares"), ["tree", "node"]).select(*rows.columns, "tree", "shares")


def votes(rows: DataFrame, nodes: DataFrame, depth: int, classes: int, key: str, features: str = "features") -> DataFrame:
    """(key, probabilities): the mean of the leaves' shares over all trees, as the model averages them."""
    standing = leaf_shares(rows.select(key, features), nodes, depth, features)
    return standing.groupBy(key).agg(F.array(*[F.avg(F.get("shares", F.lit(i))) for i in range(classes)]).alias("probabilities"))


def disagreements(scored: DataFrame, model, group: str) -> DataFrame:
    """Per ``group``: scored rows, and those on which the node table and the model disagree.

    ``scored`` has the model's ``features``, ``prediction`` and ``probability``. Two classes with the same
    probability (within rounding) may both be predicted.
    """
    spark = scored.sparkSession
    nodes = node_table(spark, model)
    rows = materialize(scored.select(group, "features", "prediction", vector_to_array("probability").alias("probability")).withColumn(
        "row_id", F.monotonically_increasing_id()), "scored")
    found = votes(rows, nodes, levels(nodes), model.numClasses, "row_id")
    both = rows.join(found, "row_id", "left")
    chosen = F.get("probabilities", F.col("prediction").cast("int"))
    other_class = F.coalesce(chosen < F.array_max("probabilities") - TOLERANCE, F.lit(True))
    apart = F.array_max(F.transform(F.arrays_zip("probability", "probabilities"), lambda p: F.abs(p["probability"] - p["probabilities"])))
    return both.groupBy(group).agg(
        F.count(F.lit(1)).alias("scored"), F.count_if(other_class).alias("other_class"),
        F.count_if(F.coalesce(apart > TOLERANCE, F.lit(True))).alias("other_probability"))
