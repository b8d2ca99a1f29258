"""Model quality from one aggregate of the predictions.

The predictions are scanned once, into counts per (label, prediction). All
metrics are sums over that small matrix.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netvigil.ml.training import RANDOM_FOREST
from netvigil.sources.flows import inline_rows


def outcome_counts(predictions: DataFrame) -> DataFrame:
    """Number of rows per (label, prediction)."""
    return predictions.groupBy(
        F.col("label").cast("int").alias("label"), F.col("prediction").cast("int").alias("prediction")
    ).agg(F.count(F.lit(1)).alias("n"))


def ratio(part: Column, whole: Column) -> Column:
    """A ratio that is zero where it is undefined."""
    return F.coalesce(F.try_divide(part, whole), F.lit(0.0))


def named(name: str, label: str) -> Column:
    """The class name, or ``Unknown_<n>`` for a label without one."""
    return F.coalesce(F.col(name), F.concat(F.lit("Unknown_"), F.col(label).cast("string"))).alias(name)


def per_label(outcomes: DataFrame) -> DataFrame:
    """Support, precision, recall and F1 of every label that occurs."""
    hit = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(F.lit(0))
    zero = F.lit(0).cast("long")
    sides = outcomes.select(F.explode(F.array(
        F.struct(F.col("label").alias("label"), F.col("n").alias("actual"),
                 zero.alias("predicted"), hit.alias("hits")),
        F.struct(F.col("prediction").alias("label"), zero.alias("actual"),
                 F.col("n").alias("predicted"), zero.alias("hits")),
    )).alias("s")).select("s.*")
    sums = sides.groupBy("label").agg(
        F.sum("actual").alias("support"), F.sum("predicted").alias("predicted"), F.sum("hits").alias("hits")
    )
    rated = sums.select(
        "label", "support", "hits",
        ratio(F.col("hits"), F.col("predicted")).alias("precision"),
        ratio(F.col("hits"), F.col("support")).alias("recall"),
    )
    p, r = F.col("precision"), F.col("recall")
    return rated.withColumn("f1_score", ratio(2 * p * r, p + r))


def overall_metrics(outcomes: DataFrame) -> DataFrame:
    """Accuracy and support-weighted F1, precision and recall."""
    weighted = lambda name: F.round(
        ratio(F.sum(F.col(name) * F.col("support")), F.sum("support")), 4).alias(name)
    return per_label(outcomes).agg(
        F.round(ratio(F.sum("hits"), F.sum("support")), 4).alias("accuracy"),
        weighted("f1_score"), weighted("precision"), weighted("recall"),
        F.sum("support").alias("test_rows"),
    )


def class_report(outcomes: DataFrame, labels: DataFrame) -> DataFrame:
    """Precision, recall and F1 per class name; classes that never occur get zeros, unknown labels a row each."""
    rated = per_label(outcomes)
    four = lambda name: F.round(F.coalesce(F.col(name), F.lit(0.0)), 4).alias(name)
    return labels.join(rated, "label", "full").select(
        named("attack_type", "label"), F.coalesce("support", F.lit(0)).alias("support"),
        four("precision"), four("recall"), four("f1_score"),
    )


def confusion_matrix(outcomes: DataFrame, class_names: list[str]) -> DataFrame:
    """Counts for every pair of (actual, predicted) class names, zeros included.

    Labels without a name, such as those of classes that were not in training,
    add a row for each pair in which they occur, so the sum is the number of rows.
    """
    known = inline_rows(outcomes.sparkSession, list(enumerate(class_names)), "label int, name string")
    grid = known.select("label", F.explode(F.sequence(F.lit(0), F.lit(len(class_names) - 1))).alias("prediction"))
    cells = grid.join(outcomes, ["label", "prediction"], "full")
    # A cell outside the grid has no names yet; each of its labels may still have one.
    named_actual = cells.join(known.select("label", F.col("name").alias("actual_name")), "label", "left")
    both = named_actual.join(
        known.select(F.col("label").alias("prediction"), F.col("name").alias("predicted_name")), "prediction", "left")
    return both.select(
        named("actual_name", "label").alias("actual"), named("predicted_name", "prediction").alias("predicted"),
        F.coalesce("n", F.lit(0)).alias("n"))


def model_metrics(outcomes_by_model: dict[str, DataFrame], seconds: dict[str, float]) -> DataFrame:
    """One row per model; the best one has the highest F1, the forest winning ties."""
    rows = [
        overall_metrics(outcomes).select(
            F.lit(name).alias("model"), "*", F.lit(round(seconds[name], 2)).alias("training_time_s")
        )
        for name, outcomes in outcomes_by_model.items()
    ]
    compared = reduce(DataFrame.unionByName, rows)
    best = compared.orderBy(F.desc("f1_score"), F.desc(F.col("model") == RANDOM_FOREST)).limit(1)
    flags = best.select("model", F.lit(True).alias("best"))
    return compared.join(F.broadcast(flags), "model", "left").withColumn(
        "best", F.coalesce("best", F.lit(False))
    )


def metrics_document(metrics: DataFrame, matrix: DataFrame, report: DataFrame) -> DataFrame:
    """Metrics, confusion matrix and class report as one stamped document."""

    def section(df: DataFrame, name: str) -> DataFrame:
        rows = F.to_json(F.sort_array(F.collect_list(F.struct(*df.columns))))
        return df.agg(rows.alias("body")).select(F.lit(name).alias("section"), "body")

    parts = {"models": metrics, "confusion_matrix": matrix, "per_class_metrics": report}
    stacked = reduce(DataFrame.unionByName, [section(df, name) for name, df in parts.items()])
    return stacked.groupBy().pivot("section", list(parts)).agg(F.first("body")).withColumn(
        "integrated_at", F.current_timestamp()
    )
