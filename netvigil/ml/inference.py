"""Batch scoring."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netvigil.functions.temporal import as_text
from netvigil.functions.verdicts import alert_severity
from netvigil.ml.features import NUMERIC_INPUTS, class_labels
from netvigil.schema import FLOW_KEY

PREDICTION_ORDER = FLOW_KEY


def class_name(prediction: Column, labels: list[str]) -> Column:
    """Name of a predicted label; labels without a name read ``Unknown_<n>``."""
    index = prediction.cast("int")
    named = F.get(F.array(*[F.lit(name) for name in labels]), index)
    return F.coalesce(named, F.concat(F.lit("Unknown_"), index.cast("string")))


def confidence(probability: str = "probability", prediction: str = "prediction") -> Column:
    """Probability of the predicted class in percent."""
    chosen = F.get(vector_to_array(F.col(probability)), F.col(prediction).cast("int"))
    return F.round(chosen * 100, 2)


def name_predictions(scored: DataFrame, labels: list[str]) -> DataFrame:
    """The prediction record of every scored flow."""
    named = scored.select(
        F.coalesce(as_text(F.col("timestamp")), as_text(F.current_timestamp())).alias("timestamp"),
        "source_ip", "destination_ip", F.col("attack_type").alias("actual_attack"),
        class_name(F.col("prediction"), labels).alias("predicted_attack"),
        confidence().alias("confidence"),
    )
    return named.withColumn(
        "severity", alert_severity(F.col("predicted_attack"), F.col("confidence"))
    )


def scorable(flows: DataFrame) -> DataFrame:
    """Flows that have a feature vector: every numeric input is known."""
    return flows.dropna(subset=NUMERIC_INPUTS)


def predict(flows: DataFrame, model: PipelineModel, limit: int | None = None) -> DataFrame:
    """Score flows; with ``limit``, the first scorable ones by time, source and destination.

    The sample is drawn before the model runs, so only its rows are scored.
    """
    chosen = flows if limit is None else scorable(flows).orderBy(*PREDICTION_ORDER).limit(limit)
    return name_predictions(model.transform(chosen), class_labels(model))
