"""Clean flows to labelled feature vectors."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from netvigil.functions.hashing import md5_mod
from netvigil.functions.temporal import as_text
from netvigil.sources.flows import inline_rows

# Feature order. Severity follows from the class in most logs, so
# a caller who wants to avoid that leak passes a shorter list.
FEATURES = ["flow_duration", "packet_length", "total_bytes", "packet_count",
            "hour", "day_of_week", "protocol_index", "severity_index"]
INDEXED = {"protocol": "protocol_index", "severity": "severity_index", "attack_type": "label"}
NUMERIC_INPUTS = FEATURES[:6]
CARRIED = ["timestamp", "source_ip", "destination_ip", "attack_type"]
BUCKET = "split_bucket"


def feature_pipeline(features: list[str] = FEATURES) -> Pipeline:
    """Index categories, assemble, scale. One indexer stage counts all categories in one pass."""
    return Pipeline(stages=[
        StringIndexer(inputCols=list(INDEXED), outputCols=list(INDEXED.values()),
                      stringOrderType="frequencyDesc", handleInvalid="keep"),
        VectorAssembler(inputCols=features, outputCol="raw_features", handleInvalid="skip"),
        StandardScaler(inputCol="raw_features", outputCol="features", withMean=False, withStd=True),
    ])


def fit_features(flows: DataFrame, features: list[str] = FEATURES) -> PipelineModel:
    return feature_pipeline(features).fit(flows)


def class_labels(model: PipelineModel) -> list[str]:
    """Class names by label index."""
    position = list(INDEXED).index("attack_type")
    return list(model.stages[0].labelsArray[position])


def label_map(spark: SparkSession, model: PipelineModel) -> DataFrame:
    return inline_rows(spark, list(enumerate(class_labels(model))), "label int, attack_type string")


def split_bucket(seed: int = 42):
    """0-99 from the flow key, so the split is the same on every run and file layout."""
    key = F.concat_ws(
        "|", as_text(F.col("timestamp")), "source_ip", "destination_ip", "protocol",
        F.col("flow_duration").cast("string"), F.col("total_bytes").cast("string"), F.lit(str(seed)),
    )
    return md5_mod(key, 100).cast("int")


def feature_table(model: PipelineModel, flows: DataFrame, seed: int = 42) -> DataFrame:
    """Vectors with their label; ``split_bucket`` decides training or test set."""
    return model.transform(flows.withColumn(BUCKET, split_bucket(seed))).select(
        *CARRIED, "label", "raw_features", "features", BUCKET
    )


def training_part(table: DataFrame, percent: int = 80) -> DataFrame:
    return table.where(F.col(BUCKET) < percent)


def test_part(table: DataFrame, percent: int = 80) -> DataFrame:
    return table.where(F.col(BUCKET) >= percent)


def held_out_flows(flows: DataFrame, percent: int = 80, seed: int = 42) -> DataFrame:
    """The flows that land in the test part."""
    return flows.where(split_bucket(seed) >= percent)


def split_counts(flows: DataFrame, percent: int = 80, seed: int = 42) -> DataFrame:
    """Sizes of both parts per class."""
    part = F.when(split_bucket(seed) < percent, "train").otherwise("test")
    return flows.groupBy(part.alias("part"), "attack_type").agg(F.count(F.lit(1)).alias("flows"))


def vector_columns(table: DataFrame, vector: str, names: list[str] = FEATURES) -> list:
    """The entries of a vector column as separate double columns."""
    entries = vector_to_array(F.col(vector))
    return [F.get(entries, F.lit(i)).alias(name) for i, name in enumerate(names)]


def vector_size(vector: str):
    return F.size(vector_to_array(F.col(vector)))
