"""Tree classifiers."""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier, RandomForestClassifier
from pyspark.sql import DataFrame

# Model settings.
SEED, TREE_DEPTH, FOREST_TREES, FOREST_DEPTH = 42, 5, 20, 7
DECISION_TREE, RANDOM_FOREST = "decision_tree", "random_forest"


def classifier(kind: str):
    common = {"labelCol": "label", "featuresCol": "features", "seed": SEED}
    if kind == DECISION_TREE:
        return DecisionTreeClassifier(maxDepth=TREE_DEPTH, **common)
    if kind == RANDOM_FOREST:
        return RandomForestClassifier(numTrees=FOREST_TREES, maxDepth=FOREST_DEPTH, **common)
    raise ValueError(f"unknown classifier {kind!r}")


@dataclass
class Trained:
    kind: str
    model: object
    seconds: float


def train(training_set: DataFrame, kind: str) -> Trained:
    """Fit one classifier on the training part of a feature table."""
    started = time.perf_counter()
    model = classifier(kind).fit(training_set.select("label", "features"))
    return Trained(kind, model, time.perf_counter() - started)


def scoring_pipeline(features: PipelineModel, trained: Trained) -> PipelineModel:
    """Indexing, assembling, scaling and the classifier as one model, for flows as they come."""
    return PipelineModel(stages=[*features.stages, trained.model])


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
