"""Toxicity learnt from confirmed toxic texts and unlabelled texts only.

A linear model over the words of a text (their presence, and the presence of
their first four letters) is fitted in numpy with the non-negative
positive-unlabelled risk: the risk of the negative class is estimated as the
unlabelled texts' risk less the class prior times the toxic texts' risk, and
where this estimate falls below zero, the step goes the other way, which keeps
the model from learning the unlabelled toxic texts by heart. Labels 0 serve only
to estimate the class prior.

Features are counted on whole texts. The model is fitted on the driver from at
most ``positives`` toxic and ``unlabelled`` other texts (those with the smallest
hash of their id), over at most ``vocabulary`` features, which Spark counts and
chooses among these texts; everything else covers all rows.

Results of ``score`` (one row per row of the input):

* a null text counts as empty; an empty text gets the score of a text without known words;
* repeated rows are scored each for itself and alike; null ids stay and are not held out;
* labels that are null are left out; of several labels of one id the largest counts;
* without any toxic label every score is 0;
* an empty table gives an empty table; of the input only the two named columns are read.
"""

from __future__ import annotations

import math
import re
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from netvigil.llm.common import batches_of, column_of, held_out, kept, read_table, small_batches

POSITIVES, UNLABELLED, VOCABULARY = 4_000, 12_000, 5_000
MODULUS, REMAINDER = 5, 0
TOXIC = 0.5
LEAST_TOXIC, LEAST_Z = 3, 4.0
STEPS, RATE, DECAY, RETURN = 250, 0.05, 1e-4, 1.0
STEM = 4
SCORES = "doc_id long, score double"

_word = re.compile(r"[^\W\d_]+")


def word_features(word: str) -> tuple[str, ...]:
    """The word itself, and its beginning if it is longer; beginnings end in a mark that no word has."""
    return (word, word[:STEM] + "*") if len(word) > STEM else (word,)


def words_of(text: str | None) -> set[str]:
    return set(_word.findall((text or "").lower()))


class Model(NamedTuple):
    """Log-odds of a text: ``base`` plus the weights of its features."""

    base: float
    weights: dict[str, float]

    def score(self, text: str | None) -> float:
        words = words_of(text)
        found = [self.weights[w] for w in words if w in self.weights]
        stems = {word[:STEM] + "*" for word in words if len(word) > STEM}
        found += [self.weights[s] for s in stems if s in self.weights]
        total = math.fsum([self.base, *found])  # exact, so in any order of the words alike
        return float(1 / (1 + math.exp(-min(max(total, -30.0), 30.0))))


def choose_features(featured: DataFrame, limit: int) -> list[str]:
    """The features that are most clearly more frequent among toxic texts than among the others, at most ``limit``."""
    sizes = featured.agg(F.sum("label").alias("toxic"), F.count("*").alias("all")).first()
    n_toxic, n_other = max(1, sizes["toxic"] or 0), max(1, (sizes["all"] or 0) - (sizes["toxic"] or 0))
    counts = featured.select("label", F.explode("features").alias("feature")).groupBy("feature").agg(
        F.sum("label").alias("own"), F.sum(1 - F.col("label")).alias("other")).where(F.col("own") >= LEAST_TOXIC)
    p = (F.col("own") + F.col("other")) / (n_toxic + n_other)
    z = (F.col("own") / n_toxic - F.col("other") / n_other) / F.sqrt(p * (1 - p) * (1 / n_toxic + 1 / n_other) + 1e-12)
    return [r["feature"] for r in counts.withColumn("z", z).where(F.col("z") >= LEAST_Z).orderBy(
        F.desc("z"), "feature").limit(limit).collect()]


def fit(texts: list[list[int]], toxic: np.ndarray, names: list[str], prior: float) -> Model:
    """Non-negative positive-unlabelled learning with logistic loss and Adam steps.

    ``texts`` has for each text the numbers of its features among ``names``.
    """
    if not toxic.any():
        return Model(-60.0, {})
    rows = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    flat = np.array([f for t in texts for f in t], np.int64)
    weights = np.zeros(len(names) + 1)
    weights[-1] = np.log(prior / (1 - prior))
    moment, square = np.zeros_like(weights), np.zeros_like(weights)
    n_toxic, n_other = int(toxic.sum()), max(1, int((~toxic).sum()))
    for step in range(1, STEPS + 1):
        z = weights[-1] + np.bincount(rows, weights[flat], len(texts))
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        negative = np.logaddexp(0, z)  # loss if called not toxic
        other_risk = negative[~toxic].sum() / n_other - prior * negative[toxic].sum() / n_toxic
        if other_risk >= 0:
            slope = np.where(toxic, -prior * (1 - p) / n_toxic - prior * p / n_toxic, p / n_other)
        else:  # the estimate cannot be right: undo what made it negative
            slope = RETURN * np.where(toxic, prior * p / n_toxic, -p / n_other)
        gradient = np.append(np.bincount(flat, slope[rows], len(names)), slope.sum())
        gradient[:-1] += DECAY * weights[:-1]
        moment = 0.9 * moment + 0.1 * gradient
        square = 0.999 * square + 0.001 * gradient**2
        weights -= RATE * (moment / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
        np.maximum(weights[:-1], 0, out=weights[:-1])  # a harmless word is no excuse for a toxic one
    return Model(float(weights[-1]), dict(zip(names, weights.tolist())))


def train(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text",
          label_column: str = "toxic", positives: int = POSITIVES, unlabelled: int = UNLABELLED,
          vocabulary: int = VOCABULARY, modulus: int = MODULUS, remainder: int = REMAINDER) -> Model:
    small_batches(docs.sparkSession)
    own = labels.select(column_of(labels, id_column, "long").alias("__nv_id"),
                        column_of(labels, label_column, "int").alias("__nv_label"))
    own = own.where(F.col("__nv_id").isNotNull() & F.col("__nv_label").isNotNull()
                    & ~held_out(F.col("__nv_id"), modulus, remainder))
    own = own.groupBy("__nv_id").agg(F.max("__nv_label").alias("__nv_label"))
    shares = own.agg(F.sum("__nv_label").alias("toxic"), F.count("*").alias("all")).first()
    prior = min(max((shares["toxic"] or 0) / max(1, shares["all"]), 1e-3), 0.9)

    toxic = own.where("__nv_label = 1").orderBy(F.xxhash64("__nv_id"), "__nv_id").limit(positives).select("__nv_id")
    key = column_of(docs, id_column, "long")
    others = docs.select(key.alias("__nv_id")).where(
        F.col("__nv_id").isNotNull() & ~held_out(F.col("__nv_id"), modulus, remainder))
    others = others.orderBy(F.xxhash64("__nv_id", F.lit(1)), "__nv_id").limit(unlabelled)
    chosen = toxic.withColumn("__nv_label", F.lit(1)).unionAll(others.withColumn("__nv_label", F.lit(0)))
    rows = docs.join(F.broadcast(chosen), key == F.col("__nv_id"))
    schema = "label long, features array<string>"

    def measure(batches):
        for batch in batches:
            yield from batches_of([[(label, sorted({f for w in words_of(text) for f in word_features(w)}))
                                    for label, text in zip(*(c.to_pylist() for c in batch.columns))]], schema)

    featured = kept(rows.select(F.col("__nv_label").cast("long"), column_of(rows, text_column, "string")).mapInArrow(
        measure, schema))
    names = choose_features(featured, vocabulary)
    index = {name: i for i, name in enumerate(names)}
    numbers = "label long, numbers array<long>"

    def number(batches):
        for batch in batches:
            yield from batches_of([[(label, [index[f] for f in features if f in index])
                                    for label, features in zip(*(c.to_pylist() for c in batch.columns))]], numbers)

    found = sorted((r["label"], r["numbers"]) for r in featured.mapInArrow(number, numbers).collect())  # a row per sampled text
    return fit([f for _, f in found], np.array([bool(label) for label, _ in found], bool), names, prior)


def score(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, score) of every row."""
    small_batches(docs.sparkSession)

    def run(batches):
        for batch in batches:
            ids, texts = (c.to_pylist() for c in batch.columns)
            yield from batches_of([[(i, model.score(t)) for i, t in zip(ids, texts)]], SCORES)

    return docs.select(column_of(docs, id_column, "long").alias("doc_id"),
                       column_of(docs, text_column, "string").alias("text")).mapInArrow(run, SCORES)


def not_toxic(docs: DataFrame, model: Model, text_column: str = "text", below: float = TOXIC) -> DataFrame:
    """The rows of ``docs`` whose text scores below ``below``, with their columns."""
    small_batches(docs.sparkSession)

    @F.pandas_udf("double")
    def own_score(texts):
        import pandas as pd

        return pd.Series([model.score(t) for t in texts], dtype=float)

    return docs.where(own_score(column_of(docs, text_column, "string")) < below)


def op2_pu_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = train(docs, read_table(spark, sf_dir, "labels"))
    return score(docs, model).select(
        "doc_id", held_out(F.col("doc_id"), MODULUS, REMAINDER).alias("held_out"), "score",
        (F.col("score") >= TOXIC).cast("int").alias("predicted"))
