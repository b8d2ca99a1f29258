"""Text quality by a generalised additive model with pairwise interactions.

Each feature's contribution is a lookup table over its bins, learnt by cyclic
boosting: round after round, every feature in turn gets a small step of a
shallow tree fitted to the current residuals over its bins. Then the pairs of
features that explain most of what is left get two-dimensional tables in the
same way. A score is the sum of table entries, passed through the logistic
function, so scoring is a vectorised look-up.

Features are measured on whole texts, per Arrow batch. The model is fitted on
the driver from at most ``sample`` labelled rows (those with the smallest hash of
their id); everything else covers all rows.

Results of ``score`` (one row per row of the input):

* a null text counts as empty; an empty text has all features 0 and gets a score like any other;
* repeated rows are scored each for itself and alike; null ids stay and are not held out;
* labels that are null are left out; of several labels of one id the largest counts;
* without labels of both classes every score is the smoothed share of label 1;
* an empty table gives an empty table; of the input only the two named columns are read.
"""

from __future__ import annotations

from collections import Counter
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from netvigil.llm.chunks import for_this_worker
from netvigil.llm.common import batches_of, column_of, held_out, read_table, small_batches

SAMPLE = 20_000
MODULUS, REMAINDER = 4, 2
ACCEPTED = 0.7
BINS, PAIR_BINS = 32, 8
ROUNDS, PAIR_ROUNDS, PAIRS = 200, 60, 6
RATE, LEAVES, LEAST_ROWS, SHRINK = 0.1, 3, 20, 1.0
SCORES = "doc_id long, score double"

FEATURES = ("log_chars", "log_words", "mean_word", "long_words", "distinct_words", "top_word", "repeated_next",
            "distinct_pairs", "upper", "digits", "marks", "odd_marks", "odd_words", "spaces", "capital_words",
            "upper_words", "line_chars", "distinct_lines", "bare_lines", "short_words")
_SENTENCE_MARKS = ".,;:'\"-"


def _character_classes() -> np.ndarray:
    """Per code point below 2**16: 1 upper, 2 digit, 4 sentence mark, 8 other mark, 16 white space."""
    classes = np.zeros(1 << 16, np.uint8)
    for code in range(1 << 16):
        c = chr(code)
        classes[code] = (c.isupper() + 2 * c.isdigit() + 4 * (c in _SENTENCE_MARKS) + 16 * c.isspace()
                         + 8 * (not (c.isalnum() or c.isspace() or c in _SENTENCE_MARKS or 0xD800 <= code < 0xE000)))
    return classes


def measure(text: str | None, classes: np.ndarray) -> list[float]:
    """The features of one text, in the order of ``FEATURES``."""
    words = (text or "").split()
    if not words:
        return [0.0] * len(FEATURES)
    codes = np.minimum(np.frombuffer(text.encode("utf-32-le", "replace"), "<u4"), 0xFFFF)
    share = np.bincount(classes[codes], minlength=32) / len(codes)
    kinds = np.arange(32)
    part = [float(share[: len(kinds)][kinds & flag > 0].sum()) for flag in (1, 2, 4, 8, 16)]
    n = len(words)
    counts = Counter(words)
    lengths = np.array([len(w) for w in words])
    pairs = len(set(zip(words, words[1:])))
    lines = [line for line in text.split("\n") if line.strip()]
    return [
        float(np.log1p(len(text))), float(np.log1p(n)), float(lengths.mean()), float((lengths > 12).mean()),
        len(counts) / n, max(counts.values()) / n, sum(a == b for a, b in zip(words, words[1:])) / n,
        pairs / max(1, n - 1), part[0], part[1], part[2], part[3],
        sum(not w[-1].isalnum() and w[-1] not in ".,;:" for w in words) / n, part[4],
        sum(w[0].isupper() for w in words) / n, sum(w.isupper() and len(w) > 1 for w in words) / n,
        float(np.log1p(len(text) / len(lines))), len(set(lines)) / len(lines),
        sum(line.rstrip()[-1].isalnum() for line in lines) / len(lines), float((lengths <= 3).mean()),
    ]


class Model(NamedTuple):
    """``edges[f]``: inner bin edges; ``tables[f]``: contribution per bin; ``pairs``: (f, g, edges, edges, table)."""

    base: float
    edges: list[np.ndarray]
    tables: list[np.ndarray]
    pairs: list[tuple]

    def score(self, features: np.ndarray) -> np.ndarray:
        total = np.full(len(features), self.base)
        for f, (edges, table) in enumerate(zip(self.edges, self.tables)):
            total += table[np.searchsorted(edges, features[:, f], "right")]
        for f, g, edges_f, edges_g, table in self.pairs:
            total += table[np.searchsorted(edges_f, features[:, f], "right"), np.searchsorted(edges_g, features[:, g], "right")]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def quantile_edges(values: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(values, np.arange(1, bins) / bins, method="higher"))


def _gain(gradient, weight):
    return gradient * gradient / (weight + SHRINK)


def shallow_tree(gradient: np.ndarray, weight: np.ndarray, rows: np.ndarray, leaves: int = LEAVES) -> np.ndarray:
    """Steps per bin of a tree with at most ``leaves`` leaves over ordered bins."""
    parts = [(0, len(gradient))]
    g, w, n = (np.concatenate([[0], np.cumsum(a)]) for a in (gradient, weight, rows))
    while len(parts) < leaves:
        best = None
        for p, (low, high) in enumerate(parts):
            cuts = np.arange(low + 1, high)
            cuts = cuts[(n[cuts] - n[low] >= LEAST_ROWS) & (n[high] - n[cuts] >= LEAST_ROWS)]
            if not len(cuts):
                continue
            gains = (_gain(g[cuts] - g[low], w[cuts] - w[low]) + _gain(g[high] - g[cuts], w[high] - w[cuts])
                     - _gain(g[high] - g[low], w[high] - w[low]))
            k = int(np.argmax(gains))
            if gains[k] > 1e-6 and (best is None or gains[k] > best[0]):
                best = (gains[k], p, int(cuts[k]))
        if best is None:
            break
        low, high = parts.pop(best[1])
        parts += [(low, best[2]), (best[2], high)]
    step = np.zeros(len(gradient))
    for low, high in parts:
        step[low:high] = (g[high] - g[low]) / (w[high] - w[low] + SHRINK)
    return step


def pair_step(gradient: np.ndarray, weight: np.ndarray) -> tuple[float, np.ndarray]:
    """Best cut into four quadrants of a table of sums: its gain and its step per cell."""
    g, w = (np.pad(a.cumsum(0).cumsum(1), ((1, 0), (1, 0))) for a in (gradient, weight))
    rows, columns = np.arange(1, len(gradient)), np.arange(1, gradient.shape[1])
    best, where = 0.0, None
    for r in rows:
        parts = [[a[r, columns], a[r, -1] - a[r, columns], a[-1, columns] - a[r, columns],
                  a[-1, -1] - a[r, -1] - a[-1, columns] + a[r, columns]] for a in (g, w)]
        gains = sum(_gain(pg, pw) for pg, pw in zip(*parts))
        k = int(np.argmax(gains)) if len(columns) else 0
        if len(columns) and gains[k] > best:
            best, where = float(gains[k]), (int(r), int(columns[k]))
    step = np.zeros_like(gradient, dtype=float)
    if where:
        for rs in (slice(0, where[0]), slice(where[0], None)):
            for cs in (slice(0, where[1]), slice(where[1], None)):
                step[rs, cs] = gradient[rs, cs].sum() / (weight[rs, cs].sum() + SHRINK)
    return best - _gain(gradient.sum(), weight.sum()), step


def fit(features: np.ndarray, labels: np.ndarray) -> Model:
    """Cyclic boosting of single features, then of the pairs that explain most of the rest."""
    positives, count = int(labels.sum()), len(labels)
    base = float(np.log((positives + 1) / (count - positives + 1)))
    if positives in (0, count):
        return Model(base, [np.empty(0)] * len(FEATURES), [np.zeros(1)] * len(FEATURES), [])
    y = labels.astype(float)
    edges = [quantile_edges(features[:, f], BINS) for f in range(features.shape[1])]
    bins = [np.searchsorted(e, features[:, f], "right") for f, e in enumerate(edges)]
    sizes = [np.bincount(b, minlength=len(e) + 1) for b, e in zip(bins, edges)]
    tables = [np.zeros(len(e) + 1) for e in edges]
    total = np.full(count, base)

    def residuals():
        p = 1 / (1 + np.exp(-np.clip(total, -30, 30)))
        return y - p, p * (1 - p)

    for _ in range(ROUNDS):
        for f, own in enumerate(bins):
            gradient, weight = residuals()
            size = len(tables[f])
            step = RATE * shallow_tree(np.bincount(own, gradient, size), np.bincount(own, weight, size), sizes[f])
            tables[f] += step
            total += step[own]

    gradient, weight = residuals()
    coarse = [quantile_edges(features[:, f], PAIR_BINS) for f in range(features.shape[1])]
    cells = [np.searchsorted(e, features[:, f], "right") for f, e in enumerate(coarse)]

    def sums(f, g, values):
        shape = len(coarse[f]) + 1, len(coarse[g]) + 1
        return np.bincount(cells[f] * shape[1] + cells[g], values, shape[0] * shape[1]).reshape(shape)

    ranked = sorted(((pair_step(sums(f, g, gradient), sums(f, g, weight))[0], f, g)
                     for f in range(len(bins)) for g in range(f)), reverse=True)[:PAIRS]
    pairs = [(f, g, coarse[f], coarse[g], np.zeros((len(coarse[f]) + 1, len(coarse[g]) + 1))) for _, f, g in ranked]
    for _ in range(PAIR_ROUNDS):
        for f, g, _, _, table in pairs:
            gradient, weight = residuals()
            step = RATE * pair_step(sums(f, g, gradient), sums(f, g, weight))[1]
            table += step
            total += step[cells[f], cells[g]]
    return Model(base, edges, tables, pairs)


def labelled(docs: DataFrame, labels: DataFrame, id_column: str, label_column: str, sample: int,
             keep) -> DataFrame:
    """The documents of at most ``sample`` labelled ids that pass ``keep``, with their label."""
    own = labels.select(column_of(labels, id_column, "long").alias("__nv_id"),
                        column_of(labels, label_column, "int").alias("__nv_label"))
    own = own.where(F.col("__nv_id").isNotNull() & F.col("__nv_label").isNotNull() & keep(F.col("__nv_id")))
    own = own.groupBy("__nv_id").agg(F.max("__nv_label").alias("__nv_label"))
    chosen = own.orderBy(F.xxhash64("__nv_id"), "__nv_id").limit(sample)
    return docs.join(F.broadcast(chosen), column_of(docs, id_column, "long") == F.col("__nv_id"))


def measured(rows: DataFrame, key: str, text_column: str) -> DataFrame:
    """(key, features) of every row, whole texts."""
    schema = "key long, features array<double>"

    def run(batches):
        classes = for_this_worker("character classes", _character_classes)
        for batch in batches:
            yield from batches_of([[(k, measure(t, classes)) for k, t in zip(*(c.to_pylist() for c in batch.columns))]], schema)

    return rows.select(F.col(key).cast("long").alias("key"),
                       column_of(rows, text_column, "string").alias("text")).mapInArrow(run, schema)


def train(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text",
          label_column: str = "quality", sample: int = SAMPLE, modulus: int = MODULUS, remainder: int = REMAINDER) -> Model:
    small_batches(docs.sparkSession)
    rows = labelled(docs, labels, id_column, label_column, sample, lambda i: ~held_out(i, modulus, remainder))
    found = sorted(tuple(r) for r in measured(rows, "__nv_label", text_column).collect())  # at most `sample` rows
    features = np.array([r[1] for r in found], float).reshape(len(found), len(FEATURES))
    return fit(features, np.array([r[0] for r in found], np.int64))


def score(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, score) of every row."""
    small_batches(docs.sparkSession)

    def run(batches):
        classes = for_this_worker("character classes", _character_classes)
        for batch in batches:
            ids, texts = (c.to_pylist() for c in batch.columns)
            if ids:
                features = np.array([measure(t, classes) for t in texts], float)
                yield from batches_of([zip(ids, model.score(features).tolist())], SCORES)

    return docs.select(column_of(docs, id_column, "long").alias("doc_id"),
                       column_of(docs, text_column, "string").alias("text")).mapInArrow(run, SCORES)


def accepted(docs: DataFrame, model: Model, text_column: str = "text", least: float = ACCEPTED) -> DataFrame:
    """The rows of ``docs`` whose text scores at least ``least``, with their columns."""
    small_batches(docs.sparkSession)

    @F.pandas_udf("double")
    def own_score(texts):
        import pandas as pd

        classes = for_this_worker("character classes", _character_classes)
        return pd.Series(model.score(np.array([measure(t, classes) for t in texts], float).reshape(len(texts), len(FEATURES))))

    return docs.where(own_score(column_of(docs, text_column, "string")) >= least)


def op9_quality_gam(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = train(docs, read_table(spark, sf_dir, "labels"))
    return score(docs, model).select(
        "doc_id", held_out(F.col("doc_id"), MODULUS, REMAINDER).alias("held_out"), "score",
        (F.col("score") >= ACCEPTED).cast("int").alias("predicted"))
