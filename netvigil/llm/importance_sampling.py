"""Importance resampling towards a target distribution, on Arrow kernels.

Word n-grams hash into buckets. A bucket's gain is the logarithm of how much more
often the target's features fall into it than the corpus's, both smoothed by one;
a document's weight is the sum of its features' gains. Gumbel noise, drawn from a
hash of the id, turns the highest weights into a sample without replacement.

Texts never become Python strings: ``ascii_lower``, ``split_pattern_regex`` and
``list_flatten`` give the words of a block, ``dictionary_encode`` their indices.
Shifted indices form n-grams; only distinct ones are joined and hashed; gains are
taken by index and reduced per document.

The corpus is read twice: once to count buckets (at most ``BUCKETS`` rows leave a
task), once to weigh documents. Ranks come from a range partition of the scores:
rows before a partition plus the place in it, so that no task sees all documents.

Results of ``resample`` (one row per row of the input):

* a null or empty text, or one without words, has no features and the weight 0;
* texts are read whole: blocks hold whole texts, of any length;
* a null id counts as an empty text in the noise; repeated rows have the same score and ranks one after the other;
* rows of one score and one id are interchangeable; other ties go to the smaller id, null ids first;
* an empty corpus gives an empty table; an empty target gives gains by the corpus alone;
* only the named columns are read, so other columns never clash.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from netvigil.llm.common import batches_of, column_of, kept, read_table, text_blocks

# Fixed values of the contract: what separates words, the number of buckets, the seed, the share to draw, words needed.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BUCKETS = 10_000
SEED = "2024"
SHARE_PERCENT = 10
LEAST_WORDS = 20

BLOCK_BYTES = 4 << 20


@dataclass
class Features:
    """The features of a block of texts: bucket of each, and where each document's features begin (and the last end)."""

    buckets: np.ndarray
    bounds: np.ndarray
    words: np.ndarray


def block_features(texts, longest: int = 1, buckets: int = BUCKETS) -> Features:
    """All runs of 1 to ``longest`` words of every text of an Arrow array."""
    import pyarrow as pa
    import pyarrow.compute as pc

    # Copied, as the cast of a slice keeps where it began and ``ascii_lower`` then gives zero bytes for its end.
    texts = pc.ascii_lower(pa.concat_arrays([pc.fill_null(texts, "").cast(pa.large_string())]))
    split = pc.split_pattern_regex(texts, pattern=SEPARATORS)
    words, owner = pc.list_flatten(split), pc.list_parent_indices(split)
    full = pc.not_equal(words, "")  # a separator at either end of a text leaves an empty word
    encoded = words.filter(full).dictionary_encode()
    owner = owner.filter(full).to_numpy().astype(np.int64)
    index = encoded.indices.to_numpy().astype(np.int64)
    written = encoded.dictionary.cast(pa.large_binary()).to_pylist()
    count = np.bincount(owner, minlength=len(texts))

    # Per run length: its distinct runs as (run without the last word, last word), and each place's run among them.
    crcs = np.fromiter(map(zlib.crc32, written), np.int64, len(written))
    run, run_crcs, parts, owners = index, crcs, [crcs[index] % buckets], [owner]
    for length in range(2, longest + 1):
        whole = owner[length - 1:] == owner[:len(owner) - length + 1]  # within one text, as owners are in order
        pairs = (run[:len(whole)][whole] * max(1, len(written)) + index[length - 1:][whole])
        distinct, inverse = np.unique(pairs, return_inverse=True)
        first, last = np.divmod(distinct, max(1, len(written)))
        run_crcs = np.fromiter((zlib.crc32(b" " + written[w], c) for c, w in
                                zip(run_crcs[first].tolist(), last.tolist())), np.int64, len(distinct))
        run = np.zeros(len(whole), np.int64)
        run[whole] = inverse
        parts.append(run_crcs[inverse] % buckets)
        owners.append(owner[:len(whole)][whole])
    found, by = np.concatenate(parts), np.concatenate(owners)
    if longest > 1:
        found = found[np.argsort(by, kind="stable")]
    bounds = np.zeros(len(texts) + 1, np.int64)
    np.cumsum(np.bincount(by, minlength=len(texts)), out=bounds[1:])
    return Features(found, bounds, count)


def bucket_counts(table: DataFrame, longest: int = 1, buckets: int = BUCKETS, text_column: str = "text") -> np.ndarray:
    """How many features of the whole table fall into each bucket."""

    def run(batches):
        counts = np.zeros(buckets, np.int64)
        for batch in batches:
            for block in text_blocks(batch, 0, BLOCK_BYTES):
                counts += np.bincount(block_features(block.column(0), longest, buckets).buckets, minlength=buckets)
        used = np.flatnonzero(counts)
        yield from batches_of([zip(used.tolist(), counts[used].tolist())], "bucket long, n long")

    per_task = table.select(column_of(table, text_column, "string").alias("text")).mapInArrow(run, "bucket long, n long")
    counts = np.zeros(buckets, np.int64)
    for bucket, n in per_task.groupBy("bucket").agg(F.sum("n")).collect():  # at most one row per bucket
        counts[bucket] = n
    return counts


def gains_of(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Per bucket: thousandths of the logarithm of its smoothed share in the target over that in the corpus."""
    size = len(corpus)
    all_corpus, all_target = int(corpus.sum()), int(target.sum())
    return np.array([math.floor(1000 * math.log(float((t + 1) * (all_corpus + size)) / float((s + 1) * (all_target + size))))
                     for s, t in zip(corpus.tolist(), target.tolist())], np.int64)


def noise(doc_id: int | None, seed: str) -> int:
    """Thousandths of a Gumbel variate, rounded down, from the hash of the seed and the id."""
    key = f"{seed}:{'' if doc_id is None else doc_id}"
    h = int(hashlib.sha256(key.encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(docs: DataFrame, gains: np.ndarray, longest: int = 1, seed: str = SEED, id_column: str = "doc_id",
           text_column: str = "text") -> DataFrame:
    """(doc_id, n_features, weight, score, words) of every row."""
    schema = "doc_id long, n_features long, weight long, score long, words long"

    def rows(block) -> Iterator[tuple]:
        found = block_features(block.column(1), longest, len(gains))
        running = np.zeros(len(found.buckets) + 1, np.int64)
        np.cumsum(gains[found.buckets], out=running[1:])
        weights = np.diff(running[found.bounds])
        for doc_id, n, weight, words in zip(block.column(0).to_pylist(), np.diff(found.bounds).tolist(),
                                            weights.tolist(), found.words.tolist()):
            yield doc_id, n, weight, weight + noise(doc_id, seed), words

    def run(batches):
        yield from batches_of((rows(block) for batch in batches for block in text_blocks(batch, 1, BLOCK_BYTES)), schema)

    return docs.select(column_of(docs, id_column, "long").alias("doc_id"),
                       column_of(docs, text_column, "string").alias("text")).mapInArrow(run, schema)


def ranked(rows: DataFrame) -> DataFrame:
    """``rank`` 1, 2, 3... by falling score, then rising id, for all rows, without a task that sees them all.

    Rows are dealt by ranges of (score, id, position in the table) and sorted in
    their range; one count per range goes through the driver.
    """
    order = [F.desc("score"), F.asc("doc_id"), F.asc("place")]
    placed = kept(rows.withColumn("place", F.monotonically_increasing_id()))
    in_order = kept(placed.repartitionByRange(*order).sortWithinPartitions(*order).drop("place")).withColumns(
        {"part": F.spark_partition_id(), "place": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))})
    earlier, offsets = 0, []
    for part, n in sorted(in_order.groupBy("part").count().collect()):  # one row per range
        offsets.append((part, earlier))
        earlier += n
    before = rows.sparkSession.createDataFrame(offsets, "part int, earlier long")
    return in_order.join(F.broadcast(before), "part").withColumn("rank", F.col("earlier") + F.col("place") + 1).drop(
        "part", "place", "earlier")


def resample(docs: DataFrame, target: DataFrame, longest: int = 1, buckets: int = BUCKETS,
             share_percent: int = SHARE_PERCENT, least_words: int = LEAST_WORDS, seed: str = SEED,
             id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Every document's weight and score, and its rank if it is drawn; documents of few words are never drawn."""
    gains = gains_of(bucket_counts(docs, longest, buckets, text_column), bucket_counts(target, longest, buckets))
    rows = kept(scored(docs, gains, longest, seed, id_column, text_column))
    long_enough = F.col("words") >= least_words
    drawn = rows.where(long_enough).count() * share_percent // 100
    in_order = ranked(rows.where(long_enough)).withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    return in_order.unionByName(rows.where(~long_enough).withColumn("rank", F.lit(None).cast("long"))).drop("words")


def op13_importance_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
