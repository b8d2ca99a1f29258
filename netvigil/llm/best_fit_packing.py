"""Best-fit decreasing packing of token sequences, over all documents at once.

Documents become pieces of at most ``capacity`` tokens. Best-fit decreasing
looks only at lengths, of which there are at most ``capacity``, so the whole
packing follows from a histogram of lengths: pieces of one length go, many at a
time, to the tightest open bins, found by a segment tree over remaining
capacities. The outcome is the same as placing every document of the corpus by
itself, longest first. The histogram and the list of moves have sizes bounded
by ``capacity`` alone (see ``plan_moves``); only they pass through the driver.

Pieces get their places in parallel: the rank of a piece among those of its
length is its rank within its task's share plus the pieces in earlier shares,
and the move that covers this rank names the bin and the offset. No group of
pieces is ever gathered, so any number of equal lengths does not matter.

Results of ``pack`` (one row per piece):

* a null or empty text has only the end id: one piece of length 1;
* only documents longer than ``capacity`` are cut, into whole pieces; the last may be shorter;
* repeated rows are packed each for itself; null ids stay; an empty table gives an empty table;
* of the input only the two named columns are read, so other columns never clash.
"""

from __future__ import annotations

import zlib
from collections import Counter
from typing import NamedTuple

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from netvigil.llm.chunks import WordEncoder
from netvigil.llm.common import batches_of, column_of, kept, read_table, small_batches, text_blocks

CAPACITY = 4096
END_ID = 1
BLOCK_BYTES = 2 << 20  # of texts that a task holds as Python strings at a time; a longer text is one block
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, share string, place long"
PACKED = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


class CapacityTree:
    """Segment tree over remaining capacities 0..capacity: which of them have open bins.

    ``tightest(need)`` finds the smallest capacity of at least ``need`` with an
    open bin in logarithmic time.
    """

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.open = [0] * (2 * self.size)

    def add(self, remaining: int, groups: int) -> None:
        node = self.size + remaining
        while node:
            self.open[node] += groups
            node >>= 1

    def tightest(self, need: int) -> int | None:
        node = self.size + need
        if self.open[node]:
            return need
        while node > 1:  # climb until a right sibling has open bins, then go down on its left side
            if node % 2 == 0 and self.open[node + 1]:
                node += 1
                while node < self.size:
                    node = 2 * node if self.open[2 * node] else 2 * node + 1
                return node - self.size
            node >>= 1
        return None


class Move(NamedTuple):
    """Pieces of ``length`` with ranks from ``rank`` on go to bins from ``bin`` on, ``each`` per bin, from ``offset`` on."""

    length: int
    rank: int
    bin: int
    each: int
    offset: int


def plan_moves(histogram: dict[int, int], capacity: int = CAPACITY) -> tuple[list[Move], int]:
    """Best-fit decreasing of ``histogram[length]`` pieces: the moves, and the number of bins.

    Bins with the same remaining capacity r form groups of consecutive numbers.
    Placing one by one, best fit fills the tightest bin with r // length pieces
    before it takes another, so a group moves as a whole to r % length, which is
    less than r / 2. A length opens at most two new groups and splits one into at
    most three, hence groups <= 5 * capacity and moves <= groups * log2(capacity),
    whatever the number of pieces.
    """
    tree, groups, moves, bins = CapacityTree(capacity), {}, [], 0

    def put(remaining: int, first: int, count: int) -> None:
        if count and remaining:
            groups.setdefault(remaining, []).append((first, count))
            tree.add(remaining, 1)

    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        while left:
            remaining = tree.tightest(length)
            if remaining is None:
                remaining, first = capacity, bins
                count = -(-left // (capacity // length))
                bins += count
            else:
                first, count = groups[remaining].pop()
                tree.add(remaining, -1)
            each = remaining // length
            full = min(count, left // each)
            if full:
                moves.append(Move(length, rank, first, each, capacity - remaining))
                put(remaining - each * length, first, full)
                rank, left = rank + full * each, left - full * each
            if full < count:
                if left:  # the last pieces fill a part of one more bin
                    moves.append(Move(length, rank, first + full, each, capacity - remaining))
                    put(remaining - left * length, first + full, 1)
                    rank, left, full = rank + left, 0, full + 1
                put(remaining, first + full, count - full)
    return moves, bins


def token_pieces(docs: DataFrame, tokenizer_path: str, capacity: int, id_column: str, text_column: str) -> DataFrame:
    """One row per piece, with the rank (``place``) of its length within its task's ``share``."""

    def run(batches):
        import uuid

        encoder = WordEncoder(tokenizer_path)
        end = END_ID.to_bytes(4, "little")
        share, seen = uuid.uuid4().hex, Counter()

        def pieces(batch):
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = encoder.ids(text) + end
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    own = ids[at:at + 4 * capacity]
                    length = len(own) // 4
                    yield doc_id, piece, at // 4, length, zlib.crc32(own), share, seen[length]
                    seen[length] += 1

        yield from batches_of((pieces(part) for batch in batches for part in text_blocks(batch, 1, BLOCK_BYTES)), PIECES)

    return docs.select(column_of(docs, id_column, "long").alias("doc_id"),
                       column_of(docs, text_column, "string").alias("text")).mapInArrow(run, PIECES)


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, id_column: str = "doc_id",
         text_column: str = "text") -> DataFrame:
    """The place of every piece of every document in sequences of at most ``capacity`` tokens."""
    small_batches(docs.sparkSession)
    pieces = kept(token_pieces(docs, tokenizer_path, capacity, id_column, text_column))
    shares = kept(pieces.groupBy("length", "share").agg(F.count("*").alias("pieces")))
    histogram = {r["length"]: r["pieces"]  # at most `capacity` rows
                 for r in shares.groupBy("length").agg(F.sum("pieces").alias("pieces")).collect()}
    moves, _ = plan_moves(histogram, capacity)

    earlier = Window.partitionBy("length").orderBy("share").rowsBetween(Window.unboundedPreceding, -1)
    bases = shares.select("length", "share", F.coalesce(F.sum("pieces").over(earlier), F.lit(0)).alias("base"))
    ranked = pieces.join(bases, ["length", "share"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("base") + F.col("place")).alias("rank"))

    plan = [list(column) for column in zip(*sorted(moves))] or [[], [], [], [], []]

    def place(batches):
        import numpy as np
        import pyarrow as pa

        lengths, ranks, bins, each, offsets = (np.array(column, np.int64) for column in plan)
        starts = np.searchsorted(lengths, np.arange(capacity + 2))
        for batch in batches:
            length = batch.column(3).to_numpy()
            rank = batch.column(5).to_numpy()
            sequence, offset = np.empty_like(rank), np.empty_like(rank)
            for own in np.unique(length):
                rows = np.flatnonzero(length == own)
                low, high = starts[own], starts[own + 1]
                move = low + np.searchsorted(ranks[low:high], rank[rows], "right") - 1
                step = rank[rows] - ranks[move]
                sequence[rows] = bins[move] + step // each[move]
                offset[rows] = offsets[move] + step % each[move] * own
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(sequence), pa.array(offset)],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return ranked.mapInArrow(place, PACKED)


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
