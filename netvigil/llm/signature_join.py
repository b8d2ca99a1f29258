"""Jaccard self-join of documents on word shingles with signature trees, exact and without all pairs.

A document is the set of its distinct shingles (64-bit hashes of five words).
Two documents link when 100 * common >= ``percent`` * union. The steps:

1. Documents with equal sets form a class; one of them stands for it.
2. Any pair that links shares ``l`` shingles among the first ``n - ceil(t n) + l`` of
   either set, in any order common to all; ``l`` grows with the smaller set, so that
   chance meetings are told from links. The order puts the corpus' most frequent
   shingles last (shared passages, page furniture), so that cells stay small.
   One shuffle by shingle finds the cells with two documents or more; documents
   without enough cells have no link and are done.
3. Large groups of near copies are collapsed first: documents that agree in two
   minima of random orders are compared with the smallest of them only. What links
   with the same document is in one component, and pairs within need no look.
4. Of the cells that still hold two components (one of each that hold the same documents), a signature tree is built in
   each that is larger than a leaf: a node has the OR of its records' token bitmaps and the range of their sizes. Two
   nodes are traversed together only if their sizes and the largest overlap that
   their bitmaps allow can reach the threshold. Candidates come in rounds, between which linked records become one;
   the first looks at few cells per document. Large cells that no link needs are left out, and the bitmaps there are
   denser than elsewhere, so that texts near the limit are told apart before they become candidates.
   Pairs that meet in cells of the size of a leaf only are counted instead: a link takes ``l`` of them.
5. The distinct candidate pairs are verified on whole sets, and the links' connected
   components are computed.

Steps 2 and 4 lose no link (up to collisions of hashes: 64 bits per shingle, of which cells take 48); steps 1 and 3
only spare work. The list of frequent shingles (at most ``FREQUENT``) is all that reaches the driver.

Results of ``link_documents`` (one row per row of the input):

* a null or empty text, or one without words, has no shingles, links with nothing and is its own component;
* fewer words than ``words`` make one shingle of the whole sequence;
* rows that share an id count as one document with several texts; a row without an id has the component of its
  text's class, null if no row of the class has an id;
* texts are read whole, however long; an empty table gives an empty table; of the input only the two named columns are read.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from netvigil.llm.common import batches_of, column_of, read_table, small_batches, text_blocks
from netvigil.llm.components import components
from netvigil.session import materialize

WORDS, PERCENT = 5, 75
FREQUENT = 65_536
FREQUENT_SHARE, LEAST_COUNT = 0.002, 3  # of a block's documents, to be counted as a frequent shingle
BLOCK_SHINGLES = 1_000_000
BLOCK_BYTES = 4 << 20  # of texts that a task takes apart at a time; a longer text is one block
BANDS, MINIMA = 6, 2
LEAST_BITS, BITS, TREE_BITS = 256, 2, 8  # of bitmaps: at least, per element, and per element in large cells
TREE_WORDS = 1 << 18  # words of bitmaps that a tree compares at a time
SPARE = 20  # the prefix is longer by one shingle in so many; as many more must be shared
LEAF = 8
NEIGHBOURS, GROWTH = 8, 16  # partners of a record in the first rounds, and how many times more in each that follows
FIRST_CELLS = 2  # large cells of a document that take part in the first round
TOKEN_BITS = 48  # of the 64 bits in cells; equal ends only add candidates, which are verified
SEEN = 200_000
FILTER_BITS = 1 << 24
SIGNATURES = ("doc_id long, n_shingles long, digest binary, bands array<long>, bitmap binary, "
              "shingles array<long>, counts array<long>")
SETS = "doc_id long, hashes array<long>"

_MIX = [np.uint64(m) for m in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]


def written(df: DataFrame) -> DataFrame:
    """``df`` as a written table: each round's plan starts anew, without the constraints that checkpoints hand on."""
    return materialize(df, "near")


def mixed(values: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values (a bijection), so that all bits depend on all bits."""
    values = (values ^ (values >> np.uint64(30))) * _MIX[1]
    values = (values ^ (values >> np.uint64(27))) * _MIX[2]
    return values ^ (values >> np.uint64(31))


def shingle_set(text: str | None, words: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of the shingles of a text. Only A-Z are lower-cased, only ASCII white space cuts."""
    import xxhash

    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, parts), np.uint64, len(parts))
    width = min(words, len(parts))
    total = np.full(len(parts) - width + 1, width, np.uint64)
    for k in range(width):
        total = total * _MIX[0] + hashes[k:len(hashes) - width + 1 + k]
    return np.unique(mixed(total))


def common_least(size: int) -> int:
    """How many shingles two linking documents have in common within their prefixes, if the smaller has ``size``."""
    return 1 + size // SPARE


def prefix_length(size: int, percent: int = PERCENT) -> int:
    """Of the shingles that two linking documents share, the first ``common_least`` are in both prefixes."""
    return min(size, size - -(-percent * size // 100) + common_least(size))


def with_enough_cells(shared: DataFrame, sizes: DataFrame, percent: int) -> DataFrame:
    """The rows of documents with as many cells as a link takes; a partner has at least ``percent`` of their size."""
    smaller = F.floor((percent * F.col("size") + 99) / 100)
    counted = shared.groupBy("doc_id").agg(F.count("*").alias("cells")).join(sizes, "doc_id")
    enough = counted.where(F.col("cells") >= 1 + F.floor(smaller / SPARE)).select("doc_id")
    return shared.join(enough, "doc_id", "left_semi")


def bitmap_of(hashes: np.ndarray, per_element: int = BITS) -> np.ndarray:
    """Bitmap with ``per_element`` to twice as many bits per element, so that large sets do not fill theirs."""
    size = max(LEAST_BITS, 1 << int(per_element * len(hashes) - 1).bit_length())
    bits = np.zeros(size, bool)
    bits[(hashes & np.uint64(size - 1)).astype(np.int64)] = True
    return np.packbits(bits).view(np.uint64)


def folded(bitmaps: list[np.ndarray]) -> np.ndarray:
    """The bitmaps at the size of the smallest: bit i of a folded one is the OR of all bits equal to i modulo the size."""
    words = min(len(b) for b in bitmaps)
    return np.array([np.bitwise_or.reduce(b.reshape(-1, words), 0) for b in bitmaps])


_ORDERS = mixed(np.arange(1, BANDS * MINIMA + 1, dtype=np.uint64)) | np.uint64(1)


def band_keys(hashes: np.ndarray) -> list[int]:
    """One key per band: the smallest elements in ``MINIMA`` orders (each by an odd multiple of the hash), mixed."""
    least = np.array([(hashes * order).min() for order in _ORDERS]).reshape(BANDS, MINIMA)
    keys = np.arange(1, BANDS + 1, dtype=np.uint64)
    for minimum in range(MINIMA):
        keys = mixed(keys * _MIX[0] + least[:, minimum])
    return keys.view(np.int64).tolist()


def signatures(docs: DataFrame, words: int) -> DataFrame:
    """Per document its set's size, digest, band keys and bitmap; per block of documents its frequent shingles."""

    def run(batches):
        held, docs_held, size = [], 0, 0

        def frequent():
            values, counts = np.unique(np.concatenate(held), return_counts=True)
            often = counts >= max(LEAST_COUNT, FREQUENT_SHARE * docs_held)
            return (None, None, None, None, None, values[often].view(np.int64).tolist(), counts[often].tolist())

        for part in (part for batch in batches for part in text_blocks(batch, 1, BLOCK_BYTES)):
            rows = []
            for doc_id, text in zip(*(c.to_pylist() for c in part.columns)):
                own = shingle_set(text, words)
                if not len(own):
                    rows.append((doc_id, 0, None, None, None, None, None))
                    continue
                rows.append((doc_id, len(own), hashlib.blake2b(own.tobytes(), digest_size=16).digest(), band_keys(own),
                             bitmap_of(own).tobytes(), None, None))
                held.append(own)
                docs_held, size = docs_held + 1, size + len(own)
                if size >= BLOCK_SHINGLES:
                    rows.append(frequent())
                    held, docs_held, size = [], 0, 0
            yield from batches_of([rows], SIGNATURES)
        if held:
            yield from batches_of([[frequent()]], SIGNATURES)

    return docs.mapInArrow(run, SIGNATURES)


def frequent_shingles(signed: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """At most ``FREQUENT`` shingles in ascending order, with their rank by frequency (more frequent: higher)."""
    blocks = signed.where("shingles IS NOT NULL").select(F.explode(F.arrays_zip("shingles", "counts")).alias("s"))
    found = blocks.groupBy(F.col("s.shingles").alias("shingle")).agg(F.sum("s.counts").alias("count")).orderBy(
        F.desc("count"), "shingle").limit(FREQUENT).toPandas()
    values = found["shingle"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(values)
    return values[order], (len(values) - np.arange(len(values)))[order]


def prefix_of(own: np.ndarray, values: np.ndarray, ranks: np.ndarray, percent: int) -> np.ndarray:
    """The first shingles of a set in the common order: rare ones by hash, then frequent ones by rank."""
    length = prefix_length(len(own), percent)
    if not len(values):
        return own[:length]
    at = np.minimum(np.searchsorted(values, own), len(values) - 1)
    frequent = values[at] == own
    rare = own[~frequent]
    if len(rare) >= length:
        return rare[:length]
    late = own[frequent][np.argsort(ranks[at[frequent]], kind="stable")]
    return np.concatenate([rare, late])[:length]


def prefix_rows(docs: DataFrame, frequent, words: int, percent: int) -> DataFrame:
    """(token, doc_id) for the prefix of every document; copies within a task are left out."""
    values, ranks = frequent
    schema = "token long, doc_id long"

    def run(batches):
        import pyarrow as pa

        seen: set[bytes] = set()
        for part in (part for batch in batches for part in text_blocks(batch, 1, BLOCK_BYTES)):
            tokens, ids, counts = [np.empty(0, np.int64)], [], []
            for doc_id, text in zip(*(c.to_pylist() for c in part.columns)):
                own = shingle_set(text, words)
                digest = hashlib.blake2b(own.tobytes(), digest_size=16).digest()
                if not len(own) or digest in seen:
                    continue
                if len(seen) >= SEEN:
                    seen.clear()
                seen.add(digest)
                first = prefix_of(own, values, ranks, percent)
                tokens.append((first >> np.uint64(64 - TOKEN_BITS)).astype(np.int64))
                ids.append(doc_id)
                counts.append(len(first))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(tokens)),
                                              pa.array(np.repeat(np.array(ids, np.int64), counts))], names=["token", "doc_id"])

    return docs.where("doc_id IS NOT NULL").mapInArrow(run, schema)


def shared_cells(rows: DataFrame) -> DataFrame:
    """The rows (token, doc_id) of those cells that hold two documents or more.

    The rows arrive ordered by both columns, so a task holds one batch and one row of the running cell.
    """
    schema = "token long, doc_id long"

    def run(batches):
        import pyarrow as pa

        token, doc, several = None, None, False  # last row before the batch, and whether its cell has several documents
        for batch in batches:
            tokens, docs = (c.to_numpy() for c in batch.columns)
            if not len(tokens):
                continue
            starts = np.flatnonzero(np.concatenate([[True], tokens[1:] != tokens[:-1]]))
            ends = np.append(starts[1:], len(tokens))
            two = docs[starts] != docs[ends - 1]
            late = np.empty((2, 0), np.int64)
            if token == tokens[0]:
                two[0] = two[0] or several or doc != docs[0]
                if two[0] and not several:
                    late = np.array([[token], [doc]], np.int64)
            take = np.repeat(two, ends - starts)
            token, doc, several = tokens[-1], docs[-1], bool(two[-1])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([late[0], tokens[take]])),
                                              pa.array(np.concatenate([late[1], docs[take]]))],
                                             names=["token", "doc_id"])

    return rows.repartition("token").sortWithinPartitions("token", "doc_id").mapInArrow(run, schema)


def only_ids(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The documents named in ``ids``, which are distinct. A bitmap of their hashes, of fixed size, drops most others before the shuffle."""
    at = F.pmod(F.xxhash64("doc_id"), F.lit(FILTER_BITS))
    words = ids.select(at.alias("at")).groupBy((F.col("at") / 64).cast("int").alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(at % 64 AS int))")).alias("bits"))
    likely = docs.withColumn("word", (at / 64).cast("int")).join(F.broadcast(words), "word").where(
        F.getbit("bits", (at % 64).cast("int")) == 1)
    # An inner join: a semi join would be pushed below the bitmap's, and shuffle all documents.
    return likely.select(*docs.columns).join(ids, "doc_id")


def document_sets(docs: DataFrame, pairs: DataFrame, words: int) -> DataFrame:
    """Whole sets of the documents that occur in ``pairs``."""

    def run(batches):
        import pyarrow as pa

        for part in (part for batch in batches for part in text_blocks(batch, 1, BLOCK_BYTES)):
            sets = [shingle_set(text, words) for text in part.column(1).to_pylist()]
            ends = np.cumsum([0] + [len(own) for own in sets])
            hashes = pa.array(np.concatenate([np.empty(0, np.uint64)] + sets).view(np.int64))
            held = pa.RecordBatch.from_arrays(
                [part.column(0), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), hashes)], names=["doc_id", "hashes"])
            yield held.filter(pa.array(np.diff(ends) > 0))

    ids = pairs.select(F.col("a").alias("doc_id")).unionAll(pairs.select("b")).distinct()
    return only_ids(docs, written(ids)).select("doc_id", "text").mapInArrow(run, SETS)


def tree_bitmaps(docs: DataFrame, ids: DataFrame, words: int) -> DataFrame:
    """(doc_id, size, bitmap) of the documents named in ``ids``, which are distinct, with the bitmaps of large cells.

    Documents that share much, but too little, are the square of a group; with these bitmaps hardly any pair of them may link.
    """
    schema = "doc_id long, size long, bitmap binary"

    def run(batches):
        for part in (part for batch in batches for part in text_blocks(batch, 1, BLOCK_BYTES)):
            sets = ((doc_id, shingle_set(text, words)) for doc_id, text in zip(*(c.to_pylist() for c in part.columns)))
            yield from batches_of([[(doc_id, len(own), bitmap_of(own, TREE_BITS).tobytes()) for doc_id, own in sets if len(own)]],
                                  schema)

    return only_ids(docs, written(ids)).select("doc_id", "text").mapInArrow(run, schema).distinct()


def verified(pairs: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """Those of the pairs (a, b) whose whole sets reach the threshold."""
    pairs = written(pairs)
    sets = document_sets(docs, pairs, words)  # both joins below read one shuffle of it
    left = sets.select(F.col("doc_id").alias("a"), F.col("hashes").alias("of_a"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("hashes").alias("of_b"))
    both = pairs.join(left, "a").join(right, "b")
    common = F.size(F.array_intersect("of_a", "of_b"))
    enough = (100 + percent) * common >= percent * (F.size("of_a") + F.size("of_b"))  # 100 common >= percent * union
    return both.where(enough).select("a", "b").distinct()


def plausible(pairs: DataFrame, bitmaps: DataFrame, percent: int) -> DataFrame:
    """Those of the pairs (a, b) whose sizes and bitmaps allow the threshold."""
    schema = "a long, b long"

    def run(batches):
        for batch in batches:
            found = [pair for a, b, *both in zip(*(c.to_pylist() for c in batch.columns))
                     for pair in leaf_pairs([a, b], [0, 1], both[:2], both[2:], percent)]
            yield from batches_of([found], schema)

    pairs = written(pairs)
    named = only_ids(bitmaps, written(pairs.select(F.col("a").alias("doc_id")).unionAll(pairs.select("b")).distinct()))
    sides = [named.select(F.col("doc_id").alias(s), F.col("size").alias(f"size_{s}"), F.col("bitmap").alias(f"bitmap_{s}"))
             for s in "ab"]
    joined = pairs.join(sides[0], "a").join(sides[1], "b").select("a", "b", "size_a", "size_b", "bitmap_a", "bitmap_b")
    return joined.mapInArrow(run, schema).distinct()


def star_pairs(reps: DataFrame, active: DataFrame) -> DataFrame:
    """Each document with the smallest one that shares a band key with it."""
    keys = reps.join(active, "doc_id", "left_semi").select("doc_id", F.explode("bands").alias("band"))
    centres = keys.groupBy("band").agg(F.min("doc_id").alias("centre"), F.max("doc_id").alias("last")).where("centre < last")
    return keys.join(centres, "band").where("doc_id > centre").select(
        F.col("centre").alias("a"), F.col("doc_id").alias("b")).distinct()


class SignatureTree:
    """Records in order, and per level the nodes' OR-combined bitmaps, size ranges and component ranges.

    ``excess`` is how many more elements a record has than bits: two records
    with bitmaps x and y have at most popcount(x & y) + min(excess) elements in common.
    """

    def __init__(self, bitmaps: np.ndarray, sizes: np.ndarray, components: np.ndarray):
        self.order = np.lexsort((sizes, components))
        bitmaps, sizes, components = bitmaps[self.order], sizes[self.order], components[self.order]
        excess = sizes - np.bitwise_count(bitmaps).sum(1).astype(np.int64)
        self.levels = [(bitmaps, sizes, sizes, excess, components, components)]
        while len(self.levels[-1][0]) > 1:
            bits, low, high, most, first, last = self.levels[-1]
            at = np.arange(0, len(bits), LEAF)
            self.levels.append((np.bitwise_or.reduceat(bits, at), np.minimum.reduceat(low, at), np.maximum.reduceat(high, at),
                                np.maximum.reduceat(most, at), np.minimum.reduceat(first, at), np.maximum.reduceat(last, at)))

    def possible(self, level: int, a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
        """Which of the node pairs may hold a linking pair of two components."""
        bits, low, high, most, first, last = self.levels[level]
        fits = (100 * high[a] >= percent * low[b]) & (100 * high[b] >= percent * low[a])
        fits &= ~((first[a] == last[a]) & (first[b] == last[b]) & (first[a] == first[b]))
        a, b, where = a[fits], b[fits], np.flatnonzero(fits)
        overlap = np.bitwise_count(bits[a] & bits[b]).sum(1).astype(np.int64) + np.minimum(most[a], most[b])
        # common >= p (|x| + |y|) / (100 + p), and common >= p max(|x|, |y|) / 100
        enough = ((100 + percent) * overlap >= percent * (low[a] + low[b])) & (100 * overlap >= percent * np.maximum(low[a], low[b]))
        return where[enough]

    def pairs(self, percent: int, block: int | None = None):
        """Arrays (a, b) of record numbers that may link, by dual traversal from the root, ``block`` at a time."""
        block = block or max(1, TREE_WORDS // self.levels[0][0].shape[1])
        work = [(len(self.levels) - 1, np.zeros(1, np.int64), np.zeros(1, np.int64))]
        while work:
            level, a, b = work.pop()
            if len(a) > block:
                work += [(level, a[block:], b[block:])]
                a, b = a[:block], b[:block]
            good = self.possible(level, a, b, percent)
            a, b = a[good], b[good]
            if not len(a):
                continue
            if level == 0:
                yield self.order[a], self.order[b]
                continue
            count = len(self.levels[level - 1][0])
            left = (a[:, None] * LEAF + np.arange(LEAF))[:, :, None]
            right = (b[:, None] * LEAF + np.arange(LEAF))[:, None, :]
            left, right = np.broadcast_arrays(left, right)
            left, right = left.ravel(), right.ravel()
            # below one node with itself each pair once; records are no pair with themselves
            keep = (left < count) & (right < count) & ((left < right) | ((left == right) & (level > 1)))
            work.append((level - 1, left[keep], right[keep]))


def leaf_pairs(ids: list, groups: list, sizes: list, bitmaps, percent: int):
    """The pairs of one leaf that may link: the tree's test on single records, with bitmaps as whole numbers."""
    width = 8 * min(map(len, bitmaps))
    records = []
    for doc_id, group, size, raw in zip(ids, groups, sizes, bitmaps):
        bits, length = int.from_bytes(raw, "little"), 8 * len(raw)
        while length > width:  # fold: the OR of both halves
            length //= 2
            bits = (bits & ((1 << length) - 1)) | (bits >> length)
        records.append((doc_id, group, size, bits, size - bits.bit_count()))
    for i, (a, group_a, size_a, bits_a, excess_a) in enumerate(records):
        for b, group_b, size_b, bits_b, excess_b in records[:i]:
            if group_a == group_b or 100 * size_a < percent * size_b or 100 * size_b < percent * size_a:
                continue
            overlap = (bits_a & bits_b).bit_count() + min(excess_a, excess_b)
            if (100 + percent) * overlap >= percent * (size_a + size_b) and 100 * overlap >= percent * max(size_a, size_b):
                yield (a, b) if a < b else (b, a)


def zoned(rows: DataFrame, percent: int) -> DataFrame:
    """``rows`` (token, doc_id, component, size) dealt to cells (token, zone).

    Sizes of linking documents differ by a factor of 100 / percent at most: they
    are in the same range of sizes or in neighbouring ones, so a cell splits into
    ranges, each with the records of the next range as visitors.
    """
    own = F.floor(F.log("size") / float(np.log(100 / percent))).cast("int") if percent < 100 else F.col("size").cast("int")
    return rows.withColumn("own", own).withColumn("zone", F.explode(F.array(F.col("own"), F.col("own") - 1))).select(
        "token", "zone", "doc_id", "component", "size", (F.col("own") - F.col("zone")).alias("visitor"))


def distinct_cells(rows: DataFrame, percent: int) -> DataFrame:
    """The rows of the cells with two components or more; of cells with the same documents only one.

    Documents that share a passage share a cell for each of its shingles. Equal
    cells are told by 128 bits of hashes and the number of their documents;
    ``weight`` is how many there are and ``documents`` how many rows each has.
    Visitors alone make no cell: they meet in their own range of sizes.

    The rows are dealt by token once; the zones of a token stay together.
    """
    # With the condition, which the join would add on its side only, both uses below read one shuffle.
    dealt = zoned(rows.where("token IS NOT NULL").repartition("token"), percent)
    cells = dealt.groupBy("token", "zone").agg(
        F.min("component").alias("first"), F.max("component").alias("last"), F.count("*").alias("documents"),
        F.min("visitor").alias("visitor"), F.sum("size").alias("sizes"),
        F.bit_xor(F.xxhash64("doc_id")).alias("x"), F.bit_xor(F.xxhash64("doc_id", F.lit(1))).alias("y"))
    chosen = cells.where("first < last AND visitor = 0").groupBy("x", "y", "documents", "zone", "sizes").agg(
        F.min("token").alias("token"), F.count("*").alias("weight"))
    per_token = chosen.groupBy("token").agg(F.map_from_entries(F.collect_list(
        F.struct("zone", F.struct("documents", "weight")))).alias("zones"))
    found = dealt.join(per_token, "token").withColumn("cell", F.col("zones")[F.col("zone")]).where("cell IS NOT NULL")
    return found.select("token", "zone", "doc_id", "component", "size", "visitor", "cell.documents", "cell.weight")


def with_enough_open_cells(rows: DataFrame, percent: int) -> DataFrame:
    """The rows of cells of two components, without those of documents that have too few of them.

    A document and its partner in another component share ``common_least`` tokens,
    all in cells of one range of sizes (the smaller one's). Cells that hold one
    component only are gone, so members of a group that is linked already, which
    share many cells with each other and few with the rest, end here.
    """
    enough = rows.groupBy("doc_id", "zone").agg(F.sum("weight").alias("cells"), F.max("size").alias("size")).where(
        F.col("cells") >= 1 + F.floor(F.floor((percent * F.col("size") + 99) / 100) / SPARE)).select("doc_id", "zone")
    return rows.join(enough, ["doc_id", "zone"], "left_semi")


def without_spare_cells(rows: DataFrame, percent: int) -> DataFrame:
    """The rows of large cells, without those of a document's largest cells that no link needs.

    A document and a partner in another component share ``l`` cells in one range of sizes, or more. Of these at most as
    many are small as the document has small cells there. If it leaves fewer of its large cells than the others
    that a link takes, the largest first in an order common to all, the smallest large cell that the two share
    stays with both of them; and a pair that shares small cells only is counted.
    """
    order = Window.partitionBy("doc_id", "zone").orderBy(F.desc("documents"), "token")
    smaller = F.floor((percent * F.col("size") + 99) / 100)
    small = F.coalesce(F.sum(F.when(F.col("documents") <= LEAF, F.col("weight"))).over(Window.partitionBy("doc_id", "zone")), F.lit(0))
    ranked = rows.withColumn("larger", F.sum("weight").over(order)).withColumn("small", small)
    return ranked.where((F.col("documents") > LEAF) & (F.col("larger") + F.col("small") > F.floor(smaller / SPARE))).drop("larger", "small")


def first_cells(rows: DataFrame) -> DataFrame:
    """Of every document the rows of few cells: near copies, which share most cells, have mostly the same ones."""
    at = F.row_number().over(Window.partitionBy("doc_id").orderBy(F.xxhash64("token"), "token", "zone"))
    return rows.withColumn("at", at).where(F.col("at") <= FIRST_CELLS).drop("at")


def counted_pairs(rows: DataFrame, percent: int) -> DataFrame:
    """Pairs of different components that share enough of the small cells, of at most ``LEAF`` documents.

    A linking pair shares at least ``common_least`` cells. If one of them is a
    large cell, the pair comes from its tree; if all are small, it is counted here.
    """
    a, b = F.col("pair.a"), F.col("pair.b")
    listed = rows.where(F.col("documents") <= LEAF).groupBy("token", "zone").agg(
        F.first("weight").alias("weight"), F.sort_array(F.collect_list(F.struct("doc_id", "component", "size", "visitor"))).alias("docs"))
    both = F.flatten(F.transform("docs", lambda x, i: F.transform(
        F.slice("docs", i + 2, F.lit(LEAF)), lambda y: F.struct(x.alias("a"), y.alias("b")))))
    met = listed.select("weight", F.explode(both).alias("pair")).where(
        (a["component"] != b["component"]) & (a["visitor"] + b["visitor"] < 2)
        & (100 * F.least(a["size"], b["size"]) >= percent * F.greatest(a["size"], b["size"])))
    shared = met.groupBy(a["doc_id"].alias("a"), b["doc_id"].alias("b")).agg(
        F.sum("weight").alias("shared"), F.min(F.least(a["size"], b["size"])).alias("smaller"))
    return shared.where(F.col("shared") >= 1 + F.floor(F.col("smaller") / SPARE)).select("a", "b")


def pair_draw(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A number from 0 to 1 for every pair of ids, the same wherever the pair meets."""
    low, high = np.minimum(a, b).view(np.uint64), np.maximum(a, b).view(np.uint64)
    return (mixed(mixed(low) + high * _MIX[0]) >> np.uint64(11)).astype(np.float64) * 2.0 ** -53


def candidate_pairs(cells: DataFrame, percent: int, allowed: tuple[int, int] | None = None) -> DataFrame:
    """Pairs (a, b) of different components that may link, from the trees of large cells.

    ``cells`` has rows (token, zone, doc_id, component, size, visitor, documents,
    bitmap). With ``allowed`` = (before, now) a cell with few such pairs gives all of them. In any other
    a record gets about ``now`` partners, other ones than with ``allowed`` up to ``before``: every pair has a
    number drawn from its ids, and is given when that is below now / documents; the
    cell is named in a row (null, null, token, zone), as it has more to give. With
    ``allowed`` None every record gets those of the next few in an order of hashes that may link, and no cell is named.
    """
    schema = "a long, b long, token long, zone int"

    def run(batches):
        def neighbours(tree, ids):
            order = np.argsort(mixed(ids[tree.order].view(np.uint64)))
            for step in range(1, 1 + min(NEIGHBOURS, len(ids) // 2)):
                a, b = order, np.roll(order, -step)
                good = tree.possible(0, a, b, percent)
                yield tree.order[a[good]], tree.order[b[good]]

        def from_tree(tree, ids, visitors, documents):
            """Pairs for this round, and whether there are others; no more than the few are held unless drawn."""
            below, upto = (n / documents[0] for n in allowed)
            few, held, drawn_pairs = NEIGHBOURS * len(ids), [], []
            for a, b in tree.pairs(percent):
                met = visitors[a] + visitors[b] < 2
                a, b = a[met], b[met]
                drawn = pair_draw(ids[a], ids[b])
                now = (drawn >= below) & (drawn < upto)
                drawn_pairs.append((a[now], b[now]))
                if held is not None:
                    held.append((a[~now], b[~now]))
                    if sum(len(x) for x, _ in held) + sum(len(x) for x, _ in drawn_pairs) > few:
                        held = None
            return drawn_pairs + (held or []), held is None

        def pairs_of(tokens, zones, ids, groups, sizes, visitors, bitmaps, documents):
            tree = SignatureTree(folded([np.frombuffer(x, np.uint64) for x in bitmaps]), sizes, groups)
            found, more = (neighbours(tree, ids), False) if allowed is None else from_tree(tree, ids, visitors, documents)
            for a, b in found:
                for low, high in zip(np.minimum(ids[a], ids[b]).tolist(), np.maximum(ids[a], ids[b]).tolist()):
                    yield low, high, None, None
            if more:
                yield None, None, int(tokens[0]), int(zones[0])

        held = None
        for batch in batches:
            columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            if held is not None:
                columns = [np.concatenate(pair) for pair in zip(held, columns)]
            if not len(columns[0]):
                continue
            new = (columns[0][1:] != columns[0][:-1]) | (columns[1][1:] != columns[1][:-1])
            starts = np.flatnonzero(np.concatenate([[True], new])).tolist()
            found = {pair for start, end in zip(starts[:-1], starts[1:]) if end - start > 1
                     for pair in pairs_of(*(c[start:end] for c in columns))}
            yield from batches_of([found], schema)
            held = [c[starts[-1]:] for c in columns]
        if held is not None:
            yield from batches_of([set(pairs_of(*held))], schema)

    ordered = cells.select("token", "zone", "doc_id", "component", "size", "visitor", "bitmap", "documents").repartition(
        "token", "zone").sortWithinPartitions("token", "zone")
    return ordered.mapInArrow(run, schema).distinct()


def labels_of(links: DataFrame) -> DataFrame:
    """(doc_id, component) of the documents that have a link, written."""
    return written(components(links).select(F.col("vertex").alias("doc_id"), "component"))


def joined_labels(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` after further links: only the components that these join are looked at again."""
    of = lambda name: labels.select(F.col("doc_id").alias(name), F.col("component").alias(f"of_{name}"))
    ends = links.join(of("a"), "a", "left").join(of("b"), "b", "left").select(
        F.coalesce("of_a", "a").alias("a"), F.coalesce("of_b", "b").alias("b"))
    moved = labels_of(ends).select(F.col("doc_id").alias("component"), F.col("component").alias("joined"))
    everyone = labels.unionAll(moved.select("component", "component")).distinct()
    return written(everyone.join(moved, "component", "left").select("doc_id", F.coalesce("joined", "component").alias("component")))


def unsettled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows with their present components, of the cells that still hold two of them."""
    now = rows.drop("component").join(labels, "doc_id", "left").withColumn("component", F.coalesce("component", "doc_id"))
    open_cells = now.groupBy("token", "zone").agg(F.min("component").alias("first"), F.max("component").alias("last")).where(
        "first < last").select("token", "zone")
    return written(now.join(open_cells, ["token", "zone"], "left_semi"))


def tree_links(rows: DataFrame, links: DataFrame, own: DataFrame, words: int, percent: int) -> DataFrame:
    """(doc_id, component) by ``links`` and those found in large cells, in rounds that contract what is linked already.

    A group of near copies fills its cells; were all its pairs candidates, their
    number would be the square of the group. In a round every record gets a few
    partners from other components, these pairs are verified, and what links becomes one
    component, within which nobody is a candidate any more. The number of partners
    grows ``GROWTH`` times per round until it covers all pairs that are still apart: none
    is lost, and a group that holds together costs a few pairs per record. Cells with few
    candidates, such as those of documents that meet by chance, take part in two rounds only.
    """
    allowed, labels = None, labels_of(links)
    large = written(without_spare_cells(with_enough_open_cells(unsettled(rows, labels), percent), percent))
    bitmaps = written(tree_bitmaps(own, large.select("doc_id").distinct(), words))
    most = large.agg(F.max("documents")).first()[0] or 0
    while most and (allowed is None or allowed[0] < most):
        cells = unsettled(large, labels)
        if cells.isEmpty():
            break
        taking_part = first_cells(cells) if allowed is None else cells
        given = written(candidate_pairs(taking_part.join(bitmaps.select("doc_id", "bitmap"), "doc_id"), percent, allowed))
        pairs = given.where("a IS NOT NULL").select("a", "b")
        found = written(verified(plausible(pairs, bitmaps, percent), own, words, percent))
        if allowed is not None:  # cells that gave all they had are done
            large = written(large.join(given.where("a IS NULL").select("token", "zone"), ["token", "zone"], "left_semi"))
        if not found.isEmpty():
            labels = joined_labels(labels, found)
        allowed = (0, NEIGHBOURS) if allowed is None else (allowed[1], allowed[1] * GROWTH)
    return labels


def link_documents(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, id_column: str = "doc_id",
                   text_column: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row."""
    small_batches(docs.sparkSession)
    own = docs.select(column_of(docs, id_column, "long").alias("doc_id"), column_of(docs, text_column, "string").alias("text"))
    signed = written(signatures(own, words))
    rows = signed.where("shingles IS NULL")

    classes = rows.where("digest IS NOT NULL").groupBy("digest").agg(F.min("doc_id").alias("rep"))
    class_of = written(rows.where("digest IS NOT NULL AND doc_id IS NOT NULL").join(classes, "digest").select(
        "doc_id", "rep", "bands", "n_shingles", "bitmap"))
    copies = class_of.select("doc_id", "rep").distinct()
    reps = class_of.where("doc_id = rep").drop("rep")

    shared = shared_cells(prefix_rows(own, frequent_shingles(signed), words, percent))
    sizes = reps.select("doc_id", F.col("n_shingles").alias("size"))
    shared = shared.join(copies, "doc_id").select("token", F.col("rep").alias("doc_id")).distinct()
    shared = written(with_enough_cells(written(shared), sizes, percent))
    active = shared.select("doc_id").distinct()

    bitmaps = reps.select("doc_id", F.col("n_shingles").alias("size"), "bitmap")
    near = written(verified(plausible(star_pairs(reps, active), bitmaps, percent), own, words, percent))
    about = written(sizes.join(labels_of(near), "doc_id", "left"))
    labelled = shared.join(about, "doc_id").select("token", "doc_id", F.coalesce("component", "doc_id").alias("component"), "size")
    rows_of_cells = written(with_enough_open_cells(written(distinct_cells(labelled, percent)), percent))
    links = written(near.unionAll(verified(plausible(counted_pairs(rows_of_cells, percent), bitmaps, percent), own, words, percent)))
    grouped = tree_links(rows_of_cells, links, own, words, percent).withColumnRenamed("doc_id", "rep")
    found = classes.join(grouped, "rep", "left").select("digest", F.coalesce("component", "rep").alias("component_id"))
    return rows.join(found, "digest", "left").select(
        "doc_id", "n_shingles", F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def one_of_each(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, id_column: str = "doc_id",
                text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` whose id names their component, with their columns; rows without an id stay."""
    found = link_documents(docs, words, percent, id_column, text_column)
    gone = found.where("doc_id <> component_id").select(F.col("doc_id").alias("__nv_gone")).distinct()
    return docs.join(gone, column_of(docs, id_column, "long") == F.col("__nv_gone"), "left_anti")


def op5_signature_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_documents(read_table(spark, sf_dir, "documents"))
