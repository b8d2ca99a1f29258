"""Token ids as wavelet matrices, one per shard of consecutive documents.

``write_ids`` deals the documents by ranges of their id, tokenises each range in
order and writes one row per shard to Parquet through Spark's writer, so that
any store and any lost executor is handled. The row's ``content`` is a complete
file in the format below; the other columns give its place and size, so that
positions are known without reading contents. A shard closes with the document
that brings it to ``shard_tokens`` tokens.

Format (little-endian): magic ``NVWM``; uint32 version, bits, documents, blocks
per plane; uint64 tokens; uint8 per document whether the id is null; int64 per
document its id; uint32 per document its tokens; per plane uint64 number of zeros, uint32 ones before each block,
uint32 compressed size of each block; then all blocks, each 2**19 bits packed
and compressed with zstd by itself. Plane 0 holds the highest bits of the ids;
each plane is ordered by the planes before it (zeros first, stably), so that

* ``access(i)`` follows one position through the planes,
* ``rank(token, i)`` counts a token before a position,
* ``select(token, k)`` finds its k-th occurrence,

each with two blocks per plane. ``tokens()`` undoes the planes from the last to the first.

Results of ``write_ids`` and ``read_documents``:

* a null or empty text has only the end id; documents come in ascending id, null ids first;
* rows with the same id stand side by side in any order; each keeps its own row;
* an empty table gives an empty result; other columns than the two named are not read.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from netvigil.llm.chunks import ByteLevelEncoder, for_this_worker
from netvigil.llm.common import batches_of, column_of, read_table
from netvigil.session import fresh_path

MAGIC, VERSION = b"NVWM", 1
BLOCK_BITS = 1 << 19
SHARD_TOKENS = 2_000_000
END_ID = 0
SHARDS = "range int, shard int, documents long, tokens long, content binary"
DOCUMENTS = "range int, shard int, doc_id long, start long, n_tokens long, ids_crc32 long"


def build(tokens: np.ndarray, doc_ids: list[int | None], counts: list[int]) -> bytes:
    """The file of one shard."""
    import zstandard

    packer = zstandard.ZstdCompressor(level=1)
    bits = max(1, int(tokens.max()).bit_length()) if len(tokens) else 1
    values = tokens.astype(np.uint16 if bits <= 16 else np.uint32)
    blocks = -(-len(values) // BLOCK_BITS)
    heads, bodies = [], []
    for plane in reversed(range(bits)):
        ones = (values & values.dtype.type(1 << plane)) != 0
        plain = np.packbits(ones)
        parts = [plain[b * BLOCK_BITS // 8:(b + 1) * BLOCK_BITS // 8] for b in range(blocks)]
        before = np.array([int(np.bitwise_count(part).sum(dtype=np.int64)) for part in parts], np.int64)
        bodies += (own := [packer.compress(part.tobytes()) for part in parts])
        heads.append(struct.pack("<Q", len(ones) - int(before.sum())))
        heads.append((np.cumsum(before) - before).astype("<u4").tobytes())
        heads.append(np.array([len(body) for body in own], "<u4").tobytes())
        values = np.concatenate([values[~ones], values[ones]])
    flags = np.array([doc is None for doc in doc_ids], np.uint8)
    return b"".join([
        MAGIC, struct.pack("<IIIIQ", VERSION, bits, len(doc_ids), blocks, len(tokens)), flags.tobytes(),
        np.array([doc or 0 for doc in doc_ids], "<i8").tobytes(), np.array(counts, "<u4").tobytes(), *heads, *bodies])


class WaveletShard:
    """Reads one shard; blocks are unpacked when they are first needed."""

    def __init__(self, content: bytes):
        if content[:4] != MAGIC:
            raise ValueError("not a token shard")
        version, self.bits, docs, self.blocks, self.length = struct.unpack_from("<IIIIQ", content, 4)
        if version != VERSION:
            raise ValueError(f"unknown version {version}")
        at = 28

        def take(kind: str, count: int) -> np.ndarray:
            nonlocal at
            array = np.frombuffer(content, kind, count, at)
            at += array.nbytes
            return array

        flags = take("u1", docs)
        self.doc_ids = [None if flag else doc for flag, doc in zip(flags.tolist(), take("<i8", docs).tolist())]
        self.counts = take("<u4", docs).astype(np.int64)
        self.zeros, self.before, sizes = [], [], []
        for _ in range(self.bits):
            self.zeros.append(int(take("<u8", 1)[0]))
            self.before.append(take("<u4", self.blocks))
            sizes.append(take("<u4", self.blocks))
        ends = at + np.cumsum(np.array(sizes, np.int64).ravel())
        self.bounds = np.concatenate([[at], ends])
        self.content = content
        self.unpacked: dict[tuple[int, int], np.ndarray] = {}

    def block(self, plane: int, block: int) -> np.ndarray:
        import zstandard

        if (plane, block) not in self.unpacked:
            k = plane * self.blocks + block
            raw = zstandard.ZstdDecompressor().decompress(self.content[self.bounds[k]:self.bounds[k + 1]],
                                                          max_output_size=BLOCK_BITS // 8)
            size = min(BLOCK_BITS, self.length - block * BLOCK_BITS)
            self.unpacked[plane, block] = np.unpackbits(np.frombuffer(raw, np.uint8), count=size)
        return self.unpacked[plane, block]

    def ones(self, plane: int, at: int) -> int:
        """Number of ones before position ``at`` of a plane."""
        if at == 0 or self.blocks == 0:
            return 0
        block = min(at // BLOCK_BITS, self.blocks - 1)
        return int(self.before[plane][block]) + int(self.block(plane, block)[:at - block * BLOCK_BITS].sum())

    def access(self, at: int) -> int:
        token = 0
        for plane in range(self.bits):
            bit = int(self.block(plane, at // BLOCK_BITS)[at % BLOCK_BITS])
            ones = self.ones(plane, at)
            at = self.zeros[plane] + ones if bit else at - ones
            token = token << 1 | bit
        return token

    def span(self, token: int, at: int) -> tuple[int, int]:
        """After the last plane: where the token's run starts, and where it ends if only tokens before ``at`` count."""
        low, high = 0, at
        for plane in range(self.bits):
            ones_low, ones_high = self.ones(plane, low), self.ones(plane, high)
            if token >> (self.bits - 1 - plane) & 1:
                low, high = self.zeros[plane] + ones_low, self.zeros[plane] + ones_high
            else:
                low, high = low - ones_low, high - ones_high
        return low, high

    def rank(self, token: int, at: int | None = None) -> int:
        """How often the token stands before position ``at`` (None: in the whole shard)."""
        if token >> self.bits:
            return 0
        low, high = self.span(token, self.length if at is None else at)
        return high - low

    def select(self, token: int, k: int) -> int:
        """Position of the k-th occurrence (from 0) of the token."""
        if not 0 <= k < self.rank(token):
            raise IndexError(k)
        at = self.span(token, self.length)[0] + k
        for plane in reversed(range(self.bits)):
            bit = token >> (self.bits - 1 - plane) & 1
            at = self._find(plane, bit, at - self.zeros[plane] if bit else at)
        return at

    def _find(self, plane: int, bit: int, k: int) -> int:
        """Position of the k-th one (or zero) of a plane."""
        starts = self.before[plane].astype(np.int64)
        if not bit:
            starts = np.arange(self.blocks) * BLOCK_BITS - starts
        block = int(np.searchsorted(starts, k, "right")) - 1
        return block * BLOCK_BITS + int(np.flatnonzero(self.block(plane, block) == bit)[k - int(starts[block])])

    def tokens(self) -> np.ndarray:
        """All ids of the shard in order."""
        values = np.zeros(self.length, np.uint16 if self.bits <= 16 else np.uint32)
        for plane in reversed(range(self.bits)):
            if not self.length:
                break
            ones = np.concatenate([self.block(plane, b) for b in range(self.blocks)]).astype(bool)
            self.unpacked.clear()
            merged = np.empty_like(values)
            merged[~ones] = values[:self.zeros[plane]]
            merged[ones] = values[self.zeros[plane]:] | values.dtype.type(1 << (self.bits - 1 - plane))
            values = merged
        return values


def write_ids(docs: DataFrame, path: str, tokenizer_path: str, shard_tokens: int = SHARD_TOKENS,
              id_column: str = "doc_id", text_column: str = "text") -> None:
    """Tokenise the documents in ascending id and write them as shards below ``path``."""

    def run(batches):
        from pyspark import TaskContext

        encoder = for_this_worker(f"bytes {tokenizer_path}", lambda: ByteLevelEncoder(tokenizer_path))
        end = END_ID.to_bytes(4, "little")
        number, shard = TaskContext.get().partitionId(), 0
        ids, doc_ids, size = [], [], 0

        def closed():
            tokens = np.frombuffer(b"".join(ids), "<u4")
            content = build(tokens, doc_ids, [len(own) // 4 for own in ids])
            return next(batches_of([[(number, shard, len(doc_ids), len(tokens), content)]], SHARDS))

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids.append(encoder.ids(text) + end)
                doc_ids.append(doc_id)
                size += len(ids[-1]) // 4
                if size >= shard_tokens:
                    yield closed()
                    ids, doc_ids, size, shard = [], [], 0, shard + 1
        if doc_ids:
            yield closed()

    (docs.select(column_of(docs, id_column, "long").alias("doc_id"), column_of(docs, text_column, "string").alias("text"))
     .repartitionByRange("doc_id").sortWithinPartitions("doc_id")
     .mapInArrow(run, SHARDS).write.option("compression", "uncompressed").parquet(path))


def shard_starts(shards: DataFrame) -> DataFrame:
    """Tokens before each shard: first per range of ids, then within it. Reads no content."""
    sizes = shards.groupBy("range").agg(F.sum("tokens").alias("tokens"))
    earlier = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # one row per write task
    ranges = sizes.select("range", F.coalesce(F.sum("tokens").over(earlier), F.lit(0)).alias("range_start"))
    inside = Window.partitionBy("range").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return shards.select("range", "shard", F.coalesce(F.sum("tokens").over(inside), F.lit(0)).alias("before")).join(
        ranges, "range").select("range", "shard", (F.col("range_start") + F.col("before")).alias("shard_start"))


def read_documents(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """The documents of written shards: id, position of the first token among all, tokens, crc32 of the ids.

    ``with_ids`` adds the ids themselves (``ids``, four bytes each).
    """
    schema = DOCUMENTS + (", ids binary" if with_ids else "")

    def run(batches):
        for batch in batches:
            for number, shard, content in zip(*(batch.column(i).to_pylist() for i in range(3))):
                reader = WaveletShard(content)
                ids = reader.tokens().astype("<u4")
                ends = np.cumsum(reader.counts)
                rows = []
                for doc, at, end in zip(reader.doc_ids, (ends - reader.counts).tolist(), ends.tolist()):
                    own = ids[at:end].tobytes()
                    rows.append((number, shard, doc, at, end - at, zlib.crc32(own)) + ((own,) if with_ids else ()))
                yield from batches_of([rows], schema)

    shards = spark.read.parquet(path)
    found = shards.select("range", "shard", "content").mapInArrow(run, schema)
    return found.join(shard_starts(shards), ["range", "shard"]).withColumn(
        "start", F.col("start") + F.col("shard_start")).drop("range", "shard", "shard_start")


def op8_wavelet_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "token-shards")
    write_ids(read_table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"))
    return read_documents(spark, path)
