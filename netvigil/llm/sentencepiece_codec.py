"""SentencePiece encoding and decoding by a table of distinct marked words.

The library writes every space as a marker and puts one marker before the text.
No piece of the vocabulary has a marker after another character (checked when
the model is loaded), so no piece crosses the start of a marked word: the ids of
a text are those of its marked words, one after the other. Each distinct marked
word is segmented and decoded once per task, and its ids and its text are
joined back by position.

Results of ``encode_documents`` (one row per row of the input):

* a null text counts as empty; an empty text has no ids and decodes to an empty text;
* repeated rows and null ids stay as they are; an empty table gives an empty table;
* of the input only the two named columns are read, so other columns never clash.
"""

from __future__ import annotations

import hashlib
import re

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from netvigil.llm.common import batches_of, column_of, read_table

MARK = "▁"
# Characters handled between two fillings of the table.
BLOCK_CHARS = 2_000_000
TABLE_ENTRIES = 500_000
KEPT_CHARS = 64
SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"

_chunk = re.compile(f"{MARK}+[^{MARK}]*")


class Codec:
    """``encode`` and ``decode`` of one model through the distinct-chunk table."""

    def __init__(self, path: str, entries: int = TABLE_ENTRIES):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = (self.model.id_to_piece(i) for i in range(self.model.get_piece_size()))
        self.separable = not any(MARK in piece.lstrip(MARK) for piece in pieces)
        self.entries = entries
        self.table: dict[str, tuple[str, int, str]] = {}

    def chunks(self, text: str) -> list[str]:
        """The marked words of a text, each without its first marker and with spaces for the others."""
        if not text:
            return []
        if not self.separable:
            return [text]
        if not (MARK in text or "  " in text or text[0] == " " or text[-1] == " "):
            return text.split(" ")
        chunks = [c[1:].replace(MARK, " ") for c in _chunk.findall(MARK + text.replace(" ", MARK))]
        if not chunks[-1]:  # a lone marker at the end would come back as nothing
            chunks[-2:] = [chunks[-2] + " "]
        return chunks

    def look_up(self, chunks: set[str]) -> dict[str, tuple[str, int, str]]:
        """For each chunk: its ids in decimal joined by commas, their number, and the text decoded from them."""
        if len(self.table) > self.entries:
            self.table = {}
        new = list(chunks.difference(self.table))
        found = {}
        ids = self.model.encode(new, num_threads=1) if new else []
        texts = self.model.decode(ids, num_threads=1) if new else []
        for chunk, own, text in zip(new, ids, texts):
            entry = (str(own)[1:-1].replace(" ", ""), len(own), chunk if text == chunk else text)
            (self.table if len(chunk) <= KEPT_CHARS else found)[chunk] = entry
        if not found:
            return self.table
        return {c: found[c] if c in found else self.table[c] for c in chunks}


def encode_blocks(codec: Codec, rows):
    """(key, n_tokens, ids joined by commas, decoded text) of (key, text) pairs, block by block."""

    def finish(block):
        table = codec.look_up(set().union(*(chunks for _, chunks in block)))
        for key, chunks in block:
            parts = [table[chunk] for chunk in chunks]
            yield (key, sum([p[1] for p in parts]), ",".join([p[0] for p in parts]), " ".join([p[2] for p in parts]))

    block, size = [], 0
    for key, text in rows:
        block.append((key, codec.chunks(text or "")))
        size += len(text or "")
        if size >= BLOCK_CHARS:
            yield from finish(block)
            block, size = [], 0
    yield from finish(block)


def encode_documents(docs: DataFrame, model_path: str, id_column: str = "doc_id",
                     text_column: str = "text") -> DataFrame:
    """Token count, digest of the ids and digest of the decoded text of every row."""

    def run(batches):
        codec = Codec(model_path)

        def digests(batch):
            rows = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            for key, n, ids, text in encode_blocks(codec, rows):
                yield (key, n, hashlib.sha256(ids.encode()).hexdigest(),
                       hashlib.sha256(text.encode()).hexdigest())

        yield from batches_of((digests(batch) for batch in batches), SCHEMA)

    return docs.select(column_of(docs, id_column, "long").alias("doc_id"),
                       column_of(docs, text_column, "string").alias("text")).mapInArrow(run, SCHEMA)


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(read_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
