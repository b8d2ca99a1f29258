"""Byte-level BPE with vectorised pre-tokenisation: class arrays, a scan of transition functions, cached merges.

A block of texts becomes one array of code points, with a break after each text.
Every code point gets a symbol from its class (letter, number, white space, other)
and from the classes of the two code points after it. The splitting pattern is
then an automaton of eight states, and a symbol is a function from states to
states. Composition is associative, so the state before every code point comes
from a prefix scan: rows of the block are composed side by side, then their
totals by the same scan, then every row is run from its own state. Where a token
starts is a table of state and symbol. No regular expression reads a text.

The slices between the starts go to a table of merged slices that each Python
worker keeps; a slice that is not in it is merged pair by pair, lowest rank
first. Token lengths give the byte at which every token starts, and decoding
copies the tokens' bytes back.

The classes are those of the ``tiktoken`` library's own regular expressions
(its Unicode tables are newer than Python's), asked once per worker.

Results (one row per row of the input):

* a null text counts as empty; an empty text has no ids and decodes to nothing;
* texts of any length are encoded whole: blocks hold whole texts, and the scan goes through a block in
  segments, from the state in which the last one ended;
* repeated rows and null ids stay as they are; an empty table gives an empty table;
* of the input only the two named columns are read, so other columns never clash.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from array import array
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from netvigil.llm.chunks import TABLE_ENTRIES, ChunkTable, for_this_worker
from netvigil.llm.common import batches_of, column_of, read_table, text_blocks

# Fixed value: the only pattern that the automaton below stands for.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
SHORT_ENDINGS, LONG_ENDINGS = "stmd", ("re", "ve", "ll")

# Classes of code points.
OTHER, LETTER, NUMBER, WHITE = range(4)
# Symbols: letters, numbers, others; an apostrophe with one or two letters of an ending; a space that the next token
# takes in; other white space before a token; white space before white space or the end; the break between texts.
S_LETTER, S_NUMBER, S_OTHER, S_END1, S_END2, S_SPACE, S_LAST, S_WHITE, S_BREAK = range(9)
# States: a token must start; within letters, numbers, others; after a space to be taken in; within white space; within
# an ending with one or two letters to come.
FREE, LETTERS, NUMBERS, OTHERS, SPACED, WHITES, ONE_LEFT, TWO_LEFT = range(8)
STATES, SYMBOLS = 8, 9

SEGMENT = 1 << 18
ROW = 64
BLOCK_BYTES = 4 << 20
SHORT_BYTES = 64
DIGESTS = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
TOKENS = "doc_id long, ids array<long>, starts array<long>"


def automaton() -> tuple[np.ndarray, np.ndarray]:
    """State after, and whether a token starts at a code point, by state before and symbol."""
    after, starts = np.zeros((STATES, SYMBOLS), np.uint8), np.ones((STATES, SYMBOLS), bool)
    runs = {S_LETTER: LETTERS, S_NUMBER: NUMBERS, S_OTHER: OTHERS, S_END1: OTHERS, S_END2: OTHERS}
    for symbol, run in runs.items():
        after[:, symbol] = run
        starts[[run, SPACED], symbol] = False  # a run goes on, or takes in the space before it
    for symbol, ending in ((S_END1, ONE_LEFT), (S_END2, TWO_LEFT)):  # an ending is one only where a token starts
        after[starts[:, symbol], symbol] = ending
    after[TWO_LEFT, :], after[ONE_LEFT, :] = ONE_LEFT, FREE
    starts[[ONE_LEFT, TWO_LEFT], :] = False
    after[:, S_SPACE], after[:, S_LAST], after[:, S_WHITE], after[:, S_BREAK] = SPACED, FREE, WHITES, FREE
    starts[:, [S_SPACE, S_LAST, S_WHITE]] = True
    starts[WHITES, S_WHITE] = False
    starts[:, S_BREAK] = True  # so that the last slice of a text ends here
    return after, starts


class Transitions:
    """All compositions of the symbols' functions, numbered, with the table that composes two of them."""

    def __init__(self):
        self.after, self.starts = automaton()
        found = {tuple(range(STATES)): 0}
        symbols = [tuple(self.after[:, s].tolist()) for s in range(SYMBOLS)]
        queue = list(found)
        while queue:
            first = queue.pop()
            for then in symbols:
                both = tuple(then[state] for state in first)
                if both not in found:
                    found[both] = len(found)
                    queue.append(both)
        self.functions = np.array(list(found), np.uint8)
        self.of_symbol = np.array([found[s] for s in symbols], np.uint16)
        self.compose = np.array([[found[tuple(then[state] for state in first)] for then in found] for first in found],
                                np.uint16)

    def totals(self, functions: np.ndarray) -> np.ndarray:
        """Per row: its functions one after the other."""
        columns = np.ascontiguousarray(functions.T)
        total = columns[0]
        for column in columns[1:]:
            total = self.compose[total, column]
        return total

    def before_rows(self, totals: np.ndarray, state: int) -> np.ndarray:
        """The state before every row: a scan of the rows' totals, by rows of rows."""
        if len(totals) <= ROW:
            states = [state, *accumulate(totals[:-1].tolist(), lambda s, f: int(self.functions[f, s]), initial=state)][1:]
            return np.array(states, np.uint8)
        padded = np.zeros(-(-len(totals) // ROW) * ROW, totals.dtype)
        padded[:len(totals)] = totals
        rows = padded.reshape(-1, ROW)
        states = self.before_rows(self.totals(rows), state)
        out = np.empty((ROW, len(rows)), np.uint8)
        for i, column in enumerate(np.ascontiguousarray(rows.T)):
            out[i] = states
            states = self.functions[column, states]
        return out.T.reshape(-1)[:len(totals)]

    def run(self, symbols: np.ndarray, state: int) -> tuple[np.ndarray, int]:
        """Whether a token starts, for every symbol, and the state after the last."""
        n = len(symbols)
        padded = np.full(-(-n // ROW) * ROW, S_BREAK, np.uint8)
        padded[:n] = symbols
        columns = np.ascontiguousarray(padded.reshape(-1, ROW).T)
        rows = self.of_symbol[columns].T
        states = self.before_rows(self.totals(rows), state)
        starts, last = np.empty(columns.shape, bool), (n - 1) % ROW
        end = state
        for i, column in enumerate(columns):
            starts[i] = self.starts[states, column]
            states = self.after[states, column]
            if i == last:
                end = int(states[-1])
        return starts.T.reshape(-1)[:n], end


def class_table() -> np.ndarray:
    """The class of every code point, as the library's regular expressions see it."""
    import tiktoken

    single = {bytes([b]): b for b in range(256)}
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    classes = np.zeros(0x110000, np.uint8)
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (WHITE, r"\s+")):
        library = tiktoken.Encoding("class", pat_str=pattern, mergeable_ranks=single, special_tokens={})
        members = bytes(library.encode_ordinary(every)).decode()
        classes[np.frombuffer(members.encode("utf-32-le"), "<u4")] = kind
    return classes


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one slice: of all neighbours whose join has a rank, the lowest (then leftmost) are joined first."""
    if piece in ranks:
        return [ranks[piece]]
    if len(piece) > SHORT_BYTES:
        return merge_long(piece, ranks)
    none, rank = len(ranks), ranks.get
    parts = [piece[i:i + 1] for i in range(len(piece))]
    joins = [rank(a + b, none) for a, b in zip(parts, parts[1:])]
    while joins and (low := min(joins)) < none:
        i = joins.index(low)
        parts[i] += parts.pop(i + 1)
        del joins[i]
        if i:
            joins[i - 1] = rank(parts[i - 1] + parts[i], none)
        if i < len(joins):
            joins[i] = rank(parts[i] + parts[i + 1], none)
    return [ranks[part] for part in parts]


def merge_long(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """As ``merge``, with a heap of candidates: a slice of n bytes takes n log n steps."""
    n = len(piece)
    end, before = list(range(1, n + 1)), list(range(-1, n - 1))  # of the part that starts at a byte; 0 once it is gone
    heap = []

    def offer(left: int) -> None:
        right = end[left]
        if right < n and (rank := ranks.get(piece[left:end[right]])) is not None:
            heapq.heappush(heap, (rank, left, end[right]))

    for left in range(n - 1):
        offer(left)
    while heap:
        _, left, upto = heapq.heappop(heap)
        right = end[left]
        if not right or right >= n or end[right] != upto:
            continue  # one of the two has changed since
        end[left], end[right] = upto, 0
        if upto < n:
            before[upto] = left
        offer(left)
        if before[left] >= 0:
            offer(before[left])
    ids, at = [], 0
    while at < n:
        ids.append(ranks[piece[at:end[at]]])
        at = end[at]
    return ids


class Encoded:
    """Ids of a block of texts. ``bounds``: where each text's ids begin, and the end of the last.

    ``starts``: for each id the byte of its own text at which it starts.
    """

    def __init__(self, ids: np.ndarray, bounds: np.ndarray, starts: np.ndarray):
        self.ids, self.bounds, self.starts = ids, bounds, starts


class ScanCodec:
    """``encode`` blocks of texts and ``decode`` ids with one vocabulary."""

    def __init__(self, path: str, pattern: str = PATTERN, entries: int = TABLE_ENTRIES, segment: int = SEGMENT):
        if pattern != PATTERN:
            raise ValueError(f"the automaton stands for {PATTERN} only")
        self.ranks = read_ranks(path)
        if missing := [b for b in range(256) if bytes([b]) not in self.ranks]:
            raise ValueError(f"the vocabulary lacks the bytes {missing}")
        self.classes, self.transitions = class_table(), Transitions()
        self.segment = segment
        self.bytes_of = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            self.bytes_of[rank] = token
        self.sizes = np.array([len(token) for token in self.bytes_of], np.int64)
        self.decimals = [str(i) for i in range(len(self.bytes_of))]
        self.table = ChunkTable(lambda piece: array("I", merge(piece, self.ranks)).tobytes(), entries)

    def symbols(self, points: np.ndarray, breaks: np.ndarray, upto: int) -> np.ndarray:
        """Symbols of the first ``upto`` code points; those after them are only looked at. ``breaks`` marks the breaks."""
        classes = self.classes[points]
        classes[breaks] = WHITE  # white space before the end of a text is as white space before white space
        out = np.array([S_OTHER, S_LETTER, S_NUMBER, S_WHITE], np.uint8)[classes[:upto]]
        next_white = np.ones(upto, bool)  # nothing follows the very last
        following = classes[1:upto + 1] == WHITE
        next_white[:len(following)] = following
        last = (out == S_WHITE) & ~next_white
        out[last] = S_LAST
        out[last & (points[:upto] == ord(" "))] = S_SPACE
        marks = np.flatnonzero(points[:upto] == ord("'"))
        if len(marks):
            padded = np.append(points, [0, 0])
            one, two = padded[marks + 1], padded[marks + 2]
            out[marks[np.isin(one, [ord(c) for c in SHORT_ENDINGS])]] = S_END1
            for first, second in LONG_ENDINGS:
                out[marks[(one == ord(first)) & (two == ord(second))]] = S_END2
        out[breaks[:upto]] = S_BREAK
        return out

    def token_starts(self, points: np.ndarray, breaks: np.ndarray) -> np.ndarray:
        """Places where a token starts or a text ends, segment by segment."""
        found, state = [], FREE
        for at in range(0, len(points), self.segment):
            upto = min(self.segment, len(points) - at)
            ahead = slice(at, at + upto + 2)
            starts, state = self.transitions.run(self.symbols(points[ahead], breaks[ahead], upto), state)
            found.append(np.flatnonzero(starts) + at)
        return np.concatenate(found) if found else np.zeros(0, np.int64)

    def slices(self, texts: list[str]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        """The distinct slices of the texts, the number of each slice among them, and the slices before each text."""
        import pyarrow as pa

        joined = "\n".join(texts) + "\n"
        points = np.frombuffer(joined.encode("utf-32-le"), "<u4")
        breaks = np.zeros(len(points), bool)
        breaks[np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1) - 1] = True
        places = self.token_starts(points, breaks)
        widths = np.ones(len(points), np.uint8)
        for least in (0x80, 0x800, 0x10000):
            widths += points >= least
        offsets = np.zeros(len(points) + 1, np.int64)
        np.cumsum(widths, out=offsets[1:])
        at, data = np.append(offsets[places], offsets[-1]), joined.encode()
        every = pa.Array.from_buffers(pa.large_binary(), len(places), [None, pa.py_buffer(at), pa.py_buffer(data)])
        encoded, is_break = every.dictionary_encode(), breaks[places]
        bounds = np.zeros(len(texts) + 1, np.int64)
        bounds[1:] = np.flatnonzero(is_break) - np.arange(len(texts))
        return encoded.dictionary.to_pylist(), encoded.indices.to_numpy()[~is_break], bounds

    def encode(self, texts: list[str]) -> Encoded:
        """Ids of every text, with the byte at which each token starts."""
        if not texts:
            return Encoded(np.zeros(0, np.int64), np.zeros(1, np.int64), np.zeros(0, np.int64))
        distinct, which, bounds = self.slices(texts)
        ids_of = [self.table[piece] for piece in distinct]
        sizes = np.fromiter(map(len, ids_of), np.int64, len(ids_of)) // 4
        flat, begins = np.frombuffer(b"".join(ids_of), np.uint32).astype(np.int64), np.cumsum(sizes) - sizes
        counts = sizes[which]
        ends = np.zeros(len(which) + 1, np.int64)
        np.cumsum(counts, out=ends[1:])
        ids = flat[np.repeat(begins[which] - ends[:-1], counts) + np.arange(ends[-1])]
        bounds = ends[bounds]
        byte_ends = np.zeros(len(ids) + 1, np.int64)
        np.cumsum(self.sizes[ids], out=byte_ends[1:])
        starts = byte_ends[:-1] - np.repeat(byte_ends[bounds[:-1]], np.diff(bounds))
        return Encoded(ids, bounds, starts)

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


def worker_codec(path: str, pattern: str) -> ScanCodec:
    return for_this_worker(f"scan {path} {pattern}", lambda: ScanCodec(path, pattern))


def over_blocks(docs: DataFrame, rows_of_block, schema: str, path: str, pattern: str, id_column: str,
                text_column: str) -> DataFrame:
    """``rows_of_block(codec, ids, encoded)`` for every block of documents."""

    def run(batches):
        codec = worker_codec(path, pattern)

        def rows(block):
            texts = block.column(1).fill_null("").to_pylist()
            return rows_of_block(codec, block.column(0).to_pylist(), codec.encode(texts))

        yield from batches_of((rows(block) for batch in batches for block in text_blocks(batch, 1, BLOCK_BYTES)), schema)

    return docs.select(column_of(docs, id_column, "long").alias("doc_id"),
                       column_of(docs, text_column, "string").alias("text")).mapInArrow(run, schema)


def encode_documents(docs: DataFrame, path: str, pattern: str = PATTERN, id_column: str = "doc_id",
                     text_column: str = "text") -> DataFrame:
    """Ids of every row's text and the byte at which each token starts (columns ``doc_id``, ``ids``, ``starts``)."""

    def rows(codec, doc_ids, encoded) -> Iterator[tuple]:
        bounds = encoded.bounds.tolist()
        for doc_id, a, b in zip(doc_ids, bounds, bounds[1:]):
            yield doc_id, encoded.ids[a:b].tolist(), encoded.starts[a:b].tolist()

    return over_blocks(docs, rows, TOKENS, path, pattern, id_column, text_column)


def decode_documents(tokens: DataFrame, path: str, id_column: str = "doc_id", ids_column: str = "ids") -> DataFrame:
    """The bytes that the ids of every row stand for (columns ``doc_id``, ``decoded``); null ids give no bytes."""

    def run(batches):
        codec = worker_codec(path, PATTERN)
        yield from batches_of(([(doc_id, codec.decode(ids or ())) for doc_id, ids in
                                zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())] for batch in batches),
                              "doc_id long, decoded binary")

    return tokens.select(column_of(tokens, id_column, "long").alias("doc_id"),
                         column_of(tokens, ids_column, "array<long>").alias("ids")).mapInArrow(
                             run, "doc_id long, decoded binary")


def digest_documents(docs: DataFrame, path: str, pattern: str = PATTERN, id_column: str = "doc_id",
                     text_column: str = "text") -> DataFrame:
    """Token count, digest of the ids and digest of the bytes decoded from them, without storing either."""

    def rows(codec, doc_ids, encoded) -> Iterator[tuple]:
        bounds = encoded.bounds.tolist()
        for doc_id, a, b in zip(doc_ids, bounds, bounds[1:]):
            ids = encoded.ids[a:b].tolist()
            yield (doc_id, b - a, hashlib.sha256(" ".join(map(codec.decimals.__getitem__, ids)).encode()).hexdigest(),
                   hashlib.sha256(codec.decode(ids)).hexdigest())

    return over_blocks(docs, rows, DIGESTS, path, pattern, id_column, text_column)


def op12_scan_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest_documents(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"),
                            public_tokenizers.PATTERN)
