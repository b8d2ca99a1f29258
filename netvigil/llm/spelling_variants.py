"""Spelling variants by reduced-alphabet generation.

Letters are hashed to a few symbols. Two words that differ by one edit have
reduced words that are equal or differ by one edit, so the whole one-edit
neighbourhood of every reduced word (deletions, replacements, insertions of each
symbol) is generated and joined to the reduced vocabulary; what meets is verified
on the original strings by their edit distance. With few symbols a neighbourhood
is a few times the length of a word, instead of a few times the alphabet.

A reduced word is named by a polynomial of its symbols modulo 2**64, so that all
its neighbours' names are sums of prefix, symbol and shifted suffix, computed for
all words of one length at once. Equal names of different reduced words only add
candidates. A bitmap of the reduced vocabulary (``BITMAP_BITS``, whatever the
vocabulary) is broadcast, so that neighbours that are no reduced word of the
vocabulary do not reach the shuffle; if it fills up, more of them do.

Words are counted once per document, task and shuffle, so a word that makes up a
third of all text costs one row per task. A word meets its near words and, by
chance, words of neighbouring reduced forms; no group of words is paired with
itself.

Results of ``group_variants`` (one row per word):

* a null or empty text has no words; texts are read whole, and runs of any length count;
* a null id counts as an empty text in the hash; rows that repeat an id and text count again;
* of near words with the largest count the smallest in code-point order is the form;
* a word without near words has ``n_near`` 0 and is its own root; an empty table gives an empty table;
* only the named columns are read, so other columns never clash.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from netvigil.llm.common import batches_of, column_of, kept, read_table

# Fixed values of the contract.
CHANGED_OF = 31
LEAST_LENGTH = 7
LEAST_COUNT = 2
FORM_FACTOR = 10

SYMBOLS = 8
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
BITMAP_BITS = 1 << 27
BITMAP_HASHES = 2
# Rows of a bitmap aggregate hold so many bits.
BUCKET_BITS = 32_768
# Words counted in a task before they are passed on, and positions of words whose neighbours are generated at a time.
COUNTED_WORDS = 400_000
POSITIONS = 200_000
COUNTS, NAMED, PROBES = "word string, n long", "word string, n long, name long", "word string, n long, name long"

# Runs of letters in UTF-8: U+00C0 to U+00FF are the byte C3 and a second byte.
_run = re.compile(rb"(?:[a-z]+|(?:\xc3[\x80-\xbf])+)+")
_other_letters = re.compile(rb"[\xc2\xc4-\xf4]")
_to_spaces = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b == 0xC3 or 0x80 <= b <= 0xBF else 32
                   for b in range(256))


def runs_of(text: str) -> list[bytes]:
    """The maximal runs of letters of a text in UTF-8, with A-Z lower-cased."""
    raw = text.encode()
    if _other_letters.search(raw):
        return _run.findall(raw.lower())  # of bytes, lower() changes A-Z only
    return raw.translate(_to_spaces).split()


def changed(run: bytes, seed: int, changed_of: int = CHANGED_OF) -> str:
    """The run, without one of its letters if its hash (begun with ``seed``) says so."""
    h = zlib.crc32(run, seed)
    word = run.decode()
    if h % changed_of:
        return word
    at = h % len(word)
    return word[:at] + word[at + 1:]


def count_words(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT,
                changed_of: int = CHANGED_OF, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(word, n) of the words of at least ``least_length`` letters that occur ``least_count`` times or more."""

    def run(batches):
        counts: dict[str, int] = {}
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                seed = zlib.crc32(b"%s:" % str("" if doc_id is None else doc_id).encode())
                own = Counter([r for r in runs_of(text or "") if len(r) >= least_length])
                for found, n in own.items():
                    word = changed(found, seed, changed_of)
                    if len(word) >= least_length:
                        counts[word] = counts.get(word, 0) + n
                if len(counts) >= COUNTED_WORDS:
                    yield from batches_of([counts.items()], COUNTS)
                    counts = {}
        yield from batches_of([counts.items()], COUNTS)

    found = docs.select(column_of(docs, id_column, "long").alias("doc_id"),
                        column_of(docs, text_column, "string").alias("text")).mapInArrow(run, COUNTS)
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def symbols_of(words: list[str], symbols: int = SYMBOLS) -> np.ndarray:
    """The symbols (from 1) of words of one length, a row per word."""
    points = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").reshape(len(words), -1)
    return (points.astype(np.uint64) * np.uint64(2654435761) >> np.uint64(15)) % np.uint64(symbols) + np.uint64(1)


def powers(length: int) -> np.ndarray:
    out = np.full(length + 1, BASE, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def names_of(rows: np.ndarray) -> np.ndarray:
    """The name of each row of symbols."""
    return (rows * powers(rows.shape[1])[:-1]).sum(axis=1, dtype=np.uint64)


def neighbour_names(rows: np.ndarray, symbols: int, keep):
    """(row, name) of all neighbours of one edit, and of the rows themselves, as far as ``keep`` says.

    Every neighbour comes once: of equal symbols in a row the first is deleted, and a symbol is inserted
    only before a different one.
    """
    count, length = rows.shape
    shift, zero = powers(length), np.zeros((count, 1), np.uint64)
    prefix = np.concatenate([zero, np.cumsum(rows * shift[:-1], axis=1, dtype=np.uint64)], axis=1)
    whole = prefix[:, -1:]
    number = np.arange(count)
    found = []

    def add(names, mask=None):
        owner = np.broadcast_to(number[:, None], names.shape)
        names, owner = (names.ravel(), owner.ravel()) if mask is None else (names[mask], owner[mask])
        good = keep(names)
        found.append((owner[good], names[good]))

    add(whole)
    first_of_run = np.concatenate([np.ones((count, 1), bool), rows[:, 1:] != rows[:, :-1]], axis=1)
    add(prefix[:, :-1] + (whole - prefix[:, 1:]) * np.uint64(INVERSE), first_of_run)
    longer = (whole - prefix) * np.uint64(BASE) + prefix
    after = np.concatenate([rows, zero], axis=1)
    for symbol in range(1, symbols + 1):
        symbol = np.uint64(symbol)
        add(whole + (symbol - rows) * shift[:-1], rows != symbol)
        add(longer + symbol * shift, after != symbol)
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def by_length(words: list[str]) -> dict[int, list[int]]:
    groups: dict[int, list[int]] = {}
    for i, word in enumerate(words):
        groups.setdefault(len(word), []).append(i)
    return groups


def with_names(words: DataFrame, symbols: int = SYMBOLS) -> DataFrame:
    """Words with the name of their reduced word."""

    def run(batches):
        for batch in batches:
            listed, counts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            names = np.zeros(len(listed), np.uint64)
            for own in by_length(listed).values():
                names[own] = names_of(symbols_of([listed[i] for i in own], symbols))
            yield from batches_of([zip(listed, counts, names.view(np.int64).tolist())], NAMED)

    return words.select("word", "n").mapInArrow(run, NAMED)


def mixed(names: np.ndarray, number: int, bits: int) -> np.ndarray:
    """A place in the bitmap: the name times an odd factor, its upper bits."""
    factor = np.uint64((0xD1342543DE82EF95, 0xAF251AF3B0F025B5)[number])
    return (names ^ (names >> np.uint64(31))) * factor >> np.uint64(64 - bits.bit_length() + 1)


def bitmap(named: DataFrame, bits: int = BITMAP_BITS) -> np.ndarray:
    """The places of all names, as bytes: ``bits`` / 8 of them, whatever the number of names."""

    def places(batches):
        for batch in batches:
            names = np.unique(batch.column(0).to_numpy().view(np.uint64))
            for number in range(BITMAP_HASHES):
                at = mixed(names, number, bits).astype(np.int64)
                yield from batches_of([zip((at // BUCKET_BITS).tolist(), (at % BUCKET_BITS).tolist())], "bucket long, bit long")

    dealt = named.select("name").mapInArrow(places, "bucket long, bit long").repartition("bucket")
    out = np.zeros(bits // 8, np.uint8)
    # At most bits / 32,768 rows of 4 KB.
    for bucket, content in dealt.groupBy("bucket").agg(F.bitmap_construct_agg("bit")).collect():
        at = bucket * BUCKET_BITS // 8
        out[at:at + BUCKET_BITS // 8] = np.frombuffer(bytes(content), np.uint8)[:len(out) - at]
    return out


def probes(named: DataFrame, symbols: int = SYMBOLS, bits: int = BITMAP_BITS) -> DataFrame:
    """Each word with the names of its reduced word's neighbours that can be in the vocabulary."""
    shared = named.sparkSession.sparkContext.broadcast(bitmap(named, bits))

    def keep(names):
        found = np.ones(len(names), bool)
        for number in range(BITMAP_HASHES):
            at = mixed(names, number, bits)
            found &= (shared.value[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
        return found

    def run(batches):
        for batch in batches:
            listed, counts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for length, own in by_length(listed).items():
                step = max(1, POSITIONS // length)
                for at in range(0, len(own), step):
                    part = own[at:at + step]
                    rows, names = neighbour_names(symbols_of([listed[i] for i in part], symbols), symbols, keep)
                    pairs = np.unique(np.stack([rows.astype(np.uint64), names]), axis=1)  # names may coincide
                    yield from batches_of([((listed[part[r]], counts[part[r]], name) for r, name in
                                            zip(pairs[0].tolist(), pairs[1].view(np.int64).tolist()))], PROBES)

    return named.select("word", "n").mapInArrow(run, PROBES)


def near_words(named: DataFrame, symbols: int = SYMBOLS, bits: int = BITMAP_BITS) -> DataFrame:
    """(word, n, near, near_n) of all words one edit apart; every word also meets itself."""
    other = named.select("name", F.col("word").alias("near"), F.col("n").alias("near_n"))
    return probes(named, symbols, bits).join(other, "name").where(
        F.levenshtein("word", "near", 1) >= 0).select("word", "n", "near", "near_n")


def with_roots(words: DataFrame) -> DataFrame:
    """``root``: the word at the end of the chain of forms. Chains halve in every round, as roots point to roots.

    Along a chain counts grow by ``FORM_FACTOR``, so it has no circles and few rounds are needed.
    """
    chains = kept(words.where("form IS NOT NULL").select("word", F.col("form").alias("root")))
    while True:
        further = chains.select(F.col("word").alias("root"), F.col("root").alias("next"))
        chains = kept(chains.join(further, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        moved = not chains.where("moved").isEmpty()
        chains = chains.drop("moved")
        if not moved:
            return words.join(chains, "word", "left").withColumn("root", F.coalesce("root", "word"))


def group_variants(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT,
                   factor: int = FORM_FACTOR, changed_of: int = CHANGED_OF, symbols: int = SYMBOLS,
                   bits: int = BITMAP_BITS, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Every word with its form, the root of its forms, and the number of near words."""
    words = count_words(docs, least_length, least_count, changed_of, id_column, text_column)
    named = kept(with_names(words, symbols))
    other = F.col("near") != F.col("word")
    best = F.min(F.when(other, F.struct((-F.col("near_n")).alias("less"), "near")))
    judged = near_words(named, symbols, bits).groupBy("word").agg(
        F.max("n").alias("n"), F.count_if(other).alias("n_near"), best.alias("best"))
    formed = -F.col("best.less") >= factor * F.col("n")
    words = kept(judged.select("word", "n", F.when(formed, F.col("best.near")).alias("form"), "n_near",
                               F.when(formed, -F.col("best.less")).alias("form_n")))
    return with_roots(words).select("word", "form", "root", "n", "n_near", "form_n")


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return group_variants(read_table(spark, sf_dir, "documents"))
