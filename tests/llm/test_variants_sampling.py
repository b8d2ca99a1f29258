"""Operators 11 to 13 against brute force, the tiktoken library and odd rows."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from netvigil.llm import importance_sampling as sampling
from netvigil.llm import scan_bpe
from netvigil.llm import spelling_variants as spelling

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
SIGNS = ["'", "s", "t", "re", "ve", "ll", "m", "d", " ", "  ", "\n", "\t", " ", "　", "a", "B", "é", "漢", "1", "½",
         "٣", "!", "-", "‍", "👍", "\x1c", "\x85", "ͅ", "r", "e", "v", "l"]
ODD = ["", None, " ", "\n", "'", "'s", "''s", " 's", "\n's", "it's we'll I'VE 'tis", "a  b \n\n c\t", "don't" * 50, "x" * 3000,
       "word " * 3000, "ab\x00c <|endoftext|>", "  lead", "trail  ", "¼ ½ 12345", "é" * 200 + "'re" * 100]


def schema_rows(spark, texts):
    """Texts with repeated rows, a null id, and columns whose names clash with those of the operators."""
    rows = [(i, t, "x", 1) for i, t in enumerate(texts)] + [(None, "no id at all", "x", 1), (4, texts[4], "x", 1)]
    return spark.createDataFrame(rows, "doc_id long, text string, n string, word int")


# --- 12 ------------------------------------------------------------------------

@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=scan_bpe.read_ranks(RANKS),
                             special_tokens={})


@pytest.mark.parametrize("segment", [13, 64, 1 << 18])
def test_scan_equals_library(library, segment):
    codec = scan_bpe.ScanCodec(RANKS, segment=segment, entries=40)
    random.seed(segment)
    for _ in range(6):
        texts = ["".join(random.choices(SIGNS, k=random.choice([0, 1, 2, 5, 60, 300]))) for _ in range(15)] + [
            t or "" for t in ODD]
        block = codec.encode(texts)
        for text, a, b in zip(texts, block.bounds, block.bounds[1:]):
            ids = block.ids[a:b].tolist()
            assert ids == library.encode_ordinary(text)
            raw, starts = text.encode(), [*block.starts[a:b].tolist(), len(text.encode())]
            assert [raw[i:j] for i, j in itertools.pairwise(starts)] == [codec.bytes_of[i] for i in ids]
            assert codec.decode(ids) == raw


def test_all_pairs_of_signs_equal_library(library):
    codec = scan_bpe.ScanCodec(RANKS)
    texts = ["".join(t) for n in (1, 2, 3) for t in itertools.product(SIGNS[:22], repeat=n)]
    block = codec.encode(texts)
    for text, a, b in zip(texts, block.bounds, block.bounds[1:]):
        assert block.ids[a:b].tolist() == library.encode_ordinary(text)


def test_both_merges_agree():
    codec = scan_bpe.ScanCodec(RANKS)
    random.seed(3)
    for _ in range(300):
        piece = "".join(random.choices("abeinrst", k=random.randint(2, 40))).encode()
        if piece not in codec.ranks:
            assert scan_bpe.merge(piece, codec.ranks) == scan_bpe.merge_long(piece, codec.ranks)


def test_another_pattern_is_refused():
    with pytest.raises(ValueError):
        scan_bpe.ScanCodec(RANKS, r"\S+")


def test_encoded_documents(spark, library):
    docs = schema_rows(spark, ODD)
    want = []
    for row in docs.collect():
        ids = library.encode_ordinary(row.text or "")
        want.append((row.doc_id, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256(library.decode_bytes(ids)).hexdigest()))
    assert sorted(map(tuple, scan_bpe.digest_documents(docs, RANKS).collect()), key=str) == sorted(want, key=str)
    tokens = scan_bpe.encode_documents(docs, RANKS)
    decoded = scan_bpe.decode_documents(tokens, RANKS).collect()
    assert sorted(((r.doc_id, bytes(r.decoded).decode()) for r in decoded), key=str) == sorted(
        ((r.doc_id, r.text or "") for r in docs.collect()), key=str)
    assert scan_bpe.digest_documents(docs.limit(0), RANKS).count() == 0


# --- 13 ------------------------------------------------------------------------

def features(text, longest):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
    found = [" ".join(words[i:i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]
    return words, [zlib.crc32(f.encode()) % 10_000 for f in found]


def resampled(docs, target, longest):
    corpus, aim = Counter(), Counter()
    for text in target:
        aim.update(features(text, longest)[1])
    for _, text in docs:
        corpus.update(features(text, longest)[1])
    all_corpus, all_aim = corpus.total(), aim.total()
    gain = lambda b: math.floor(1000 * math.log((aim[b] + 1) * (all_corpus + 10_000)
                                                / ((corpus[b] + 1) * (all_aim + 10_000))))
    rows, eligible = [], []
    for doc_id, text in docs:
        words, own = features(text, longest)
        weight = sum(map(gain, own))
        h = int(hashlib.sha256(f"2024:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        row = [doc_id, len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None]
        rows.append(row)
        if len(words) >= 20:
            eligible.append(row)
    eligible.sort(key=lambda r: (-r[3], -1 if r[0] is None else r[0]))
    for rank, row in enumerate(eligible[:10 * len(eligible) // 100], 1):
        row[4] = rank
    return rows


@pytest.mark.parametrize("longest", [1, 2])
def test_resampling_equals_brute_force(spark, longest):
    random.seed(longest)
    texts = [" ".join(random.choices(["Alpha", "beta,", "gämma", "x1", "-", "漢字", "Delta."], k=random.randint(0, 60)))
             for _ in range(300)] + ["a " * 20_000, "", None, " . "]
    rows = [(i, t, 0.5) for i, t in enumerate(texts)] + [(7, texts[7], 0.5), (None, texts[9], 0.5)] + [
        (1000 + i % 5, "the same words " * 12, 0.5) for i in range(90)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score double").repartition(7)
    target = [(1, "Alpha beta x1"), (2, None), (3, "漢字 alpha")]
    got = sampling.resample(docs, spark.createDataFrame(target, "item_id long, text string"), longest)
    assert [c for c, _ in got.dtypes] == ["doc_id", "n_features", "weight", "score", "rank"]
    assert {kind for _, kind in got.dtypes} == {"bigint"}
    want = resampled([r[:2] for r in rows], [t for _, t in target], longest)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want), key=str)


def test_features_of_blocks_inside_a_batch():
    import pyarrow as pa

    random.seed(13)
    texts = [" ".join(random.choices(["Alpha", "beta,", "gämma", "X1", "-", "漢字", "Delta."], k=k)) for k in range(1, 60)]
    for rows in (texts, [*texts, None, "", "a B a"]):
        batch = pa.RecordBatch.from_arrays([pa.array(rows)], ["text"])
        want = [[zlib.crc32(w.encode()) % 10_000 for w in re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").lower())]
                for t in rows]
        for most in (1, 500, 100_000):
            found = []
            for block in sampling.text_blocks(batch, 0, most):
                features = sampling.block_features(block.column(0))
                found += [features.buckets[i:j].tolist() for i, j in zip(features.bounds, features.bounds[1:])]
            assert found == want, most


def test_resampling_of_empty_tables(spark):
    nothing = spark.createDataFrame([], "doc_id long, text string")
    docs = spark.createDataFrame([(i, "a b c d " * 6) for i in range(20)], "doc_id long, text string")
    assert sampling.resample(nothing, docs).count() == 0
    assert sampling.resample(docs, nothing).where("rank IS NOT NULL").count() == 2


def test_ranks_run_over_ranges(spark):
    rows = spark.range(5000).selectExpr("id DIV 2 AS doc_id", "pmod(hash(id DIV 3), 40) AS score").repartition(9)
    got = sorted(sampling.ranked(rows).collect(), key=lambda r: r["rank"])
    assert [r["rank"] for r in got] == list(range(1, 5001))
    keys = [(-r.score, r.doc_id) for r in got]
    assert keys == sorted(keys)


# --- 11 ------------------------------------------------------------------------

def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long_ = sorted((a, b), key=len)
    return any(long_[:i] + long_[i + 1:] == short for i in range(len(long_)))


def variants(docs):
    counts = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            counts[run[:h % len(run)] + run[h % len(run) + 1:] if h % 31 == 0 else run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for word, n in words.items():
        best = min(near[word], key=lambda v: (-words[v], v), default=None)
        form[word] = best if best is not None and words[best] >= 10 * n else None
    rows = []
    for word, n in words.items():
        root = word
        while form[root] is not None:
            root = form[root]
        rows.append((word, form[word], root, n, len(near[word]), form[word] and words[form[word]]))
    return rows


@pytest.mark.parametrize("symbols, bits", [(8, 1 << 27), (2, 1 << 15)])
def test_variants_equal_brute_force(spark, symbols, bits):
    random.seed(symbols)
    base = ["".join(random.choices("abcé", k=random.randint(6, 10))) for _ in range(25)] + [
        "aaaaaaaa", "aaaaaaa", "aaaaaaaaa", "x" * 400, "x" * 399, "Straßennamen", "ÉÉéééÿÀ"]

    def varied(word):
        at, kind = random.randrange(len(word)), random.random()
        if kind < 0.6:
            return word
        return word[:at] + random.choice(["", "b", "é", word[at] + "a"]) + word[at + 1:]

    weights = [2 ** random.randint(0, 9) for _ in base]
    texts = [" ".join(varied(w) for w in random.choices(base, weights, k=60)) for _ in range(150)] + [
        "", None, "7 , .", "漢字abcabca ’abcabcb’ Ŀabcabcc", "abcabca " * 3000]
    rows = [(i, t, 1) for i, t in enumerate(texts)] + [(3, texts[3], 1), (None, texts[5], 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n int").repartition(5)
    got = spelling.group_variants(docs, symbols=symbols, bits=bits)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(variants([r[:2] for r in rows]), key=str)


def test_chains_of_forms_reach_their_root(spark):
    word = "abcdefghij"
    chain = [word + "z" * k for k in range(4)]
    text = " ".join(w + " " + (w + " ") * (2 * 11 ** k - 1) for k, w in enumerate(chain))
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    found = {r.word: r for r in spelling.group_variants(docs, changed_of=1 << 40).collect()}
    assert {found[w].root for w in chain} == {chain[-1]}
    assert [found[w].form for w in chain] == [*chain[1:], None]


def test_variants_of_nothing(spark):
    assert spelling.group_variants(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_neighbourhoods_are_whole():
    random.seed(1)
    for symbols in (2, 3):
        for length in (1, 2, 5):
            rows = np.array([[random.randint(1, symbols) for _ in range(length)] for _ in range(6)], np.uint64)
            owners, names = spelling.neighbour_names(rows, symbols, lambda n: np.ones(len(n), bool))
            for i, row in enumerate(rows.tolist()):
                letters = range(1, symbols + 1)
                want = {tuple(row)} | {tuple(row[:p] + row[p + 1:]) for p in range(length)}
                want |= {tuple(row[:p] + [c] + row[p + 1:]) for p in range(length) for c in letters}
                want |= {tuple(row[:p] + [c] + row[p:]) for p in range(length + 1) for c in letters}
                named = {int(spelling.names_of(np.array([w], np.uint64).reshape(1, -1))[0]) for w in want}
                own = names[owners == i].tolist()
                assert len(own) == len(set(own)) and set(own) == named
