"""Operators 1, 3 and 8 against the libraries' plain results and against brute force."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tokenizers

from netvigil.llm import best_fit_packing as packing
from netvigil.llm import sentencepiece_codec as codec
from netvigil.llm import wavelet_ids as wavelet
from netvigil.llm.chunks import ByteLevelEncoder, WordEncoder, load_tokenizer

PIECES = public_tokenizers.path("piece_bpe_32k.model")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")

ODD = ["", None, " ", "\n", "a", "a b", "  a  b\n\tc ", "x \n y", "a\nb\n\nc", "it's we'll DON'T\n'tis", "a▁b ▁ c▁",
       "▁", "Ünïcode ẞ İstanbul Σίσυφος ΑΣ ΑΣ.", "👍🏽 ok 👩‍👩‍👧", " lead", "trail ", "tab\there", "\x1c\x1d a\x1f b",
       "a\r\nb", "é a ́b", "<|endoftext|> hi <s> </s>", "12345 6.7e8 ½ ²", "\n\n\n", "漢字 かな 漢字", "ab\x00c",
       "word " * 5000, "x" * 20_000, "a b c d", "don't.\nStop!! ### a--b", "Öl Straße ÖL, straße."]


@pytest.fixture(scope="module")
def documents(spark):
    """Odd texts twice, a null id, and columns whose names clash with those of the operators."""
    rows = [(i, t, "x", i) for i, t in enumerate(ODD + ODD)] + [(None, "no id", "x", 0), (5, "a", "x", 5)]
    return spark.createDataFrame(rows, "doc_id long, text string, start string, length int")


def library_ids(path):
    tokenizer = load_tokenizer(path)
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


def test_sentencepiece_equals_library(spark, documents):
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    got = codec.encode_documents(documents, PIECES).collect()
    texts = [(r.doc_id, r.text or "") for r in documents.collect()]
    want = []
    for doc_id, text in texts:
        ids = model.encode(text)
        want.append((doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256(model.decode(ids).encode()).hexdigest()))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert codec.encode_documents(documents.limit(0), PIECES).count() == 0


def test_sentencepiece_table_may_start_anew():
    small, large = codec.Codec(PIECES, entries=3), codec.Codec(PIECES)
    rows = [(i, t) for i, t in enumerate(ODD)] * 3
    assert list(codec.encode_blocks(small, rows)) == list(codec.encode_blocks(large, rows))


@pytest.mark.parametrize("kind, path", [(ByteLevelEncoder, BYTES), (WordEncoder, WORDS)])
def test_chunked_ids_equal_library(kind, path):
    plain, encoder, small = library_ids(path), kind(path), kind(path, entries=2)
    for text in ODD:
        want = np.array(plain(text), "<u4").tobytes()
        assert encoder.ids(text) == want, text
        assert small.ids(text) == want, text


@pytest.mark.parametrize("kind, path", [(ByteLevelEncoder, BYTES), (WordEncoder, WORDS)])
def test_chunked_ids_of_random_texts(kind, path):
    plain, encoder, pick = library_ids(path), kind(path), random.Random(7)
    alphabet = "ab Zé.,!'s 1\n\t ñß-漢́​ſǅ"
    for _ in range(1500):
        text = "".join(pick.choice(alphabet) for _ in range(pick.randint(1, 25)))
        assert encoder.ids(text) == np.array(plain(text), "<u4").tobytes(), repr(text)


@pytest.mark.parametrize("kind, path", [(ByteLevelEncoder, BYTES), (WordEncoder, WORDS)])
def test_added_tokens_equal_the_library_as_loaded(kind, path):
    plain, encoder, pick = tokenizers.Tokenizer.from_file(path), kind(path), random.Random(13)
    end = "<|endoftext|>"
    texts = [f"a {end} b", end, end * 3, f" {end} ", f"x{end}y", f"\n{end}\n\n a", f"a  {end}  b", f"{end}'s", "<|ENDOFTEXT|> a",
             f"<|endof{end}text|>", f"<|startoftext|>hi {end}", f"é{end}\u0301", "<|endoftext| >", None, *ODD]
    parts = [end, "<|startoftext|>", "<|end", "oftext|>", " ", "  ", "\n", "word", "É", "\u0301", "7", "'s", "!!", "\t"]
    texts += ["".join(pick.choices(parts, k=pick.randint(1, 12))) for _ in range(1500)]
    for text in texts:
        want = plain.encode(text or "", add_special_tokens=False).ids
        assert encoder.ids(text) == np.array(want, "<u4").tobytes(), repr(text)


def test_added_tokens_with_rules_of_their_own(tmp_path):
    plain = tokenizers.Tokenizer.from_file(WORDS)
    plain.add_tokens([tokenizers.AddedToken("Mark", normalized=True), tokenizers.AddedToken("[x]", lstrip=True, rstrip=True)])
    plain.save(path := str(tmp_path / "own.json"))
    encoder = WordEncoder(path)
    for text in ("a mark b", "a Mark b", "remark", "a [x] b", "a [x]b <|endoftext|> c", *ODD):
        want = plain.encode(text or "", add_special_tokens=False).ids
        assert encoder.ids(text) == np.array(want, "<u4").tobytes(), repr(text)


def best_fit_decreasing(lengths, capacity):
    """Bins by placing one piece after the other."""
    bins = []
    for length in sorted(lengths, reverse=True):
        fitting = [b for b in range(len(bins)) if bins[b] >= length]
        if fitting:
            bins[min(fitting, key=lambda b: bins[b])] -= length
        else:
            bins.append(capacity - length)
    return bins


def test_moves_equal_placing_one_by_one():
    pick = random.Random(3)
    for capacity in (1, 7, 20, 64):
        for _ in range(150):
            lengths = [pick.randint(1, capacity) for _ in range(pick.randint(0, 80))]
            histogram = {n: lengths.count(n) for n in set(lengths)}
            moves, bins = packing.plan_moves(histogram, capacity)
            want = best_fit_decreasing(lengths, capacity)
            assert bins == len(want)
            fill = [0] * bins
            for length in sorted(histogram, reverse=True):
                for rank in range(histogram[length]):
                    move = max((m for m in moves if m.length == length and m.rank <= rank), key=lambda m: m.rank)
                    step = rank - move.rank
                    at = move.bin + step // move.each
                    assert fill[at] == move.offset + step % move.each * length
                    fill[at] += length
            assert sorted(capacity - f for f in fill) == sorted(want)


def test_tightest_capacity():
    tree, pick, open_bins = packing.CapacityTree(50), random.Random(1), []
    for _ in range(300):
        value = pick.randint(0, 50)
        tree.add(value, 1)
        open_bins.append(value)
        if len(open_bins) > 5:
            tree.add(gone := open_bins.pop(pick.randrange(6)), -1)
            assert gone is not None
        for need in range(51):
            assert tree.tightest(need) == min((v for v in open_bins if v >= need), default=None)


def test_packing_of_documents(spark, documents):
    plain = library_ids(WORDS)
    got = packing.pack(documents, WORDS).collect()
    want, lengths = [], []
    for row in documents.collect():
        ids = [*plain(row.text), packing.END_ID]
        for piece, at in enumerate(range(0, len(ids), 4096)):
            own = ids[at:at + 4096]
            lengths.append(len(own))
            want.append((row.doc_id, piece, at, len(own), zlib.crc32(np.array(own, "<u4").tobytes())))
    assert sorted((tuple(r)[:5] for r in got), key=str) == sorted(want, key=str)
    bins = {}
    for r in got:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096
    assert len(bins) == len(best_fit_decreasing(lengths, 4096))
    assert packing.pack(documents.limit(0), WORDS).count() == 0


def test_pieces_are_made_in_blocks_of_texts(spark, documents, monkeypatch):
    """A batch is not held whole as Python strings; ranks within a share go on from block to block."""
    limit, sizes, cut = 400, spark.sparkContext.accumulator(0), packing.text_blocks

    def watched(batch, column, most):
        for part in cut(batch, column, most):
            sizes.add(1)
            yield part

    monkeypatch.setattr(packing, "BLOCK_BYTES", limit)
    monkeypatch.setattr(packing, "text_blocks", watched)
    found = packing.token_pieces(documents.coalesce(1), WORDS, 64, "doc_id", "text").collect()
    assert sizes.value > 5
    places = {}
    for r in found:
        places.setdefault((r.share, r.length), []).append(r.place)
    assert all(sorted(p) == list(range(len(p))) for p in places.values())
    plain = library_ids(WORDS)
    assert sum(r.length for r in found) == sum(len(plain(row.text)) + 1 for row in documents.collect())


def test_wavelet_shard_answers():
    pick = np.random.default_rng(5)
    for size, top in ((0, 1), (1, 1), (700, 2), (3000, 50257), (wavelet.BLOCK_BITS + 99, 300)):
        ids = pick.integers(0, top, size).astype("<u4")
        counts = [size // 3, size - size // 3]
        shard = wavelet.WaveletShard(wavelet.build(ids, [None, -4], counts))
        assert shard.doc_ids == [None, -4] and shard.counts.tolist() == counts
        assert (shard.tokens() == ids).all()
        for at in pick.integers(0, size, 15) if size else []:
            token = int(ids[at])
            assert shard.access(int(at)) == token
            assert shard.rank(token, int(at)) == int((ids[:at] == token).sum())
            assert shard.select(token, shard.rank(token, int(at))) == at
        assert shard.rank(1 << 20) == 0
        with pytest.raises(IndexError):
            shard.select(top, 0)


def test_wavelet_round_trip(spark, documents, tmp_path):
    plain = library_ids(BYTES)
    wavelet.write_ids(documents.repartition(3), str(tmp_path / "a"), BYTES, shard_tokens=700)
    got = wavelet.read_documents(spark, str(tmp_path / "a"), with_ids=True).orderBy("start").collect()
    assert [r.doc_id for r in got] == sorted((r.doc_id for r in documents.collect()), key=lambda d: -1 if d is None else d)
    texts = {}
    for row in documents.collect():
        texts.setdefault(row.doc_id, []).append(np.array([*plain(row.text), 0], "<u4").tobytes())
    start = 0
    for r in got:
        texts[r.doc_id].remove(bytes(r.ids))
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(r.ids) // 4, zlib.crc32(r.ids))
        start += r.n_tokens
    assert not any(texts.values())
    wavelet.write_ids(documents.limit(0), str(tmp_path / "b"), BYTES)
    assert wavelet.read_documents(spark, str(tmp_path / "b")).count() == 0
