"""Distinct-chunk tables: each distinct piece of text between spaces is tokenised once per Python worker.

A tokeniser whose tokens never cross the start of a word gives the same ids for
a text as for its chunks one after the other. Texts are cut into chunks, the
distinct ones are looked up (or tokenised) in a table, and the ids are joined
back by position.
"""

from __future__ import annotations

import re
import struct
import sys
import types

# Entries of one generation of a table. Beyond it the generation before is dropped: results stay the same, memory
# stays bounded, and what is in use stays known.
TABLE_ENTRIES = 600_000
# Longer chunks (junk without white space) are tokenised without being kept.
KEPT_CHARS = 64


class ChunkTable(dict):
    """Maps a chunk to what ``encode`` gives for it; used as ``table[chunk]``."""

    def __init__(self, encode, entries: int = TABLE_ENTRIES):
        super().__init__()
        self.encode = encode
        self.entries = entries
        self.older: dict = {}

    def __missing__(self, chunk):
        value = self.older.get(chunk)
        if value is None:
            value = self.encode(chunk)
            if len(chunk) > KEPT_CHARS:
                return value
        if len(self) >= self.entries:
            self.older = dict(self)
            self.clear()
        self[chunk] = value
        return value


def for_this_worker(name: str, make):
    """What ``make`` gave when it was first called under this name in this Python worker, which serves many tasks."""
    store = sys.modules.setdefault("netvigil_worker_store", types.ModuleType("netvigil_worker_store")).__dict__
    if name not in store:
        store[name] = make()
    return store[name]


def load_tokenizer(path: str):
    """A ``tokenizers`` file as the library loads it: the string of an added token has that token's id."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


class IdEncoder:
    """Ids of whole texts as bytes, four per id (unsigned, little-endian).

    A text is cut at the strings of added tokens, each of which is its own id, as
    the library does; if a vocabulary has added tokens with rules of their own
    (normalised, stripping or single words), its texts go whole through the library.

    A chunk made of Latin letters, digits and plain marks splits into runs of
    one kind, which go straight to the vocabulary's model; all other chunks go
    through the library's whole path.
    """

    def __init__(self, path: str, entries: int = TABLE_ENTRIES):
        self.tokenizer = load_tokenizer(path)
        self.model = self.tokenizer.model
        added = self.tokenizer.get_added_tokens_decoder()
        self.own_rules = any(t.normalized or t.single_word or t.lstrip or t.rstrip for t in added.values())
        self.added = {t.content: struct.pack("<I", i) for i, t in added.items()}
        longest = sorted(self.added, key=len, reverse=True)  # of those that start at one place the library takes the longest
        self.added_cut = re.compile(f"({'|'.join(map(re.escape, longest))})") if longest else None
        visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = iter(range(256, 512))  # byte-level vocabularies name each byte by a visible letter
        self.byte_names = "".join(chr(b if b in visible else next(hidden)) for b in range(256))
        self.id_bytes = [struct.pack("<I", i) for i in range(self.tokenizer.get_vocab_size())]
        self.runs = ChunkTable(self._run, entries)
        self.table = ChunkTable(self._chunk, entries)

    def _run(self, run: str) -> bytes:
        if run.isascii() and run[0] >= " ":
            named = "Ġ" + run[1:] if run[0] == " " else run  # only the first can be a space
        else:
            named = run.encode().decode("latin-1").translate(self.byte_names)
        id_bytes = self.id_bytes
        return b"".join([id_bytes[token.id] for token in self.model.tokenize(named)])

    def _whole(self, text: str) -> bytes:
        id_bytes = self.id_bytes
        return b"".join([id_bytes[i] for i in self.tokenizer.encode(text, add_special_tokens=False).ids])

    def _chunk(self, chunk: str) -> bytes:
        raise NotImplementedError

    def _between(self, text: str) -> bytes:
        """Ids of a text, not empty, without any string of an added token."""
        raise NotImplementedError

    def ids(self, text: str | None) -> bytes:
        if not text:
            return b""
        if self.own_rules:
            return self._whole(text)
        if self.added_cut is None or not self.added_cut.search(text):
            return self._between(text)
        return b"".join([self.added[part] if i % 2 else self._between(part)  # cuts and texts take turns
                         for i, part in enumerate(self.added_cut.split(text)) if part])


class ByteLevelEncoder(IdEncoder):
    """Vocabularies in which the space belongs to the word after it.

    A cut is made before every single space or line end that stands between two
    characters that are not white space: the library's pattern always starts a
    token there, and what stands before it has no influence.
    """

    # Python counts four control characters more as white space, which only makes fewer cuts.
    _other_space = re.compile(r"[^\S \n]")
    _cut = re.compile(r"(?<=\S) (?=\S)")
    _plain = re.compile(r"[A-Za-zÀ-ÖØ-öø-ÿ0-9.,;:!?*#%&$|()/=+_@-]+")
    _run_of = re.compile(r"[A-Za-zÀ-ÖØ-öø-ÿ]+|[0-9]+|[^A-Za-zÀ-ÖØ-öø-ÿ0-9]+")

    def _chunk(self, chunk: str) -> bytes:
        if chunk.isascii() and chunk.isalpha():
            return self._run(" " + chunk)
        runs = self.runs
        if chunk[0] == "\n":
            if self._plain.fullmatch(chunk, 1):
                return runs["\n"] + b"".join([runs[run] for run in self._run_of.findall(chunk, 1)])
            return self._whole(chunk)
        if not self._plain.fullmatch(chunk):
            return self._whole(" " + chunk)
        first, *more = self._run_of.findall(chunk)
        if not more:
            return self._run(" " + chunk)
        return self.table[first] + b"".join([runs[run] for run in more])

    def _single_spaced(self, text: str) -> bool:
        return not (text[0].isspace() or text[-1].isspace() or "  " in text or " \n" in text or "\n " in text
                    or "\n\n" in text or self._other_space.search(text))

    def _between(self, text: str) -> bytes:
        table = self.table
        if self._single_spaced(text):
            first, *rest = text.replace("\n", " \n").split(" ")
            return self._whole(first) + b"".join([table[chunk] for chunk in rest])
        first, *rest = self._cut.split(text)
        return self._whole(first) + b"".join([self._whole(" " + c) if c[0] == "\n" else table[c] for c in rest])


class WordEncoder(IdEncoder):
    """Lower-casing vocabularies that drop white space: any space or line end is a cut."""

    _plain = re.compile(r"[a-zà-öø-ÿ0-9.,;:!?*#%&$|()/=+_@-]+")
    _run_of = re.compile(r"[a-zà-öø-ÿ]+|[0-9]|[^a-zà-öø-ÿ0-9]+")

    def _chunk(self, chunk: str) -> bytes:
        lower = chunk.lower()
        if lower == chunk and chunk.isascii() and chunk.isalpha():
            return self._run(chunk)
        if not self._plain.fullmatch(lower):
            return self._whole(chunk)
        runs = self._run_of.findall(lower)
        if len(runs) == 1 and lower == chunk:
            return self._run(lower)
        return b"".join([self.table[run] for run in runs])

    def _between(self, text: str) -> bytes:
        table = self.table
        return b"".join([table[chunk] for chunk in text.replace("\n", " ").split(" ") if chunk])
