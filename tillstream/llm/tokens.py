"""Token ids of whole texts by the ``tokenizers`` library, memoised per chunk.

A tokenizer whose pre-tokenizer never joins two sides of ASCII white space
gives a text the concatenation of the ids of its white-space-separated chunks.
:class:`ChunkEncoder` asks the library once per distinct chunk and keeps the
ids in a bounded two-generation memo, so repeated words cost a dictionary
look-up.  A chunk of Latin letters with trailing punctuation is two pieces to
the pre-tokenizer, lower-cased, so its two parts are memoised on their own and
go straight to the library's BPE model; every other chunk goes through the
whole library pipeline.
"""

from __future__ import annotations

import gc
import hashlib
import re
import struct
from contextlib import contextmanager
from functools import lru_cache

import public_tokenizers

DEFAULT_VOCABULARY = "word_bpe_49k.json"
_PLAIN = re.compile("([A-Za-zÀ-ÖØ-öø-ÿ]*)([!\"#$%&()*+,\\-./:;=?@\\[\\\\\\]^_`{}~]*)")


class _Memo(dict):
    """A dictionary that keeps at most two generations of ``limit`` entries."""

    def __init__(self, limit: int):
        super().__init__()
        self.limit, self.older = limit, {}

    def turn(self) -> None:
        if len(self) > self.limit:
            self.older = dict(self)
            self.clear()


class ChunkEncoder(_Memo):
    """chunk bytes -> little-endian uint32 ids; a miss asks the library."""

    def __init__(self, path: str, memo: int = 150_000):
        super().__init__(memo)
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = self.tokenizer.model
        self.parts = _Memo(memo)
        # How the library's byte-level step writes a Latin-1 letter.
        split = self.tokenizer.pre_tokenizer.pre_tokenize_str
        self.letters = {c: split(chr(c))[0][0] for c in range(0xDF, 0x100) if chr(c).isalpha()}

    def _whole(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def _part(self, piece: str) -> bytes:
        got = self.parts.get(piece)
        if got is None:
            got = self.parts.older.get(piece)
            if got is None:
                ids = [t.id for t in self.model.tokenize(piece.translate(self.letters))]
                got = struct.pack(f"<{len(ids)}I", *ids)
            self.parts[piece] = got
        return got

    def __missing__(self, chunk: bytes) -> bytes:
        got = self.older.get(chunk)
        if got is None:
            text = chunk.decode("utf-8", "replace")
            plain = _PLAIN.fullmatch(text) if len(text) <= 64 else None
            if plain:
                word, marks = plain.groups()
                got = self._part(word.lower()) if word else b""
                if marks:
                    got = got + self._part(marks) if got else self._part(marks)
            else:
                got = self._whole(text)
        if len(chunk) <= 64:
            self[chunk] = got
        return got

    def ids(self, text: bytes) -> bytes:
        """Ids of one whole text, 4 bytes each."""
        out = b"".join(map(self.__getitem__, text.split()))
        self.turn()
        self.parts.turn()
        return out


@lru_cache(maxsize=2)
def encoder(vocabulary: str) -> ChunkEncoder:
    """One encoder per worker process.  ``vocabulary`` is a file name of the
    installed tokenizer set, or a path."""
    return ChunkEncoder(vocabulary_path(vocabulary))


@contextmanager
def without_cycles():
    """No cycle collection while a batch is encoded: the library's token objects
    form no cycles, and each collection would walk the memo."""
    gc.disable()
    try:
        yield
    finally:
        gc.enable()


def vocabulary_path(vocabulary: str) -> str:
    return vocabulary if "/" in vocabulary else str(public_tokenizers.path(vocabulary))


def tokenizer_version(vocabulary: str) -> str:
    """Digest of the tokenizer file and of the library's version: stored counts
    are only valid for the same pair."""
    import tokenizers
    h = hashlib.sha256(tokenizers.__version__.encode())
    with open(vocabulary_path(vocabulary), "rb") as f:
        h.update(f.read())
    return h.hexdigest()[:32]
