"""Token ids of many texts with a word-level BPE file of the ``tokenizers`` library.

Pieces between spaces and line feeds are tokenised independently of their neighbours, so their ids are
kept in a bounded cache. A new piece of printable ASCII and Latin-1 letters goes to the BPE model
directly; any other one passes through the library's whole normaliser.
"""

from __future__ import annotations

import re

import numpy as np
from tokenizers import Tokenizer

# Entries of the two caches, about 200 bytes each: pieces as they stand, and the lower-case words in them.
CACHE_PIECES = 250_000
CACHE_PARTS = 250_000

_LETTERS = "a-zß-öø-ÿ"
_PLAIN = re.compile(r"[!-~À-ÖØ-öø-ÿ]*")
# How the file's pre-tokenizer cuts lower-case text of these characters.
_PARTS = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[0-9]|[^{_LETTERS}0-9]+")


def byte_alphabet() -> list[str]:
    """The printable character that byte-level BPE writes for each byte."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    return [chr(b) if b in printable else chr(256 + others.index(b)) for b in range(256)]


class _Cache(dict):
    """Keeps what ``make`` returns for a key; emptied when it holds ``most`` of them."""

    def __init__(self, make, most: int) -> None:
        super().__init__()
        self.make, self.most = make, most

    def __missing__(self, key: str) -> bytes:
        if len(self) >= self.most:
            self.clear()
        found = self[key] = self.make(key)
        return found


class PieceTokenizer:
    """``encode`` gives a text's ids as little-endian unsigned 32-bit numbers, equal to the library's own."""

    def __init__(self, path: str) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.alphabet = byte_alphabet()
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.parts = _Cache(self._part, CACHE_PARTS)
        self.pieces = _Cache(self._piece, CACHE_PIECES)

    def _part(self, part: str) -> bytes:
        symbols = part if part.isascii() else "".join(self.alphabet[b] for b in part.encode())
        return np.array([t.id for t in self.model.tokenize(symbols)], dtype="<u4").tobytes()

    def _piece(self, piece: str) -> bytes:
        if _PLAIN.fullmatch(piece) and not any(s in piece for s in self.special):
            return b"".join(map(self.parts.__getitem__, _PARTS.findall(piece.lower())))
        return np.array(self.tokenizer.encode(piece, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        return b"".join(map(self.pieces.__getitem__, text.replace("\n", " ").split(" ")))


_LOADED: dict[str, PieceTokenizer] = {}


def tokenizer(path: str) -> PieceTokenizer:
    """One tokenizer per file and worker process."""
    if path not in _LOADED:
        _LOADED[path] = PieceTokenizer(path)
    return _LOADED[path]
