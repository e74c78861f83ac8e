"""Whole-text encoding with a public tokenizer through a bounded piece cache.

The tokenizer's pre-token pattern lets a space only start a pre-token, never
sit inside or end one that holds other characters. A single space between two
non-space characters is therefore always a pre-token boundary, and so is a
single line feed between them (it is a pre-token of its own). Texts are cut
there, each distinct piece is encoded once by the library, and a text's ids
are the joined bytes of its pieces. Pieces with irregular white space are cut
by a stricter search, so every text gets the ids that encoding it whole gives.
"""

from __future__ import annotations

import os
import re
import sys
from array import array

import numpy as np

TOKENIZER_FILE = "byte_bpe_50k.json"
CACHE_PIECES = 300_000          # entries of each of the two generations of a worker's cache
CACHE_BYTES = 96                # pieces longer than this are not kept
_MARKS = ".,;:!?"
_REGULAR = re.compile(r"(?<=\S) (?=\S)")


class _Odd(Exception):
    """A piece that starts or ends with white space: the quick cut does not hold."""


def _is_word(piece: str) -> bool:
    """Latin letters only: one pre-token, with or without a space before it."""
    return piece.isalpha() and max(piece) < "\u0250"


class _Pieces(dict):
    """Ids of pieces. When full, it becomes the older generation, out of which pieces that recur are taken over."""

    def __init__(self, owner: "PieceEncoder", prefix: str):
        super().__init__()
        self.owner, self.prefix, self.older = owner, prefix, {}

    def __missing__(self, piece: str) -> bytes:
        value = self.older.get(piece)
        if value is None:
            value = self._encode(piece)
        if len(piece) <= CACHE_BYTES:
            if len(self) >= CACHE_PIECES:
                self.older = dict(self)
                self.clear()
            self[piece] = value
        return value

    def _encode(self, piece: str) -> bytes:
        if not piece or piece[0].isspace() or piece[-1].isspace():
            raise _Odd
        if _is_word(piece):
            return self.owner.word(self.prefix + piece)
        if piece[-1] in _MARKS and _is_word(piece[:-1]):
            return self[piece[:-1]] + self.owner.marks[piece[-1]]
        return self.owner.plain(self.prefix + piece)


def tokenizer_path(file: str | None = None) -> str:
    """Path of a public tokenizer file (a bare name is looked up in the package)."""
    file = file or TOKENIZER_FILE
    if os.path.isabs(file):
        return file
    import public_tokenizers
    return str(public_tokenizers.path(file))


def _byte_symbols() -> dict[int, str]:
    """Byte-level alphabet: printable bytes stand for themselves, the rest for 256 upward."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(256 + i) for i, b in enumerate(hidden)}


class PieceEncoder:
    """Encode texts to ids without special tokens, as little-endian bytes of one width."""

    def __init__(self, file: str | None = None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(tokenizer_path(file))
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.dtype = np.dtype("<u2" if self.width == 2 else "<u4")
        self._code = "H" if self.width == 2 else "I"
        self._model = self.tokenizer.model
        self._symbols = _byte_symbols()
        self._spaced = _Pieces(self, " ")
        self._first = _Pieces(self, "")
        self._newline = self.plain("\n")
        self.marks = {m: self.plain(m) for m in _MARKS}

    def word(self, text: str) -> bytes:
        """Ids of one pre-token, straight from the library's merge model."""
        if text.isascii():
            symbols = "\u0120" + text[1:] if text[0] == " " else text
        else:
            symbols = text.encode().decode("latin-1").translate(self._symbols)
        ids = array(self._code, [t.id for t in self._model.tokenize(symbols)])
        if sys.byteorder == "big":
            ids.byteswap()
        return ids.tobytes()

    def plain(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return np.array(ids, self.dtype).tobytes()

    def _line(self, line: str) -> bytes:
        pieces = line.split(" ")
        head = self._first[pieces[0]]
        return head + b"".join(map(self._spaced.__getitem__, pieces[1:])) if len(pieces) > 1 else head

    def encode(self, text: str | None) -> bytes:
        """Ids of a whole text (null or empty: none) as little-endian bytes."""
        if not text:
            return b""
        try:
            return self._newline.join([self._line(x) for x in text.split("\n")])
        except _Odd:
            pass
        pieces = _REGULAR.split(text)
        out = [self.plain(pieces[0])]
        for piece in pieces[1:]:
            try:
                out.append(self._spaced[piece])
            except _Odd:
                out.append(self.plain(" " + piece))
        return b"".join(out)

    def ids(self, text: str | None) -> np.ndarray:
        return np.frombuffer(self.encode(text), self.dtype)


_ENCODERS: dict[str | None, PieceEncoder] = {}


def encoder(file: str | None = None) -> PieceEncoder:
    """The worker's encoder for a tokenizer file (one per Python worker)."""
    if file not in _ENCODERS:
        _ENCODERS[file] = PieceEncoder(file)
    return _ENCODERS[file]
