"""Byte-level BPE ids of whole texts, fast: the ids of each distinct piece
are computed once per process and kept.

The result equals ``tokenizers.Tokenizer.from_file(path).encode(text,
add_special_tokens=False).ids``.  Texts are cut into the same pieces as by
that tokenizer's pre-tokenizer; merges never cross a piece, so a piece's ids
do not depend on its surroundings.
"""

from __future__ import annotations

import itertools
import json
import re
from array import array
from collections.abc import Iterator

import numpy as np

# The pre-tokenizer's pattern, and the same for texts that hold
# only ASCII and the Latin letters below, where the standard module suffices.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
LATIN = r"A-Za-zÀ-ÖØ-öø-ɏ"
PLAIN = rf" ?[{LATIN}]+|'s|'t|'re|'ve|'m|'ll|'d| ?[0-9]+| ?[^\s0-9{LATIN}]+|\s+(?!\S)|\s+"
UNUSUAL = rf"[^\t-\r -~{LATIN}]"

# Pieces kept per process in each of two generations, and the longest one that
# is kept: at most about 160 MB, whatever the corpus.
KEPT, KEPT_LENGTH = 400_000, 40
# Texts above so many characters are encoded by slices of so many pieces.
LONG, SLICE = 1_000_000, 100_000


def byte_symbols() -> dict[str, int]:
    """Byte-level alphabet: printable Latin-1 bytes stand for themselves, the
    others for the code points from 256 on, in order."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Encoder(dict):
    """``encoder.ids(text)``: uint16/uint32 ids as a numpy array."""

    def __init__(self, path: str):
        import regex
        import tiktoken
        from tokenizers import Tokenizer
        super().__init__()
        self.path = path
        self.reference = Tokenizer.from_file(path)
        spec = json.load(open(path, encoding="utf-8"))
        self.added = [t["content"] for t in spec.get("added_tokens", [])]
        symbols = byte_symbols()
        ranks = {bytes(symbols[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in self.added}
        #: bytes of each id; an added token counts the bytes of its string
        self.bytes_of = {i: t for t, i in ranks.items()}
        self.bytes_of |= {t["id"]: t["content"].encode() for t in spec.get("added_tokens", [])}
        self.size = max(self.bytes_of) + 1
        self.code = "H" if self.size <= 1 << 16 else "I"
        self.dtype = np.dtype(self.code)
        self.older: dict[str, bytes] = {}
        self.bpe = tiktoken.Encoding("byte-bpe", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.plain, self.full = re.compile(PLAIN), regex.compile(PATTERN)
        self.unusual = re.compile(UNUSUAL)

    def __missing__(self, piece: str) -> bytes:
        ids = self.older.get(piece)
        if ids is None:
            ids = array(self.code, self.bpe.encode_ordinary(piece)).tobytes()
        if len(piece) <= KEPT_LENGTH:
            if len(self) >= KEPT:
                self.older = dict(self)
                self.clear()
            self[piece] = ids
        return ids

    def ids(self, text: str) -> np.ndarray:
        if any(a in text for a in self.added):
            return np.array(self.reference.encode(text, add_special_tokens=False).ids, dtype=self.dtype)
        pattern = self.full if self.unusual.search(text) else self.plain
        if len(text) <= LONG:
            return np.frombuffer(b"".join(map(self.__getitem__, pattern.findall(text))), dtype=self.dtype)
        return np.concatenate(list(self._slices(pattern, text)))

    def _slices(self, pattern, text: str) -> Iterator[np.ndarray]:
        """A very long text, without a list of all its pieces."""
        found = (m[0] for m in pattern.finditer(text))
        while part := list(itertools.islice(found, SLICE)):
            yield np.frombuffer(b"".join(map(self.__getitem__, part)), dtype=self.dtype)

    def byte_lengths(self) -> np.ndarray:
        """Bytes of each id's text."""
        out = np.zeros(self.size, np.int64)
        for i, b in self.bytes_of.items():
            out[i] = len(b)
        return out


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The process's encoder of a vocabulary file."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]
