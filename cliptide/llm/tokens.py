"""Exact, cached use of a public word-level BPE tokenizer file.

The vocabulary's pre-tokenizer never joins characters across white space, so a text's ids are its white-space words'
ids in a row. Words repeat, so a bounded cache of words to packed ids replaces most calls of the library.
"""

from __future__ import annotations

import functools
import re
import sys
import unicodedata
from array import array

import regex

VOCABULARY = "word_bpe_49k.json"
CACHE_WORDS = 600_000
#: Fixed value: the tokenizer's own split, as it falls out on lower-cased words below U+0250.
_SPLIT = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\t-\r \x85\xa0\p{L}\p{N}]+")
_LIBRARY_SPACE = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")
_BEYOND = re.compile("[^\x00-\u024f]")
_PYTHON_ONLY = re.compile("[\x1c-\x1f]")


def _byte_letters() -> dict[int, str]:
    """Latin-1 code points to the printable letters that a byte-level vocabulary writes bytes with."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(rest)}


_LETTERS = _byte_letters()


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def _packed(ids: list[int]) -> bytes:
    held = array("I", ids)
    if sys.byteorder == "big":
        held.byteswap()
    return held.tobytes()


class _Words(dict):
    """Word to its ids as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.model = self.tokenizer.model
        self.pieces: dict[str, bytes] = {}

    def _ask(self, piece: str) -> bytes:
        got = self.pieces.get(piece)
        if got is None:
            letters = piece.encode().decode("latin-1").translate(_LETTERS)
            got = _packed([t.id for t in self.model.tokenize(letters)])
            if len(self.pieces) >= CACHE_WORDS:
                self.pieces.clear()
            if len(piece) <= 64:
                self.pieces[piece] = got
        return got

    def __missing__(self, word: str) -> bytes:
        if max(word) < "\u0250":
            lowered = word.lower() if word.isascii() else unicodedata.normalize("NFC", word).lower()
            if lowered.isascii() and lowered.isalpha():
                got = self._ask(lowered)
            elif lowered[-1] in ".," and lowered[:-1].isascii() and lowered[:-1].isalpha():
                got = self._ask(lowered[:-1]) + self._ask(lowered[-1])
            else:
                got = b"".join(map(self._ask, _SPLIT.findall(lowered)))
        else:
            got = _packed(self.tokenizer.encode(word, add_special_tokens=False).ids)
        if len(self) >= CACHE_WORDS:
            self.clear()
        if len(word) <= 64:
            self[word] = got
        return got


@functools.lru_cache(maxsize=2)
def words(path: str) -> _Words:
    return _Words(path)


def packed_ids(text: str | None, path: str) -> bytes:
    """The ids of the whole text, packed; empty for a null or empty text."""
    if not text:
        return b""
    known = words(path)
    if text.isascii():
        text = text.lower()
    elif not _BEYOND.search(text):  # as the library's normalizer does; elsewhere lower case can depend on context
        text = unicodedata.normalize("NFC", text).lower()
    split = _LIBRARY_SPACE.split(text) if _PYTHON_ONLY.search(text) else text.split()
    return b"".join([known[w] for w in split if w])
