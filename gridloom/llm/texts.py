"""Helpers for Python stages: words and their values, over whole texts in blocks."""

from __future__ import annotations

import re
import struct
from collections.abc import Callable, Iterator

import numpy as np
import xxhash

BLOCK_CHARS = 1 << 20  # long texts are split here, at white space, to bound memory
KEPT_WORDS = 1 << 19  # words remembered by a worker before it starts anew
LONG_WORD = 64  # longer words are not remembered

_WORD = re.compile(r"[^ \t\n\r]+")
_SPACE = re.compile(r"[ \t\n\r]")
# what str.split() parts at besides
_ODD_SPACE = re.compile(
    "[\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
)


class Remembered(dict):
    """Bytes worked out once for each word. Words are remembered in two lots: when
    the younger one is full, it becomes the older, whose words are forgotten
    unless they were met again meanwhile."""

    def __init__(self, work: Callable[[object], bytes], kept: int = KEPT_WORDS):
        super().__init__()
        self.work, self.kept, self.older = work, kept, {}

    def __missing__(self, word):
        value = self.older.get(word)
        if value is None:
            value = self.work(word)
        if len(word) <= LONG_WORD:
            if len(self) >= self.kept:
                self._age()
            self[word] = value
        return value

    def _age(self):
        self.older = None  # given up before the copy: two lots at once, not three
        self.older = dict(self)
        self.clear()

    def lacking(self, words: list) -> list:
        """Those of the words, each once, that would be worked out and remembered now."""
        return [w for w in set(words).difference(self)
                if w not in self.older and len(w) <= LONG_WORD]

    def learn(self, words: list, values: list[bytes]) -> None:
        """Remember what has been worked out for many words at once."""
        for word, value in zip(words, values, strict=True):
            if len(self) >= self.kept:
                self._age()
            self[word] = value

    def joined(self, words: list) -> bytes:
        return b"".join(map(self.__getitem__, words))


def blocks(text: str, size: int = BLOCK_CHARS) -> Iterator[str]:
    """The text in pieces of about ``size`` characters, cut at white space only."""
    at = 0
    while len(text) - at > size:
        cut = _SPACE.search(text, at + size)
        end = cut.start() if cut else len(text)
        yield text[at:end]
        at = end
    yield text[at:] if at else text


def space_words(text: str) -> list[str]:
    """Runs without space, tab or line end; other white space stays in them."""
    return _WORD.findall(text) if _ODD_SPACE.search(text) else text.split()


def _hash_bytes(word: bytes) -> bytes:
    return struct.pack("<Q", xxhash.xxh3_64_intdigest(word))


class WordHashes:
    """64-bit hashes of the words ``[^\\x20\\x09-\\x0D]+`` of texts."""

    def __init__(self, lower: bool):
        self.lower = lower
        self.known = Remembered(_hash_bytes, KEPT_WORDS // 2)  # quickly worked out again

    def __call__(self, text: str | None) -> np.ndarray:
        # bytes.split() parts at exactly these six bytes and bytes.lower() folds A-Z
        if not text:
            return np.empty(0, np.uint64)
        raw = text.encode("utf-8", "surrogatepass")
        return np.frombuffer(self.known.joined((raw.lower() if self.lower else raw).split()), "<u8")


_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_GOLD = 0x9E3779B97F4A7C15


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def windows(h: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of ``n`` consecutive values; none when there are fewer."""
    if len(h) < n:
        return np.empty(0, np.uint64)
    total = np.zeros(len(h) - n + 1, np.uint64)
    for k in range(n):
        total = mixed(total * np.uint64(3) + h[k : len(h) - n + 1 + k] + np.uint64(_GOLD))
    return total
