"""Word shingles of a text as sorted arrays of 64-bit hashes."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import xxhash

from opinara.llm.common import mixed

#: Texts are hashed in stretches of about so many bytes, so that long ones need no more memory than others.
STRETCH = 1 << 17
#: Words beyond so many bytes are hashed one by one.
LONG_WORD = 1024
GAPS = b" \t\n\x0b\x0c\r"
IS_GAP = np.isin(np.arange(256), list(GAPS))
NEXT_GAP = re.compile(b"[ \t-\r]").search

#: A word's hash is a sum of byte value times place value; white space adds nothing.
BYTE_VALUE = np.where(IS_GAP, np.uint64(0), mixed(np.arange(1, 257, dtype=np.uint64)))
PLACE_VALUE = mixed(np.arange(1001, 1001 + LONG_WORD, dtype=np.uint64)) | np.uint64(1)


class WordHashes(dict):
    """Word -> 64-bit hash, forgotten when it grows too large."""

    LIMIT = 400_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def _stretches(text: bytes) -> Iterator[bytes]:
    """Pieces of the text that end where a word ends; a word longer than a stretch is a piece of its own."""
    at = 0
    while len(text) - at > STRETCH:
        cut = max(text.rfind(g, at, at + STRETCH) for g in (GAPS[i:i + 1] for i in range(len(GAPS))))
        if cut < 0:
            gap = NEXT_GAP(text, at + STRETCH)
            cut = gap.start() if gap else len(text)
        yield text[at:cut]
        at = cut + 1
    yield text[at:]


def _hashed(text: bytes) -> np.ndarray:
    if len(text) > STRETCH:  # one word
        return np.array([xxhash.xxh64_intdigest(text)], np.uint64)
    data = np.frombuffer(text, np.uint8)
    gap = np.ones(len(data) + 2, bool)
    gap[1:-1] = IS_GAP[data]
    edges = np.flatnonzero(gap[1:] != gap[:-1])
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return np.zeros(0, np.uint64)
    place = np.arange(starts[0], len(data)) - np.repeat(starts, np.diff(starts, append=len(data)))
    values = BYTE_VALUE[data[starts[0]:]] * PLACE_VALUE.take(place, mode="clip")
    sizes = ends - starts
    out = mixed(np.add.reduceat(values, starts - starts[0]) + sizes.astype(np.uint64))
    for i in np.flatnonzero(sizes > LONG_WORD):
        out[i] = xxhash.xxh64_intdigest(text[starts[i]:ends[i]])
    return out


def word_hashes(text: bytes) -> np.ndarray:
    """Hashes of the words: maximal runs without ASCII white space, A-Z in lower case."""
    text = text.lower()
    if len(text) <= STRETCH:
        return _hashed(text)
    return np.concatenate([_hashed(piece) for piece in _stretches(text)])


def distinct(values: np.ndarray) -> np.ndarray:
    """Sorted, each value once."""
    values = np.sort(values)
    keep = np.ones(len(values), bool)
    np.not_equal(values[1:], values[:-1], out=keep[1:])
    return values[keep]


def shingle_set(text: bytes, words: int) -> np.ndarray:
    """The distinct shingles of `words` words; a shorter text is one shingle, a text without words has none."""
    hashes = word_hashes(text)
    if not len(hashes):
        return hashes
    width = min(words, len(hashes))
    joint = np.full(len(hashes) - width + 1, width, np.uint64)
    for i in range(width):
        joint ^= hashes[i:len(hashes) - width + 1 + i]
        joint *= np.uint64(0x9E3779B97F4A7C15)
        joint ^= joint >> np.uint64(29)
    return distinct(joint)
