"""Token ids of whole texts by a word-level tokenizer, each distinct piece of text encoded once."""

from __future__ import annotations

import functools
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: The ids of so many chunks are kept in a generation.
CHUNKS = 400_000
#: Latin letters, then ASCII punctuation: such a chunk is one word, or one word and one run of signs.
PLAIN = re.compile("([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-/:-@\\[-`{-~]*)").fullmatch
#: The same of every line; others give two empty strings.
LINES = re.compile("(?:([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-/:-@\\[-`{-~]*)|[^\n]+)\n").findall
#: What may stand inside such a chunk.
INSIDE = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]*[!-/:-@\\[-`{-~]*").fullmatch


def byte_alphabet() -> dict[int, str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


SYMBOLS = str.maketrans({chr(b): c for b, c in byte_alphabet().items()})


class ChunkIds:
    """Encode texts (bytes) as the tokenizer of `path` does, without special tokens being added.

    For byte-level tokenizers that put text into lower case, drop white space, treat what stands between independently
    and mark the end of a word in its last token: a text is then the concatenation of its chunks, the maximal runs
    without ASCII white space. A chunk that is a word and a run of signs is put together from both, which are chunks
    of their own; they are encoded by the tokenizer's model alone. The ids of chunks are kept and forgotten in two
    generations, each of up to `limit` chunks or `limit_bytes` bytes and what one group of texts adds.
    """

    def __init__(self, path: str, limit: int = CHUNKS, limit_bytes: int = 32 << 20):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one thread for each Spark task
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.model = Tokenizer(self.tokenizer.model)
        self.limit, self.limit_bytes = limit, limit_bytes
        self.young: dict[bytes, bytes] = {b"": b""}
        self.old: dict[bytes, bytes] = {}
        self.held = 0
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        #: Not used if an added token could stand inside a plain chunk.
        self.plain = not any(map(INSIDE, added))

    def _ids(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _words(self, words: list[bytes]) -> list[bytes]:
        """Ids of words and runs of signs, encoded side by side and cut at the ends of words."""
        symbols = b"\0".join(words).decode("latin-1").translate(SYMBOLS).split(SYMBOLS[0])
        ids = np.array(self.model.encode_batch_fast([symbols], is_pretokenized=True, add_special_tokens=False)[0].ids, "<u4")
        cuts = (4 * (np.flatnonzero(self.ends[ids]) + 1)).tolist()
        if len(cuts) != len(words):
            return self._ids([w.decode() for w in words])
        ids = ids.tobytes()
        return [ids[a:b] for a, b in zip([0, *cuts], cuts)]

    def _learn(self, chunks: set[bytes]) -> None:
        if len(self.young) > self.limit or self.held > self.limit_bytes:
            self.old, self.young, self.held = self.young, {b"": b""}, 0
        young, old = self.young, self.old
        fresh = chunks.difference(young)
        known = old.keys() & fresh
        young.update(zip(known, map(old.__getitem__, known)))
        new = list(fresh - known)
        parts = self._parts(new)
        words = dict.fromkeys(w for own in parts for w in own)
        missing = [w for w in words if w not in young]
        known = [w for w in missing if w in old]
        young.update(zip(known, map(old.__getitem__, known)))
        missing = [w for w in missing if w not in young]
        for at in range(0, len(missing), 500):
            young.update(zip(missing[at:at + 500], self._words(missing[at:at + 500])))
        other = [c for c, word in zip(new, parts[0]) if not word]
        young.update(zip(new, map(bytes.__add__, *(map(young.__getitem__, own) for own in parts))))
        for at in range(0, len(other), 500):
            some = other[at:at + 500]
            young.update(zip(some, self._ids([c.decode("utf-8", "replace") for c in some])))
        self.held += sum(map(len, fresh)) + sum(map(len, map(young.__getitem__, fresh)))
        self.held += sum(map(len, words)) + sum(map(len, map(young.__getitem__, words)))

    def _parts(self, chunks: list[bytes]) -> list[list[bytes]]:
        """The word of each chunk in lower case, and its signs; both empty if it is not plain."""
        found = LINES(b"\n".join([*chunks, b""]).decode("utf-8", "replace")) if self.plain else [("", "")] * len(chunks)
        words, signs = zip(*found) if found else ((), ())
        return ["\n".join(own).encode().split(b"\n")[:len(chunks)] for own in ("\n".join(words).lower().split("\n"), signs)]

    def encode(self, texts: list[bytes], group: int = 200) -> Iterator[np.ndarray]:
        """An array of ids for each text."""
        for at in range(0, len(texts), group):
            split = [t.split() for t in texts[at:at + group]]
            self._learn(set().union(*split))
            of = self.young.__getitem__
            for chunks in split:
                yield np.frombuffer(b"".join(map(of, chunks)), "<u4")


@functools.lru_cache(1)
def chunk_ids(path: str, limit: int = CHUNKS) -> ChunkIds:
    """One for each worker process, with what it has learnt so far."""
    return ChunkIds(path, limit)


def forget() -> None:
    """Drop what this worker process has learnt. Operators that encode nothing call it: workers are used again, and what an earlier
    stage learnt would stay beside theirs."""
    if chunk_ids.cache_info().currsize:
        chunk_ids.cache_clear()
        pa.default_memory_pool().release_unused()
