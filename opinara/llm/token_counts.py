"""How many tokens every prefix of a text has.

A table over the positions of a word holds, for each prefix, the last token of its encoding and the number of
tokens. The encoding of a prefix ends in the one token that is its suffix and may follow the last token of what
stands before: two tokens may stand side by side if encoding their joined text gives them back. So one pass over
a word answers for all its prefixes. A prefix taken as a text of its own ends in a token that closes the word.

Counts of a text are sums over its words. They are kept as differences per byte, one byte each, from which
truncation and budget questions are answered without encoding anything again.
"""

from __future__ import annotations

import functools
import json
import unicodedata
import zlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from opinara.llm.common import batches, texts_of
from opinara.llm.token_ids import PLAIN, SYMBOLS

# The tokenizer's word pattern.
CONTRACTIONS = ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d")
WORDS = regex.compile("|".join(CONTRACTIONS) + r"|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
END = "</w>"


class PrefixTable:
    """Token counts of all prefixes of words, for a vocabulary with merges and word ends."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        self.vocab: dict[str, int] = model["vocab"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.rank = {pair: i for i, pair in enumerate(merges)}
        self.parts = {a + b: (a, b) for a, b in merges}
        self.longest = max(len(t.removesuffix(END)) for t in self.vocab)
        self.follows: dict[tuple[str, str], bool] = {}
        self.edges: dict[tuple[str, int], list] = {}
        #: Text of a token -> whether it is a token inside a word, and one that closes a word.
        self.kinds: dict[str, list[bool]] = {}
        for token in filter(self._is_whole, self.vocab):
            self.kinds.setdefault(token.removesuffix(END), [False, False])[token.endswith(END)] = True
        #: Finds the tokens that end at each place of a word, longest first: size, token inside a word, token that closes it.
        self.endings = ahocorasick.Automaton()
        for text, (inside, closing) in self.kinds.items():
            self.endings.add_word(text, (len(text), text if inside else "", text + END if closing else ""))
        self.endings.make_automaton()

    def _edge(self, token: str, side: int) -> list[tuple[str, int]]:
        """What stands at the left (0) or right (1) end of `token` while it is built: parts and the rank that ends each."""
        if (token, side) not in self.edges:
            out, ends = [], len(self.rank)
            part = token
            while True:
                out.append((part, ends))
                if part not in self.parts:
                    break
                ends = self.rank[self.parts[part]]
                part = self.parts[part][side]
            self.edges[token, side] = out
        return self.edges[token, side]

    def may_follow(self, left: str, right: str) -> bool:
        """Whether no merge crosses the border of the two tokens before both are complete; ties go to the left."""
        key = (left, right)
        known = self.follows.get(key)
        if known is None:
            if len(self.follows) > 300_000:
                self.follows.clear()
            known = self.follows[key] = not any(
                (r := self.rank.get((x, y))) is not None and r < x_ends and r <= y_ends
                for x, x_ends in self._edge(left, 1) for y, y_ends in self._edge(right, 0))
        return known

    def _is_whole(self, token: str) -> bool:
        """Whether the text of a token is encoded as this token."""
        symbols = list(token.removesuffix(END))
        if token.endswith(END):
            symbols[-1] += END
        while len(symbols) > 1:
            rank, at = min((self.rank.get(p, len(self.rank)), i) for i, p in enumerate(zip(symbols, symbols[1:])))
            if rank == len(self.rank):
                return False
            symbols[at:at + 2] = [symbols[at] + symbols[at + 1]]
        return True

    def words(self, words: list[bytes]) -> Iterator[tuple[bytes, list[int]]]:
        """For each word, in sorted order: token counts of its first 1, 2, ... bytes, each as a word of its own.

        A word takes over the table of the one before as far as both begin alike.
        """
        known, may_follow, longest, endings = self.follows.get, self.may_follow, self.longest, self.endings.iter
        before, last, inner, closed = "", [""], [0], []
        for word in sorted(words):
            s = word.decode("latin-1").translate(SYMBOLS)
            same = 0
            for x, y in zip(s, before):
                if x != y:
                    break
                same += 1
            before, size = s, len(s)
            last[same + 1:], inner[same + 1:], closed[same:] = [""] * (size - same), [0] * (size - same), [0] * (size - same)
            for at, (width, token, close) in endings(s, max(0, same + 1 - longest)):
                if at < same:
                    continue
                j = at + 1 - width
                if token and not inner[at + 1]:
                    if not j or ((ok := known((last[j], token))) is None and may_follow(last[j], token)) or ok:
                        last[at + 1], inner[at + 1] = token, inner[j] + 1
                if close and not closed[at]:
                    if not j or ((ok := known((last[j], close))) is None and may_follow(last[j], close)) or ok:
                        closed[at] = inner[j] + 1
            yield word, closed


class PrefixCounts:
    """Differences of token counts per byte of a text."""

    def __init__(self, path: str, limit: int = 350_000, limit_bytes: int = 32 << 20):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.table = PrefixTable(path)
        self.limit, self.limit_bytes = limit, limit_bytes
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}
        self.held = 0

    def _learn(self, chunks: set[bytes]) -> None:
        """Chunks are runs without ASCII white space; their differences are kept in two generations, each of up to
        `limit` chunks or `limit_bytes` bytes and what one group of texts adds. Words are chunks of their own."""
        if len(self.young) > self.limit or self.held > self.limit_bytes:
            self.old, self.young, self.held = self.young, {}, 0
        split: dict[bytes, list[str]] = {}
        fresh = chunks.difference(self.young)
        for chunk in fresh:
            if chunk in self.old:
                self.young[chunk] = self.old[chunk]
                continue
            text = chunk.decode("utf-8", "replace")
            if m := PLAIN(text):
                split[chunk] = [m[1].lower(), m[2]] if m[2] else [m[1].lower()]
            elif "<|" not in text and unicodedata.is_normalized("NFC", text) and self._same_sizes(text) \
                    and not any(c.isspace() for c in text):
                split[chunk] = WORDS.findall("".join(c.lower() for c in text))
            else:
                self.young[chunk] = self._by_encoding(text)
        steps: dict[str, bytes] = {}
        missing = []
        for w in {w for own in split.values() for w in own}:
            word = w.encode()
            known = self.young.get(word) or self.old.get(word)
            if known is None:
                missing.append(word)
            else:
                steps[w] = known
        for word, counts in self.table.words(missing):
            w = word.decode()
            steps[w] = self.young[word] = _differences(word, self._cut_short(w, counts))
        for chunk, own in split.items():
            self.young[chunk] = b"".join([steps[w] for w in own])
        self.held += 2 * (sum(map(len, fresh)) + sum(map(len, missing)))

    def _cut_short(self, word: str, counts: list[int]) -> list[int]:
        """A contraction of three signs that is cut after the second is two words: a sign and a letter."""
        if word not in CONTRACTIONS:
            return counts
        ends = [self.tokenizer.encode(word[:i + 1], add_special_tokens=False).ids for i in range(len(word))]
        return [len(ids) for ids in ends]

    @staticmethod
    def _same_sizes(text: str) -> bool:
        return text.isascii() or all(len(c.lower().encode()) == len(c.encode()) for c in text)

    def _by_encoding(self, text: str) -> bytes:
        """Where normalising changes a chunk or it has special tokens: every prefix is encoded by the library."""
        counts = []
        for at in range(0, len(text), 256):
            prefixes = [text[:i + 1] for i in range(at, min(at + 256, len(text)))]
            for p, e in zip(prefixes, self.tokenizer.encode_batch_fast(prefixes, add_special_tokens=False)):
                counts += [len(e.ids)] * len(p[-1].encode())
        return _differences(text.encode(), counts)

    def texts(self, texts: list[bytes], group: int = 400) -> Iterator[np.ndarray]:
        """Differences per byte of each whole text."""
        for at in range(0, len(texts), group):
            some = texts[at:at + group]
            split = [t.split() for t in some]
            self._learn(set().union(*split))
            for text, chunks in zip(some, split):
                data = np.frombuffer(text, np.uint8)
                out = np.zeros(len(data), np.int8)
                out[~((data == 32) | ((data >= 9) & (data <= 13)))] = np.frombuffer(
                    b"".join(map(self.young.__getitem__, chunks)), np.int8)
                yield out


@functools.lru_cache(1)
def prefix_counts(path: str) -> PrefixCounts:
    """One for each worker process, with what it has learnt so far."""
    return PrefixCounts(path)


def _differences(word: bytes, counts: list[int]) -> bytes:
    """Of token counts; a prefix that ends inside a character counts as the one before the character."""
    if word.isascii():
        return bytes([(n - m) & 255 for n, m in zip(counts, [0, *counts])])
    out, before = bytearray(len(word)), 0
    for i, n in enumerate(counts):
        if i + 1 == len(word) or word[i + 1] & 0xC0 != 0x80:
            out[i] = (n - before) & 255
            before = n
    return bytes(out)


def unpacked(prefix_counts: bytes) -> np.ndarray:
    """Token counts of the first 1, 2, ... bytes, from the stored form."""
    return np.cumsum(np.frombuffer(zlib.decompress(prefix_counts), np.int8), dtype=np.int64)


def tokens_within(prefix_counts: bytes, n_bytes: int) -> int:
    """Tokens of the first `n_bytes` bytes of the text."""
    counts = unpacked(prefix_counts)
    return int(counts[min(n_bytes, len(counts)) - 1]) if n_bytes > 0 and len(counts) else 0


def longest_prefix(deltas: np.ndarray, budget: int) -> int:
    """Bytes of the longest prefix of at most `budget` tokens."""
    within = np.flatnonzero(np.cumsum(deltas, dtype=np.int64) <= budget)
    return int(within[-1]) + 1 if len(within) else 0


def token_counts(docs: DataFrame, vocabulary: str, budget: int, keep_prefixes: bool = True) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (n_tokens > budget), fit_bytes (longest prefix within the budget) and,
    if asked for, prefix_counts: the counts at every prefix, in the form that `tokens_within` reads.

    docs: doc_id, text; other columns are ignored. Null or empty texts have no bytes and no tokens. Repeated rows
    give repeated results; a null doc_id stays null; an empty table gives an empty result. A chunk that Unicode
    normalisation changes is encoded once for each of its characters.
    """
    fields = [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64()), ("over_limit", pa.bool_()),
              ("fit_bytes", pa.int64())] + [("prefix_counts", pa.binary())] * keep_prefixes

    def count(parts):
        counts = prefix_counts(vocabulary)

        def rows() -> Iterator[dict]:
            for batch in parts:
                texts = batch["text"].to_pylist()
                for doc_id, text, deltas in zip(batch["doc_id"].to_pylist(), texts, counts.texts(texts)):
                    n = int(deltas.sum(dtype=np.int64))
                    row = {"doc_id": doc_id, "n_bytes": len(text), "n_tokens": n, "over_limit": n > budget,
                           "fit_bytes": len(text) if n <= budget else longest_prefix(deltas, budget)}
                    if keep_prefixes:
                        row["prefix_counts"] = zlib.compress(deltas.tobytes(), 1)
                    yield row
        yield from batches(rows(), pa.schema(fields), 2000)

    ddl = "doc_id long, n_bytes long, n_tokens long, over_limit boolean, fit_bytes long"
    return texts_of(docs).mapInArrow(count, ddl + ", prefix_counts binary" * keep_prefixes)
