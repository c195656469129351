"""Byte-level BPE: encoding by a segment tree of pair ranks, and decoding.

A piece of text starts as its bytes. A segment tree over the byte positions holds at each leaf the rank of the pair
that the token there forms with its right neighbour, and at each inner node the smallest rank below, the leftmost
of equal ones. The root names the next merge. A merge joins two live neighbours and changes three leaves, so it
costs a number of steps logarithmic in the length. Trees of equal size are worked on side by side as arrays.

Texts are cut into pieces by the vocabulary's pattern; pieces are encoded once for each distinct one.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from opinara.llm.common import batches, texts_of

NONE = np.int64(np.iinfo(np.int64).max)
#: A space after white space and before white space or the end: only there a cut before a space could change pieces.
UNSURE = re.compile(r"\s (?:\s|\Z)").search
#: Pieces longer than this are merged one at a time.
SIDE_BY_SIDE = 1024


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes -> rank, from a file of lines `base64 rank`."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


class Merges:
    """Ranks of pairs of tokens: the rank of their joined bytes, which is also the joined token's id."""

    def __init__(self, ranks: dict[bytes, int]):
        self.single = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        pairs = {}
        for token, rank in ranks.items():
            for i in range(1, len(token)):
                a, b = ranks.get(token[:i]), ranks.get(token[i:])
                if a is not None and b is not None:
                    pairs[a << 32 | b] = rank
        self.pairs = pairs
        self.keys = np.array(sorted(pairs), np.int64)
        self.ranks = np.array([pairs[k] for k in self.keys.tolist()], np.int64)

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair of tokens, NONE where they form no token; b is -1 where there is no neighbour."""
        key = a << 32 | b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((self.keys[at] == key) & (b >= 0), self.ranks[at], NONE)


def encode_pieces(pieces: list[bytes], merges: Merges) -> list[np.ndarray]:
    """Token ids of each piece."""
    out: list[np.ndarray] = [np.zeros(0, np.uint32)] * len(pieces)
    by_size: dict[int, list[int]] = {}
    for i, p in enumerate(pieces):
        if len(p) > SIDE_BY_SIDE:
            out[i] = _encode_long(p, merges)
        elif p:
            by_size.setdefault(max(2, 1 << (len(p) - 1).bit_length()), []).append(i)
    for size, at in by_size.items():
        step = max(1, 400_000 // size)
        for k in range(0, len(at), step):
            some = at[k:k + step]
            for i, ids in zip(some, _encode_trees([pieces[i] for i in some], size, merges)):
                out[i] = ids
    return out


def _encode_trees(pieces: list[bytes], size: int, merges: Merges) -> list[np.ndarray]:
    n = len(pieces)
    lengths = np.array([len(p) for p in pieces])
    token = np.full((n, size + 1), -1, np.int64)  # the column behind the last is the missing neighbour
    inside = np.arange(size) < lengths[:, None]
    token[:, :size][inside] = merges.single[np.frombuffer(b"".join(pieces), np.uint8)]
    follow = np.minimum(np.arange(1, size + 2), size) * np.ones((n, 1), np.int64)
    before = np.arange(-1, size) * np.ones((n, 1), np.int64)
    places = np.arange(size, dtype=np.int64)

    def leaf(rows, at):
        rank = merges.rank(token[rows, at], token[rows, follow[rows, at]])
        return np.where(rank == NONE, NONE, rank << 32 | at)

    tree = np.full((n, 2 * size), NONE, np.int64)
    rank = merges.rank(token[:, :size].ravel(), token[:, 1:].ravel()).reshape(n, size)
    tree[:, size:] = np.where((rank == NONE) | ~inside, NONE, rank << 32 | places)
    for level in range(size.bit_length() - 2, -1, -1):
        a, b = 1 << level, 2 << level
        tree[:, a:b] = np.minimum(tree[:, 2 * a:2 * b:2], tree[:, 2 * a + 1:2 * b:2])

    def update(rows, at, values):
        node = at + size
        tree[rows, node] = values
        while node[0] > 1:
            node = node >> 1
            tree[rows, node] = np.minimum(tree[rows, 2 * node], tree[rows, 2 * node + 1])

    live = np.arange(n)
    while len(live):
        best = tree[live, 1]
        live, best = live[best != NONE], best[best != NONE]
        if not len(live):
            break
        at = best & 0xFFFFFFFF
        gone = follow[live, at]
        beyond = follow[live, gone]
        token[live, at] = best >> 32
        token[live, gone] = -1
        follow[live, at] = beyond
        before[live, beyond] = at
        update(live, gone, np.full(len(live), NONE))
        update(live, at, leaf(live, at))
        left = before[live, at]
        has = np.flatnonzero(left >= 0)
        if len(has):
            update(live[has], left[has], leaf(live[has], left[has]))
    kept = token[:, :size] >= 0
    return np.split(token[:, :size][kept].astype(np.uint32), np.cumsum(kept.sum(axis=1))[:-1])


def _encode_long(piece: bytes, merges: Merges) -> np.ndarray:
    """The same for one long piece, with plain lists."""
    size, none = 1 << (len(piece) - 1).bit_length(), int(NONE)
    token = merges.single[np.frombuffer(piece, np.uint8)].tolist()
    follow, before = [*range(1, len(piece)), -1], list(range(-1, len(piece) - 1))

    def leaf(i: int) -> int:
        rank = merges.pairs.get(token[i] << 32 | token[follow[i]]) if follow[i] >= 0 else None
        return none if rank is None else rank << 32 | i

    tree = [none] * size + [leaf(i) for i in range(len(piece))] + [none] * (size - len(piece))
    for node in range(size - 1, 0, -1):
        tree[node] = min(tree[2 * node], tree[2 * node + 1])

    def update(i: int, value: int) -> None:
        node = i + size
        tree[node] = value
        while node > 1:
            node >>= 1
            tree[node] = min(tree[2 * node], tree[2 * node + 1])

    while tree[1] != none:
        at = tree[1] & 0xFFFFFFFF
        gone = follow[at]
        token[at] = tree[1] >> 32
        token[gone] = -1
        follow[at] = follow[gone]
        if follow[gone] >= 0:
            before[follow[gone]] = at
        update(gone, none)
        update(at, leaf(at))
        if before[at] >= 0:
            update(before[at], leaf(before[at]))
    return np.array([t for t in token if t >= 0], np.uint32)


class ByteBPE:
    """Encode and decode whole texts. Ids of units (a word with the space before it) are kept in two generations."""

    def __init__(self, path: str, pattern: str, limit: int = 200_000):
        ranks = read_ranks(path)
        self.merges = Merges(ranks)
        self.tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.pattern = regex.compile(pattern)
        self.limit = limit
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def units(self, text: str) -> list[str]:
        """Parts of a text whose pieces are those of the whole: it is cut before single spaces where that is safe."""
        if UNSURE(text):
            return [text]
        first, *rest = text.split(" ")
        return [first, *[" " + x for x in rest]]

    def _learn(self, units: set[str]) -> None:
        if len(self.young) > self.limit:
            self.old, self.young = self.young, {}
        fresh = []
        for u in units.difference(self.young):
            if u in self.old:
                self.young[u] = self.old[u]
            else:
                fresh.append(u)
        split = [[p.encode() for p in self.pattern.findall(u)] for u in fresh]
        pieces = list(set().union(*split))
        ids = dict(zip(pieces, (x.astype("<u4").tobytes() for x in encode_pieces(pieces, self.merges))))
        self.young.update((u, b"".join([ids[p] for p in own])) for u, own in zip(fresh, split))

    def encode(self, texts: list[str], group: int = 200) -> Iterator[np.ndarray]:
        """Token ids of each text."""
        for at in range(0, len(texts), group):
            split = [self.units(t) for t in texts[at:at + group]]
            self._learn(set().union(*split))
            for units in split:
                yield np.frombuffer(b"".join(map(self.young.__getitem__, units)), "<u4")

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids.tolist()))


@functools.lru_cache(1)
def byte_bpe(path: str, pattern: str) -> ByteBPE:
    """One for each worker process, with what it has learnt so far."""
    return ByteBPE(path, pattern)


def encoded(docs: DataFrame, vocabulary: str, pattern: str, keep_ids: bool = True) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 (of the decoded ids) and, if asked for, ids and decoded text.

    docs: doc_id, text; other columns are ignored. Null or empty texts have no tokens. Repeated rows give repeated
    results; a null doc_id stays null; an empty table gives an empty result.
    """
    fields = [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]
    fields += [("ids", pa.list_(pa.int32())), ("decoded", pa.binary())] * keep_ids

    def encode(parts):
        bpe = byte_bpe(vocabulary, pattern)

        def rows() -> Iterator[dict]:
            for batch in parts:
                texts = [t.decode("utf-8", "replace") for t in batch["text"].to_pylist()]
                for doc_id, ids in zip(batch["doc_id"].to_pylist(), bpe.encode(texts)):
                    decoded = bpe.decode(ids)
                    row = {"doc_id": doc_id, "n_tokens": len(ids), "ids_sha256": hashlib.sha256(ids.tobytes()).hexdigest(),
                           "decoded_sha256": hashlib.sha256(decoded).hexdigest()}
                    yield row | ({"ids": ids.tolist(), "decoded": decoded} if keep_ids else {})
        yield from batches(rows(), pa.schema(fields), 1000)

    ddl = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>, decoded binary" * keep_ids
    return texts_of(docs).mapInArrow(encode, ddl)
