"""Two tokenizers over the same bytes: where their tokens meet, which overlap, and which pairs are usual in a corpus.

A text is cut before every run of spaces, tabs and line feeds that follows something else; neither tokenizer has a token across such a
cut (the vocabulary is checked for that), so a text is the sequence of its stretches. Each distinct stretch is encoded and
aligned once per worker, many in a row: all tokens of both kinds as byte intervals, sorted by start; the
running maximum of their ends breaks them into groups where a start reaches it; the B tokens that an A token
overlaps are a range. What a worker keeps is bounded by bytes.

How many documents hold an id pair is counted per task, then by pair. This table of pairs is read by the second pass in blocks
of counted size, and each document's sums over its pairs are added up block by block.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinara.llm.common import stored, texts_of

#: A stretch: spaces, tabs and line feeds, and what follows them.
STRETCHES = re.compile(rb"[ \t\n]*[^ \t\n]+|[ \t\n]+").findall
#: White space that the tokenizers may join with these, or with letters: a text that has any is one stretch.
OTHER_SPACE = re.compile("[%s]" % "".join(map(chr, [0x0B, 0x0C, 0x0D, *range(0x1C, 0x20), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029,
                                                   0x202F, 0x205F, 0x3000]))).search
#: Stretches are encoded in runs of about so many bytes.
UNIT_BYTES = 4096
#: A worker forgets what it knows of stretches when that takes so many bytes.
KEPT_BYTES = 192 << 20
#: Documents are worked on in groups of so many, or so many bytes.
GROUP_TEXTS, GROUP_BYTES = 200, 1 << 20
#: Counts of pairs leave a task when it holds this many.
PAIRS_PER_TASK = 1 << 20
#: The second pass holds so many pairs at once (24 bytes each).
PAIRS_AT_ONCE = 1 << 22


def byte_of_char() -> dict[str, int]:
    """The byte-level alphabet: printable bytes stand for themselves, the others for characters from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def coalesced(start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Group number of each interval, intervals sorted by start: a group ends where a start reaches the running maximum of ends."""
    if not len(start):
        return np.zeros(0, np.int64)
    reach = np.maximum.accumulate(end)
    return np.concatenate([[0], np.cumsum(start[1:] >= reach[:-1])])


def overlapping(a_start, a_end, b_start, b_end) -> tuple[np.ndarray, np.ndarray]:
    """(A, B) indices of all pairs of intervals that share a byte; each side is sorted and free of overlaps."""
    first = np.searchsorted(b_end, a_start, side="right")
    n = np.maximum(0, np.searchsorted(b_start, a_end, side="left") - first)
    return np.repeat(np.arange(len(a_start)), n), np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first, n)


class Aligner:
    """Aligns texts under a byte-level BPE (tokenizers, A) and a piece model with byte fallback (sentencepiece, B).

    What is known of a stretch stands at its number: ok, tokens of A and B, groups, place and number of its linked pairs in
    `pairs`, and its groups as text. All is forgotten once it takes `kept_bytes`.
    """

    def __init__(self, path_a: str, path_b: str, kept_bytes: int = KEPT_BYTES):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one thread for each Spark task
        import sentencepiece
        from tokenizers import Tokenizer
        self.a, self.b = Tokenizer.from_file(path_a), sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.a.encode_special_tokens = True
        alphabet = byte_of_char()
        vocabulary = self.a.get_vocab()
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            known = all(c in alphabet for c in token)
            self.a_bytes[i] = bytes(alphabet[c] for c in token) if known else token.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", p) else p.replace("▁", " ").encode()
                        for p in pieces]
        #: No token goes over a cut, so stretches may be encoded one by one, or many in a row.
        over = re.compile(rb"[^ \t\n][ \t\n]").search
        self.cuts = all(OTHER_SPACE(x.decode("utf-8", "replace")) for x in filter(over, self.a_bytes + self.b_bytes))
        self.a_size, self.b_size = (np.array([len(x) for x in t]) for t in (self.a_bytes, self.b_bytes))
        self.kept_bytes = kept_bytes
        self._forget()

    def _forget(self) -> None:
        self.numbers: dict[bytes, int] = {}
        self.groups: list[bytes] = []
        self.facts = np.zeros((0, 6), np.int64)
        self.pairs = np.zeros(0, np.int64)
        self.size = 0

    def _pieces(self, text: str) -> list[int] | None:
        """B's ids. The model puts a space in front: it takes the place of the text's own, or goes with a helper word."""
        if text.startswith(" ") and len(text) > 1:
            return self.b.encode(text[1:])
        ids, size = self.b.encode("a" + text), 0
        while size < 2 and ids:
            size += len(self.b_bytes[ids.pop(0)])
        return ids if size == 2 else None

    def _encoded(self, units: list[list[bytes]]) -> Iterator[tuple[list[bytes], list[int] | None, list[int] | None]]:
        """(stretches, A ids, B ids) of runs of stretches; a stretch that is not given back byte by byte comes alone, without ids."""
        while units:
            whole = [b"".join(u) for u in units]
            texts = [w.decode("utf-8", "replace") for w in whole]
            again = []
            for u, w, t, e in zip(units, whole, texts, self.a.encode_batch_fast(texts, add_special_tokens=False)):
                a, b = e.ids, self._pieces(t)
                if b is not None and b"".join(map(self.a_bytes.__getitem__, a)) == w == b"".join(map(self.b_bytes.__getitem__, b)):
                    yield u, a, b
                elif len(u) == 1:
                    yield u, None, None
                else:
                    again += [u[:len(u) // 2], u[len(u) // 2:]]
            units = again

    def _learn(self, stretches: list[bytes], alone: set[bytes]) -> None:
        """Align stretches that are not known yet. Those in `alone` and white space by itself are not encoded in a row with others."""
        units, size = [[]], 0
        for s in stretches:
            if s in alone or s.isspace():
                units.insert(0, [s])
            else:
                units[-1].append(s)
                size += len(s)
                if size > UNIT_BYTES:
                    units.append([])
                    size = 0
        good, bad, ids = [], [], ([], [])
        for u, a, b in self._encoded([u for u in units if u]):
            if a is None:
                bad += u
            else:
                good += u
                ids[0].extend(a)
                ids[1].extend(b)
        facts, groups, pairs = self._aligned(good, *(np.array(x, np.int64) for x in ids))
        facts[:, 4] += len(self.pairs)
        first = len(self.groups)
        self.numbers.update(zip(good + bad, range(first, first + len(stretches))))
        self.groups += groups + [b""] * len(bad)
        self.facts = np.concatenate([self.facts, facts, np.zeros((len(bad), 6), np.int64)])
        self.pairs = np.concatenate([self.pairs, pairs])
        self.size += 300 * len(stretches) + sum(map(len, stretches)) + sum(map(len, groups)) + 8 * len(pairs)

    def _aligned(self, stretches: list[bytes], a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, list[bytes], np.ndarray]:
        """Facts, texts of groups and linked pairs of stretches that lie one after the other, so no group goes over two."""
        n = len(stretches)
        bounds = np.cumsum([len(s) for s in stretches])
        a_end, b_end = np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b])
        a_start, b_start = a_end - self.a_size[a], b_end - self.b_size[b]
        ids, start, end = np.concatenate([a, b]), np.concatenate([a_start, b_start]), np.concatenate([a_end, b_end])
        kind = np.repeat([0, 1], [len(a), len(b)])
        order = np.lexsort((kind, start))
        group = np.empty(len(ids), np.int64)
        group[order] = coalesced(start[order], end[order])
        own = np.searchsorted(bounds, end)
        i, j = overlapping(a_start, a_end, b_start, b_end)
        links = np.bincount(own[i], minlength=n)
        told = np.lexsort((start, kind, group))
        ids, kind, group, own = ids[told], kind[told], group[told], own[told]
        last = np.append(group[1:] != group[:-1], True)[:len(ids)]
        sign = np.where(last, b";", np.where(np.append(kind[1:] != kind[:-1], True)[:len(ids)], b"|", b","))
        words = [b"%d%s" % x for x in zip(ids.tolist(), sign.tolist())]
        text = b"".join(words)
        cuts = np.cumsum(np.bincount(own, [len(w) for w in words], n)).astype(np.int64).tolist()
        groups = [text[lo:hi - 1] for lo, hi in zip([0, *cuts], cuts)]  # without the last sign
        facts = np.stack([np.ones(n, np.int64), np.bincount(own[kind == 0], minlength=n), np.bincount(own[kind == 1], minlength=n),
                          np.bincount(own[last], minlength=n), np.cumsum(links) - links, links], axis=1)
        return facts, groups, a[i] * len(self.b_bytes) + b[j]

    def align(self, texts: list[bytes]) -> tuple[np.ndarray, list[str], list[bytes], list[bytes]]:
        """For texts (space + text is aligned; an empty text has no tokens): n_a, n_b, n_groups and n_links in columns, the
        digests of the groups, the distinct linked pairs as sorted 64-bit numbers and how often each is linked."""
        if self.size > self.kept_bytes:
            self._forget()
        parts, alone = [], set()
        for t in texts:
            if t and (not self.cuts or OTHER_SPACE(t.decode("utf-8", "replace"))):
                alone.add(b" " + t)
                parts.append([b" " + t])
            else:
                parts.append(STRETCHES(b" " + t) if t else [])
        flat = list(itertools.chain.from_iterable(parts))
        numbers = list(map(self.numbers.get, flat))
        if None in numbers:
            self._learn(list(dict.fromkeys(s for s, i in zip(flat, numbers) if i is None)), alone)
            numbers = list(map(self.numbers.__getitem__, flat))
        at = np.array(numbers, np.int64)
        doc = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
        facts = self.facts[at]
        whole = np.bincount(doc, facts[:, 0] == 0, len(parts)) == 0
        keep = whole[doc]
        at, facts, doc = at[keep], facts[keep], doc[keep]
        sums = np.stack([np.bincount(doc, facts[:, c], len(parts)) for c in (1, 2, 3, 5)]).astype(np.int64)
        n = facts[:, 5]
        place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(facts[:, 4], n)
        width = len(self.a_bytes) * len(self.b_bytes)
        found, times = np.unique(np.repeat(doc, n) * width + self.pairs[place], return_counts=True)
        ends = np.searchsorted(found, np.arange(len(parts) + 1) * width)
        pairs, times = (found % width).astype("<i8"), times.astype("<u4")
        digests, done = [], 0
        for p, fine in zip(parts, whole):
            own = numbers[done:done + len(p)]
            done += len(p)
            digests.append(hashlib.sha256(b";".join(map(self.groups.__getitem__, own))).hexdigest() if fine and p else "")
        cut = lambda x: [x[lo:hi].tobytes() for lo, hi in zip(ends[:-1], ends[1:])]
        return sums, digests, cut(pairs), cut(times)


@functools.lru_cache(1)
def aligner(path_a: str, path_b: str) -> Aligner:
    """One for each worker process, with what it has learnt so far."""
    return Aligner(path_a, path_b)


ALIGNED = pa.schema([("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()),
                     ("n_links", pa.int64()), ("groups_sha256", pa.string()), ("pairs", pa.binary()), ("times", pa.binary())])
ALIGNED_DDL = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
               "pairs binary, times binary")


def documents_aligned(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Per document the counts, the digest of its groups, and its distinct linked pairs (A id times B's vocabulary plus B id,
    64-bit) with how often each is linked."""
    def align(parts):
        work = aligner(path_a, path_b)
        for batch in parts:
            sizes = pc.binary_length(batch["text"]).to_numpy()
            at = 0
            while at < batch.num_rows:  # bounded groups, or one text
                n = max(1, int(np.searchsorted(np.cumsum(sizes[at:at + GROUP_TEXTS]), GROUP_BYTES, "right")))
                sums, *columns = work.align(batch["text"].slice(at, n).to_pylist())
                yield pa.RecordBatch.from_arrays([batch["doc_id"].slice(at, n), *map(pa.array, sums),
                                                  *(pa.array(c, f.type) for c, f in zip(columns, list(ALIGNED)[5:]))], schema=ALIGNED)
                at += n

    return texts_of(docs).mapInArrow(align, ALIGNED_DDL)


def pair_counts(aligned: DataFrame, vocabulary_b: int) -> DataFrame:
    """pair, n (documents that hold it linked), best (no other pair of its A id is in more documents)."""
    def count(parts):
        keys, sums = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in parts:
            new = np.frombuffer(b"".join(batch["pairs"].to_pylist()), "<i8")
            keys, at = np.unique(np.concatenate([keys, new]), return_inverse=True)
            sums = np.bincount(at, np.concatenate([sums, np.ones(len(new), np.int64)]), len(keys)).astype(np.int64)
            if len(keys) > PAIRS_PER_TASK:
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(sums)], ["pair", "n"])
                keys, sums = keys[:0], sums[:0]
        yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(sums)], ["pair", "n"])

    counts = stored(aligned.select("pairs").mapInArrow(count, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")))
    of = F.floor(F.col("pair") / vocabulary_b).cast("long").alias("a")
    most = counts.groupBy(of).agg(F.max("n").alias("most"))
    return counts.withColumn("a", F.floor(F.col("pair") / vocabulary_b).cast("long")).join(most, "a").select(
        "pair", "n", (F.col("n") == F.col("most")).alias("best"))


def weighed(aligned: DataFrame, counts: DataFrame, most: int = PAIRS_AT_ONCE) -> DataFrame:
    """Adds n_best and count_sum over each document's links. counts is looked up in blocks of about `most` pairs."""
    counts = stored(counts)
    n_blocks = max(1, -(-counts.count() // most))
    out = aligned.withColumns({"n_best": F.lit(0).cast("long"), "count_sum": F.lit(0).cast("long")})
    for block in range(n_blocks):
        of = counts.where(F.pmod(F.xxhash64("pair"), F.lit(n_blocks)) == block).toArrow()
        keys = of["pair"].to_numpy()
        order = np.argsort(keys)
        held = aligned.sparkSession.sparkContext.broadcast((keys[order], of["n"].to_numpy()[order], of["best"].to_numpy()[order]))
        out = _added(out, held)
        if block + 1 < n_blocks:
            out = stored(out)
    return out


def _added(aligned: DataFrame, held) -> DataFrame:
    def add(parts):
        keys, n, best = held.value
        for batch in parts:
            raw = batch["pairs"].to_pylist()
            pairs = np.frombuffer(b"".join(raw), "<i8")
            times = np.frombuffer(b"".join(batch["times"].to_pylist()), "<u4").astype(np.int64)
            at = np.minimum(np.searchsorted(keys, pairs), max(0, len(keys) - 1))
            hit = keys[at] == pairs if len(keys) else np.zeros(len(pairs), bool)
            ends = np.cumsum([len(r) // 8 for r in raw])
            more = []
            for value in (best[at], n[at]) if len(keys) else (hit, hit):
                running = np.append(0, np.cumsum(np.where(hit, value, 0) * times))
                more.append(running[ends] - running[np.append(0, ends[:-1])])
            columns = [batch[c] for c in batch.schema.names]
            for name, x in zip(("n_best", "count_sum"), more):
                i = batch.schema.get_field_index(name)
                columns[i] = pa.array(columns[i].to_numpy() + x)
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    return aligned.mapInArrow(add, aligned.schema)


def aligned(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Per row of `docs`: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    docs: doc_id, text; other columns are ignored. A null or empty text, and one that either tokenizer does not give back
    byte by byte, has no tokens: zeros and an empty digest. Repeated rows count as documents of their own, with or
    without doc_id. Ties of an A id's highest count are all best. An empty table gives an empty result.
    """
    import sentencepiece
    rows = stored(documents_aligned(docs, path_a, path_b))
    vocabulary_b = sentencepiece.SentencePieceProcessor(model_file=path_b).get_piece_size()
    return weighed(rows, pair_counts(rows, vocabulary_b)).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
