"""Fingerprints of documents as sums of paragraph vectors, so that parts can be added and taken away.

A paragraph is a line that is not empty. Its vector has two parts:

* identity: 32 numbers of 64 bits, drawn from a hash of the paragraph, added modulo 2**64. Two texts have the same sum
  only if they have the same paragraphs as often, in any order;
* content: 256 counters modulo 2**32, more than a text of 2 GB has runs of words. Every run of three words adds +1 or -1 to one of them, both by hash. The cosine of
  two such sums estimates how much text is shared, also where the paragraphs themselves differ a little.

Both sums are homomorphic: the fingerprint of a text is that of its parts added, in any order, and removing a paragraph
subtracts its vector.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinara.llm.common import batches, mixed, texts_of
from opinara.llm.shingles import WordHashes

LANES, CONTENT = 32, 256
EDGE = b"\x00edge\x00"  # stands at both ends of a paragraph


class Fingerprint:
    """A pair of sums; `+` and `-` combine, `likeness` compares."""

    def __init__(self, identity: np.ndarray | None = None, content: np.ndarray | None = None):
        self.identity = np.zeros(LANES, np.uint64) if identity is None else identity
        self.content = np.zeros(CONTENT, np.uint32) if content is None else content

    @classmethod
    def of(cls, text: bytes, memo: WordHashes) -> Fingerprint:
        lines = [p for p in text.split(b"\n") if p]
        drawn = b"".join([hashlib.shake_128(p).digest(8 * LANES) for p in lines])
        identity = np.frombuffer(drawn, "<u8").reshape(-1, LANES).sum(axis=0, dtype=np.uint64)
        return cls(identity, _content(lines, memo))

    def __add__(self, other: Fingerprint) -> Fingerprint:
        return Fingerprint(self.identity + other.identity, self.content + other.content)

    def __sub__(self, other: Fingerprint) -> Fingerprint:
        return Fingerprint(self.identity - other.identity, self.content - other.content)

    def __str__(self) -> str:
        return self.identity.astype("<u8").tobytes().hex() + self.content.astype("<u4").tobytes().hex()

    def likeness(self, other: Fingerprint) -> float:
        """1 for equal fingerprints; else the cosine of the content counters, from 0 to 1."""
        if np.array_equal(self.identity, other.identity) and np.array_equal(self.content, other.content):
            return 1.0
        a, b = (x.content.view(np.int32).astype(np.float64) for x in (self, other))
        size = float(np.sqrt((a @ a) * (b @ b)))
        return min(1.0, max(0.0, float(a @ b) / size)) if size else 0.0


def _content(lines: list[bytes], memo: WordHashes) -> np.ndarray:
    words = ((b" " + EDGE + b" ").join([b"", *lines, b""])).split()
    if len(words) < 3:
        return np.zeros(CONTENT, np.uint32)
    h = np.fromiter(map(memo.__getitem__, words), np.uint64, len(words))
    edge = h == np.uint64(memo[EDGE])
    one, two, three = h[:-2], h[1:-1], h[2:]
    inside = ~edge[1:-1] & (~edge[2:] | edge[:-2])  # a run of three words of one paragraph, or a word alone
    runs = mixed((one * np.uint64(3) + two) * np.uint64(0x9E3779B97F4A7C15) + three)[inside]
    lane = (runs % np.uint64(CONTENT)).astype(np.int64)
    sign = np.where(runs >> np.uint64(63), 1, -1)
    return np.bincount(lane, sign, CONTENT).astype(np.int64).astype(np.uint32)


def edited(text: str, following: str) -> str:
    """The last half of the characters replaced by as many of the first of the next text."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited and near_next per row.

    docs: doc_id, text; other columns are ignored. The next document is the one with the next smaller doc_id, after the
    smallest the largest; rows of one doc_id follow each other in the order of their texts, rows without doc_id come
    last. A single document follows itself. A null text is empty: it has no paragraph and the zero fingerprint. An
    empty table gives an empty result.

    Documents are dealt to ranges of doc_id; each range also gets a copy of the document that follows its last one.
    """
    spark = docs.sparkSession
    texts = texts_of(docs).withColumn("at", F.coalesce("doc_id", F.lit(-(1 << 63))))
    wanted = 3 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = sorted(set(texts.approxQuantile("at", [i / wanted for i in range(1, wanted)], 0.2 / wanted)))
    bounds = spark.sparkContext.broadcast(np.array(cuts, np.float64))

    def bucket(at: np.ndarray) -> np.ndarray:
        return np.searchsorted(bounds.value, at.astype(np.float64), side="left").astype(np.int32)

    def assign(parts):
        for batch in parts:
            yield pa.RecordBatch.from_arrays([batch["at"], pa.array(bucket(batch["at"].to_numpy()))], ["at", "bucket"])

    largest = sorted((r.bucket, r.at) for r in texts.select("at").mapInArrow(assign, "at long, bucket int")
                     .groupBy("bucket").agg(F.max("at").alias("at")).collect())
    # The last document of a range is followed by the largest of the range below, or of the last range.
    follows: dict[int, list[int]] = {}
    for i, (b, _) in enumerate(largest):
        follows.setdefault(largest[i - 1][1], []).append(b)
    held = spark.sparkContext.broadcast(follows)
    ddl = "doc_id long, text binary, at long, bucket int, extra boolean"

    def deal(parts):
        for batch in parts:
            at = batch["at"].to_numpy()
            rows, buckets = np.arange(len(at)), bucket(at)
            more = [(i, b) for i in np.flatnonzero(np.isin(at, list(held.value))) for b in held.value[int(at[i])]]
            take = pa.array(np.append(rows, [i for i, _ in more]).astype(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch[c].take(take) for c in ("doc_id", "text", "at")]
                + [pa.array(np.append(buckets, [b for _, b in more]).astype(np.int32)), pa.array(np.arange(len(take)) >= len(rows))],
                ["doc_id", "text", "at", "bucket", "extra"])

    dealt = (texts.mapInArrow(deal, ddl).repartition("bucket")
             .sortWithinPartitions("bucket", "extra", F.desc("at"), "text"))
    schema = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
                        ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])

    def compare(parts):
        memo = WordHashes()

        def rows() -> Iterator[dict]:
            last = None  # (bucket, doc_id, text, fingerprint) of a row that waits for the next
            for batch in parts:
                for doc_id, text, b, extra in zip(*(batch[c].to_pylist() for c in ("doc_id", "text", "bucket", "extra"))):
                    own = None
                    if last is not None and last[0] == b:
                        own = Fingerprint.of(text, memo)
                        yield result(*last[1:], text, own)
                        last = None
                    if not extra:
                        last = (b, doc_id, text, own or Fingerprint.of(text, memo))

        def result(doc_id, text, own, following, next_own) -> dict:
            text, following = text.decode("utf-8", "replace"), following.decode("utf-8", "replace")
            changed = edited(text, following).encode()
            other = Fingerprint.of(changed, memo)
            return {"doc_id": doc_id, "n_chars": len(text), "edited_sha256": hashlib.sha256(changed).hexdigest(),
                    "fingerprint": str(own), "edited_fingerprint": str(other),
                    "near_edited": own.likeness(other), "near_next": own.likeness(next_own)}

        yield from batches(rows(), schema, 500)

    return dealt.mapInArrow(compare, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
                                     "edited_fingerprint string, near_edited double, near_next double")
