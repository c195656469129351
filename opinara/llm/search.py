"""Ranked lexical search the other way round: the queries are indexed, the documents stream past.

The index holds the items' terms and, per term, the items that ask for it. It is made of a bounded block of items and goes to
every task. Two passes over the documents follow: the first counts documents, terms and, for the index's terms only,
documents per term; the second weighs each document's counts against the index and keeps, per item and task, a heap
of the best. The heaps are merged by (item, slice of tasks), then by item. Documents are never shuffled or joined.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from opinara.llm.common import texts_of

#: What is no letter, digit or byte of a longer character separates terms; capital letters of ASCII become small ones.
LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))
#: An index holds so many items or bytes of their texts at most, or one item.
BLOCK_ITEMS, BLOCK_BYTES = 1024, 1 << 20
#: So many scores (documents times items) and uses of the index are held at once.
SCORES_AT_ONCE = 1 << 20
#: Heaps of a large job are merged in so many slices first.
SLICES = 64
BILLION = 1_000_000_000


def terms(text: bytes) -> list[bytes]:
    """Terms of a text in UTF-8, in order."""
    return text.translate(LETTERS).split()


class Index:
    """Items by term: `of` numbers the terms; those at starts[t]:starts[t + 1] are the items of term t and how often they ask."""

    def __init__(self, texts: list[bytes]):
        self.items = len(texts)
        self.of: dict[bytes, int] = {}
        asked = [Counter(terms(t)) for t in texts]
        for counts in asked:
            for term in counts:
                self.of.setdefault(term, len(self.of))
        use = sorted((self.of[term], item, n) for item, counts in enumerate(asked) for term, n in counts.items())
        table = np.array(use, np.int64).reshape(-1, 3)
        self.item, self.times = table[:, 1], table[:, 2]
        self.starts = np.searchsorted(table[:, 0], np.arange(len(self.of) + 1))


def blocks(items: DataFrame, most_items: int = BLOCK_ITEMS, most_bytes: int = BLOCK_BYTES) -> Iterator[tuple[list, list[bytes]]]:
    """(item_ids, texts) of bounded blocks of items; the driver holds one partition of them at a time."""
    ids, texts = [], []
    rows = items.select("item_id", F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text"))
    for row in rows.toLocalIterator():
        text = bytes(row.text)
        if ids and (len(ids) >= most_items or sum(map(len, texts)) + len(text) > most_bytes):
            yield ids, texts
            ids, texts = [], []
        ids.append(row.item_id)
        texts.append(text)
    if ids:
        yield ids, texts


def counted(docs: DataFrame, held) -> tuple[int, int, np.ndarray]:
    """Documents with a term, terms of all documents, and documents per term of the index (a broadcast)."""
    def count(parts):
        of = held.value.of
        found, n_docs, n_terms = np.zeros(len(of) + 1, np.int64), 0, 0
        for batch in parts:
            for text in batch["text"]:
                words = terms(text.as_py())
                n_docs += bool(words)
                n_terms += len(words)
                found[list({of.get(w, -1) for w in words})] += 1  # the last place takes all other terms
        at = np.flatnonzero(found[:-1])
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, [-1, -2])), pa.array(np.append(found[at], [n_docs, n_terms]))],
                                         ["term", "n"])

    sums = texts_of(docs).select("text").mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    df, both = np.zeros(len(held.value.of), np.int64), {-1: 0, -2: 0}
    for term, n in sums.collect():
        if term < 0:
            both[term] = n
        else:
            df[term] = n
    return both[-1], both[-2], df


def weights(n_docs: int, df: np.ndarray) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * x + 1))) for x in df.tolist()], np.int64)


class Heaps:
    """Per item the best documents so far, as (score, has an id, -doc_id); the worst of them is at the top."""

    def __init__(self, items: int, k: int):
        self.k = k
        self.heaps: list[list[tuple[int, bool, int]]] = [[] for _ in range(items)]
        self.least = np.zeros(items, np.int64)  # a document must reach this score

    def add(self, scores: np.ndarray, ids: list[int | None]) -> None:
        """scores: documents by items."""
        for doc, item in zip(*(x.tolist() for x in np.nonzero((scores > 0) & (scores >= self.least)))):
            doc_id = ids[doc]
            entry = (int(scores[doc, item]), doc_id is not None, -(doc_id or 0))
            heap = self.heaps[item]
            if len(heap) < self.k:
                heapq.heappush(heap, entry)
            elif entry > heap[0]:
                heapq.heapreplace(heap, entry)
            else:
                continue
            if len(heap) == self.k:
                self.least[item] = heap[0][0]

    def rows(self) -> Iterator[tuple[int, int | None, int]]:
        for item, heap in enumerate(self.heaps):
            for score, known, minus in heap:
                yield item, -minus if known else None, score


class Scorer:
    """Scores of documents for every item of an index."""

    def __init__(self, index: Index, weight: np.ndarray, n_docs: int, n_terms: int):
        self.index, self.weight, self.n_docs, self.n_terms = index, weight, n_docs, n_terms
        self.uses = np.diff(index.starts)

    def _hits(self, text: bytes) -> tuple[list[int], list[int], int]:
        """Numbers of the index's terms in a text, how often each occurs, and the text's length factor."""
        words = terms(text)
        counts = Counter(map(self.index.of.get, words))
        counts.pop(None, None)
        long = 100 - 25 + (25 * len(words) * self.n_docs) // self.n_terms if self.n_terms else 75
        return list(counts), list(counts.values()), long

    def scores(self, texts: list[bytes]) -> Iterator[tuple[int, np.ndarray]]:
        """(first document, scores of some documents by items), bounded groups of documents."""
        most = max(1, SCORES_AT_ONCE // max(1, self.index.items))
        at, held, uses = 0, [], 0
        for i, text in enumerate(texts):
            found = self._hits(text)
            more = int(self.uses[found[0]].sum())
            if held and (len(held) >= most or uses + more > SCORES_AT_ONCE):
                yield at, self._weighed(held)
                at, held, uses = i, [], 0
            held.append(found)
            uses += more
        if held:
            yield at, self._weighed(held)

    def _weighed(self, held: list[tuple[list[int], list[int], int]]) -> np.ndarray:
        index = self.index
        sizes = np.array([len(h[0]) for h in held])
        term = np.array([t for h in held for t in h[0]], np.int64)
        tf = np.array([n for h in held for n in h[1]], np.int64)
        m = np.repeat(np.array([h[2] for h in held], np.int64), sizes)
        value = self.weight[term] * ((BILLION * tf) // (1000 * tf + 12 * m))
        doc = np.repeat(np.arange(len(held)), sizes)
        uses = self.uses[term]
        place = np.arange(uses.sum()) - np.repeat(np.cumsum(uses) - uses, uses) + np.repeat(index.starts[term], uses)
        out = np.zeros(len(held) * index.items, np.int64)
        np.add.at(out, np.repeat(doc, uses) * index.items + index.item[place], np.repeat(value, uses) * index.times[place])
        return out.reshape(len(held), index.items)


def best(docs: DataFrame, texts: list[bytes], k: int) -> DataFrame:
    """item (place in `texts`), rank, doc_id, score: the k best documents of each item of one block."""
    context = docs.sparkSession.sparkContext
    held = context.broadcast(Index(texts))
    n_docs, n_terms, df = counted(docs, held)
    weight = context.broadcast(weights(n_docs, df))

    def search(parts):
        index = held.value
        scorer, heaps = Scorer(index, weight.value, n_docs, n_terms), Heaps(index.items, k)
        for batch in parts:
            ids = batch["doc_id"].to_pylist()
            for at, scores in scorer.scores(batch["text"].to_pylist()):
                heaps.add(scores, ids[at:at + len(scores)])
        part = TaskContext.get().partitionId() % SLICES
        rows = [(item, part, doc_id, score) for item, doc_id, score in heaps.rows()]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), (pa.int32(), pa.int32(), pa.int64(), pa.int64()))],
                                             ["item", "part", "doc_id", "score"])

    found = texts_of(docs).mapInArrow(search, "item int, part int, doc_id long, score long")
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    for by in (["item", "part"], ["item"]):
        found = found.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("rank") <= k)
    return found.select("item", "rank", "doc_id", "score")


def ranked(docs: DataFrame, items: DataFrame, k: int = 20, most_items: int = BLOCK_ITEMS, most_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The k best documents of each item: item_id, rank (from 1), doc_id, score; scores of 0 are left out.

    docs: doc_id, text; items: item_id, text; other columns are ignored. Equal scores go by ascending doc_id, a null doc_id
    last; repeated rows are documents, or items, of their own. A null or empty text has no terms: such a
    document is never found, such an item finds nothing. Empty tables give an empty result. Every block of items costs two
    passes over the documents.
    """
    spark = docs.sparkSession
    item_id = items.schema["item_id"].dataType.simpleString()
    out = None
    for ids, texts in blocks(items, most_items, most_bytes):
        names = spark.createDataFrame(list(enumerate(ids)), f"item int, item_id {item_id}")
        rows = best(docs, texts, k).join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")
        out = rows if out is None else out.union(rows)
    return spark.createDataFrame([], f"item_id {item_id}, rank int, doc_id long, score long") if out is None else out
