"""Language of a text by compression: the language whose sample text helps most to compress it.

Each language has a dictionary of raw text, taken from labelled documents. A text is compressed in blocks with every
dictionary in turn; the smallest total names the language. Blocks are short, so the dictionary matters in all of
them, and a long text cannot become its own dictionary. Where the best two differ by a byte at most, as in very short
texts, the bits that a model of three letters would need, learnt from the dictionaries, are added. What is equal even
then goes to the language with most documents.
"""

from __future__ import annotations

import itertools
import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinara.llm.common import batches, slices, texts_of
from opinara.llm.token_ids import forget

UNKNOWN = "und"
NO_LETTERS = re.compile(r"[\W\d_]+").sub
BLOCK_BYTES, LEVEL = 2048, 6
#: Totals that differ by so many bytes or less say nothing yet. The share that three letters count as if never seen.
NO_EVIDENCE, UNSEEN = 1, 2.0 ** -18


def plain(text: str) -> bytes:
    """Words in lower case, without signs and digits; a word that repeats itself counts once."""
    return " ".join(w for w, _ in itertools.groupby(NO_LETTERS(" ", text.lower()).split())).encode()


def learn(docs: DataFrame, per_language: int = 1000, dictionary_bytes: int = 1 << 16, slice_bytes: int = 200) -> dict[str, bytes]:
    """A dictionary per language from `docs` (doc_id, text, lang), the most frequent language first.

    A bounded sample: of each language about `per_language` documents, those with the smallest hash of doc_id, and of
    each of them one slice at a place that depends on the doc_id. All else counts every document.
    """
    known = docs.where("lang is not null and text is not null and doc_id is not null")
    counts = {r.lang: r.n for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    spread = F.pmod(F.xxhash64(F.col("doc_id").cast("long")), F.lit(1 << 32)) / float(1 << 32)
    share = F.coalesce(*[F.when(F.col("lang") == k, 2 * per_language / n) for k, n in counts.items()]) if counts else F.lit(0.0)
    picked = texts_of(known.where(spread < share), F.col("lang"))

    def cut(parts):
        schema = pa.schema([("doc_id", pa.int64()), ("lang", pa.string()), ("slice", pa.binary())])

        def rows():
            for batch in parts:
                for doc_id, text, lang in zip(*(batch[c].to_pylist() for c in ("doc_id", "text", "lang"))):
                    words = plain(text.decode("utf-8", "replace"))
                    at = doc_id * 7919 % max(1, len(words) - slice_bytes)
                    at = words.rfind(b" ", 0, at) + 1
                    yield {"doc_id": doc_id, "lang": lang, "slice": words[at:at + slice_bytes].rpartition(b" ")[0]}
        yield from batches(rows(), schema)

    found: dict[str, list] = {}
    for r in picked.mapInArrow(cut, "doc_id long, lang string, slice binary").collect():
        found.setdefault(r.lang, []).append((int(r.doc_id) * 2654435761 % (1 << 32), bytes(r.slice)))
    _without_common(found)
    out = {}
    for lang in sorted(counts, key=lambda k: (-counts[k], k)):
        out[lang] = b" ".join(s for _, s in sorted(found.get(lang, []))[:per_language])[:dictionary_bytes]
    return {k: v for k, v in out.items() if v}


def _without_common(found: dict[str, list]) -> None:
    """Take out runs of three words that slices of several languages have: notices and the like, not language."""
    runs: dict[tuple, set] = {}
    for lang, slices in found.items():
        for _, text in slices:
            words = text.split()
            for run in zip(words, words[1:], words[2:]):
                runs.setdefault(run, set()).add(lang)
    for slices in found.values():
        for i, (order, text) in enumerate(slices):
            words = text.split()
            common = [len(runs[run]) > 1 for run in zip(words, words[1:], words[2:])]
            gone = {k + j for k, c in enumerate(common) if c for j in range(3)}
            slices[i] = (order, b" ".join([w for k, w in enumerate(words) if k not in gone]))


class Classifier:
    """Compressed sizes under each dictionary."""

    def __init__(self, dictionaries: dict[str, bytes]):
        self.languages = list(dictionaries)
        self.compressors = []
        self.triples: list[Counter] = []
        for content in dictionaries.values():
            held = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            held.precompute_compress(level=LEVEL)
            self.compressors.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=held, write_content_size=False,
                                                             write_checksum=False))
            self.triples.append(Counter(zip(content, content[1:], content[2:])))

    def _bytes_by_triples(self, words: bytes) -> np.ndarray:
        """What the text takes by the share of its triples of bytes in each dictionary; unseen ones cost all the same."""
        padded = b" " + words + b" "
        own = Counter(zip(padded, padded[1:], padded[2:]))
        return np.array([-sum(n * math.log2(max(UNSEEN, held[t] / held.total())) for t, n in own.items()) / 8 for held in self.triples])

    def classify(self, text: bytes) -> tuple[str, float, float]:
        """Language, score (0 to 1) and margin: what the second best needs more, as a share of the best size."""
        words = plain(text.decode("utf-8", "replace"))
        if not self.compressors or not any(c.isalpha() for c in words.decode()):
            return UNKNOWN, 0.0, 0.0
        sizes = np.zeros(len(self.compressors))
        for at in range(0, len(words), BLOCK_BYTES):
            block = words[at:at + BLOCK_BYTES]
            sizes += [len(c.compress(block)) for c in self.compressors]
        if len(sizes) > 1 and np.diff(np.sort(sizes)[:2])[0] <= NO_EVIDENCE:
            sizes += self._bytes_by_triples(words)
        best = int(np.argmin(sizes))
        others = np.delete(sizes, best) - sizes[best]
        warmth = 2 + math.sqrt(len(words)) / 4
        score = 1 / (1 + float(np.exp(-others / warmth).sum()))
        return self.languages[best], score, float(others.min() / sizes[best]) if len(others) else 1.0


def identify(docs: DataFrame, dictionaries: dict[str, bytes]) -> DataFrame:
    """doc_id, lang_pred, score and margin of every row; `und` where a text is null or has no letter.

    docs: doc_id, text; other columns are ignored. Repeated rows give repeated results; a null doc_id stays null; an
    empty table gives an empty result. Without dictionaries all is `und`. Dictionaries have a bounded size each.
    """
    held = docs.sparkSession.sparkContext.broadcast(dictionaries)
    schema = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64()), ("margin", pa.float64())])

    def predict(parts):
        classifier = Classifier(held.value)

        def rows() -> Iterator[dict]:
            for batch in slices(parts):
                for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist()):
                    lang, score, margin = classifier.classify(text)
                    yield {"doc_id": doc_id, "lang_pred": lang, "score": score, "margin": margin}
        yield from batches(rows(), schema)

    return texts_of(docs).mapInArrow(predict, "doc_id long, lang_pred string, score double, margin double")


def accepted(docs: DataFrame, dictionaries: dict[str, bytes], least_margin: float) -> DataFrame:
    """Rows of `docs` whose language is known with at least this margin, all columns unchanged.

    A null or empty text, or one without letters, goes, and so does every row if there are no dictionaries; repeated
    rows stay or go together, whatever their doc_id; an empty table gives an empty result. Only texts go to Python and
    one boolean a row comes back.
    """
    held = docs.sparkSession.sparkContext.broadcast(dictionaries)

    @F.arrow_udf("boolean")
    def known(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        forget()
        classifier = Classifier(held.value)
        for texts in parts:
            found = (classifier.classify(t.as_py()) for t in texts)
            yield pa.array([lang != UNKNOWN and margin >= least_margin for lang, _, margin in found], pa.bool_())

    return docs.where(known(F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")))
