"""Which license notices a text holds: phrases at exact places, and templates by containment.

A template is a set of words. A block of text is any run of `WIDTH` times as many words as the template has. It matches
if it holds at least `threshold` of the template's words. Words are ordered by how often the whole corpus has them,
rarest first: a block with enough of a template's words holds one of its first few (the prefix), so only blocks around
such words are looked at. A length filter passes over texts shorter than the words needed, a positional filter those
surroundings that hold too few of the template's words in all. What is left is counted exactly. Every notice of a text is
a block of its own, with its place.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinara.llm.common import batches, texts_of

# Phrases and their labels.
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
# Words of well-known notices and the labels they get.
TEMPLATES = {
    "agpl-notice": "licensed under the gnu affero general public license version 3",
    "all-rights-reserved": "copyright all rights reserved",
    "apache-2.0-notice": "licensed under the apache license version 2 0",
    "apache-2.0-terms": "you may not use this file except in compliance with the license unless required by applicable law "
                        "or agreed to in writing software distributed under the license is distributed on an as is basis",
    "bsd-terms": "redistribution and use in source and binary forms with or without modification are permitted provided "
                 "that the following conditions are met",
    "cc-by-notice": "licensed under cc by 4 0",
    "cc-by-nc-notice": "licensed under cc by nc 4 0",
    "cc-by-sa-notice": "licensed under cc by sa 4 0",
    "cc-long-notice": "this work is licensed under a creative commons attribution 4 0 international license",
    "gpl-notice": "this work is licensed under the gnu general public license version 3",
    "gpl-terms": "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
                 "public license as published by the free software foundation",
    "isc-terms": "permission to use copy modify and or distribute this software for any purpose with or without fee is "
                 "hereby granted",
    "mit-notice": "released under the mit license",
    "mit-terms": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
                 "documentation files to deal in the software without restriction",
    "mpl-2.0-notice": "this source code form is subject to the terms of the mozilla public license v 2 0",
    "public-domain": "this is free and unencumbered software released into the public domain",
}
#: Words in a block per word of the template. Published notices spread a template's words: the Apache header puts a web
#: address between them (51 words for 29), a copyright line puts years and a holder (14 words for 4).
WIDTH = 3.5
#: Bytes to words: A-Z becomes a-z, other ASCII signs separate, bytes of other characters belong to words.
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


#: Label, first word, the word after the last, and the share of the template's words that the block holds.
Block = tuple[str, int, int, float]


def digest_of(found: list[Block]) -> str:
    """SHA-256 over the lines `label start end` of blocks ordered by start, end and label."""
    return hashlib.sha256("".join(f"{label} {start} {end}\n" for label, start, end, _ in found).encode()).hexdigest()


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_TABLE).split()


class Templates:
    """Templates with their words in corpus order, rarest first."""

    def __init__(self, templates: dict[str, str], threshold: float, counts: dict[str, int]):
        self.phrases = [([w.encode() for w in p.split()], label) for p, label in PHRASES.items()]
        self.known = {w for p, _ in self.phrases for w in p}
        self.rows, self.by_prefix = [], {}
        for label, text in templates.items():
            words = sorted({w.encode() for w in text.split()}, key=lambda w: (counts.get(w.decode(), 0), w))
            need = math.ceil(threshold * len(words) - 1e-9)
            self.known.update(words)
            for w in words[:len(words) - need + 1]:
                self.by_prefix.setdefault(w, []).append(len(self.rows))
            self.rows.append((label, set(words), need, math.ceil(WIDTH * len(words))))

    def phrase_places(self, words: list[bytes], at: list[int]) -> list[tuple[int, str]]:
        """(start, label) of each place where the words of a phrase stand together."""
        out = []
        for i in at:
            for phrase, label in self.phrases:
                if words[i] == phrase[0] and words[i:i + len(phrase)] == phrase:
                    out.append((i, label))
        return out

    def blocks(self, words: list[bytes], at: list[int]) -> list[Block]:
        """The blocks of all templates that reach the threshold, by start; those of one template do not overlap."""
        starts: dict[int, list[int]] = {}
        for i in at:
            for k in self.by_prefix.get(words[i], ()):
                starts.setdefault(k, []).append(i)
        if not starts:
            return []
        places = np.array(at)
        out = []
        for k, hits in starts.items():
            label, template, need, width = self.rows[k]
            if len(words) < need:
                continue
            cuts = np.flatnonzero(np.diff(hits) >= 2 * width) + 1  # no block holds words of two surroundings
            for some in np.split(np.array(hits), cuts):
                lo, hi = np.searchsorted(places, (some[0] - width + 1, some[-1] + width))
                near = [i for i in at[lo:hi] if words[i] in template]
                if len({words[i] for i in near}) >= need:
                    out += [(label, start, end, n / len(template)) for start, end, n in _blocks(words, near, need, width)]
        return sorted(out, key=lambda x: (x[1], x[2], x[0]))


def _blocks(words: list[bytes], at: list[int], need: int, width: int) -> Iterator[tuple[int, int, int]]:
    """(start, end, distinct words) of blocks with `need` distinct words of those at the places `at`: as many as
    there are side by side.

    From left to right, the next block is where one ends first. Each then becomes the block with most distinct words
    between its neighbours (of several the shortest, of these the first), and goes on over words of the template next
    to it, up to `width` words.
    """
    seeds, held, first = [], Counter(), 0
    for n, i in enumerate(at):
        held[words[i]] += 1
        while i - at[first] >= width:
            _drop(held, words[at[first]])
            first += 1
        if len(held) >= need:
            while held[words[at[first]]] > 1:
                _drop(held, words[at[first]])
                first += 1
            seeds.append((first, n))
            held, first = Counter(), n + 1
    free = 0
    for k, (_, seed_end) in enumerate(seeds):
        stop = seeds[k + 1][0] if k + 1 < len(seeds) else len(at)
        first = free
        while at[seed_end] - at[first] >= width:
            first += 1
        held, best = Counter(), (0, 0, 0, 0)
        for n in range(first, stop):
            if at[n] - at[seed_end] >= width:
                break
            held[words[at[n]]] += 1
            while at[n] - at[first] >= width or held[words[at[first]]] > 1:
                _drop(held, words[at[first]])
                first += 1
            best = max(best, (len(held), at[first] - at[n], -first, n))
        lo, hi = -best[2], best[3]
        while lo > free and at[lo - 1] == at[lo] - 1 and at[hi] - at[lo] + 1 < width:
            lo -= 1
        while hi + 1 < stop and at[hi + 1] == at[hi] + 1 and at[hi] - at[lo] + 1 < width:
            hi += 1
        yield at[lo], at[hi] + 1, best[0]
        free = hi + 1


def _drop(held: Counter, word: bytes) -> None:
    held[word] -= 1
    if not held[word]:
        del held[word]


def word_counts(docs: DataFrame, words: set[str]) -> dict[str, int]:
    """In how many rows of `docs` each of these (few) words occurs."""
    wanted = {w.encode() for w in words}
    schema = pa.schema([("word", pa.string()), ("n", pa.int64())])

    def count(parts):
        total: Counter = Counter()
        for batch in parts:
            for text in batch["text"].to_pylist():
                total.update(wanted.intersection(words_of(text)))
        yield from batches(({"word": w.decode(), "n": n} for w, n in total.items()), schema)

    rows = texts_of(docs).mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    return {r.word: r.n for r in rows}


def _known(docs: DataFrame, threshold: float, templates: dict[str, str] | None) -> Broadcast[Templates]:
    templates = TEMPLATES if templates is None else templates
    counts = word_counts(docs, {w for t in templates.values() for w in t.split()})
    return docs.sparkSession.sparkContext.broadcast(Templates(templates, threshold, counts))


def blocks(docs: DataFrame, threshold: float = 0.92, templates: dict[str, str] | None = None) -> DataFrame:
    """doc_id, label, start, end and containment of every block of text that reaches the threshold.

    docs: doc_id, text; other columns are ignored. start and end are numbers of words, end is not in the block any more.
    Blocks of one label do not overlap, and there are as many as fit side by side, so each notice of a long text has its
    row. A text without any block has no row. Repeated rows give repeated results; a null doc_id stays null.
    """
    held = _known(docs, threshold, templates)
    schema = pa.schema([("doc_id", pa.int64()), ("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
                        ("containment", pa.float64())])

    def find(parts):
        known = held.value

        def rows() -> Iterator[dict]:
            for batch in parts:
                for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist()):
                    words = words_of(text)
                    for block in known.blocks(words, [i for i, w in enumerate(words) if w in known.known]):
                        yield dict(zip(schema.names, (doc_id, *block)))
        yield from batches(rows(), schema)

    return texts_of(docs).mapInArrow(find, "doc_id long, label string, start long, end long, containment double")


def scan(docs: DataFrame, threshold: float = 0.92, templates: dict[str, str] | None = None) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, n_blocks, first_block, last_block and
    blocks_sha256 of every row.

    docs: doc_id, text; other columns are ignored. Base places are those of PHRASES. labels also has those of the
    blocks of the row. score is 1 with a base place, else the largest containment of a block, else 0. first_block and
    last_block are starts; blocks_sha256 is the digest of `digest_of` over the row's blocks, which `blocks` lists. A null
    text is empty: no words, no labels (empty strings), null places. Repeated rows give repeated results; a null doc_id
    stays null; an empty table gives an empty result.
    """
    held = _known(docs, threshold, templates)
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()),
                        ("last_word", pa.int64()), ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()),
                        ("n_blocks", pa.int64()), ("first_block", pa.int64()), ("last_block", pa.int64()), ("blocks_sha256", pa.string())])

    def find(parts):
        known = held.value

        def rows() -> Iterator[dict]:
            for batch in parts:
                for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist()):
                    words = words_of(text)
                    at = [i for i, w in enumerate(words) if w in known.known]
                    base = known.phrase_places(words, at)
                    found = known.blocks(words, at)
                    labels = {label for _, label in base}
                    yield {"doc_id": doc_id, "n_words": len(words), "n_base": len(base),
                           "first_word": base[0][0] if base else None, "last_word": base[-1][0] if base else None,
                           "base_labels": ",".join(sorted(labels)), "labels": ",".join(sorted(labels | {b[0] for b in found})),
                           "score": 1.0 if base else max((b[3] for b in found), default=0.0),
                           "n_blocks": len(found), "first_block": found[0][1] if found else None,
                           "last_block": found[-1][1] if found else None, "blocks_sha256": digest_of(found)}
        yield from batches(rows(), schema)

    return texts_of(docs).mapInArrow(find, "doc_id long, n_words long, n_base long, first_word long, last_word long, "
                                           "base_labels string, labels string, score double, n_blocks long, first_block long, "
                                           "last_block long, blocks_sha256 string")
