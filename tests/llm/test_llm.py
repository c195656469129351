"""The text operators: odd rows, brute force on small tables, round trips and held-out accuracy."""

import hashlib
import itertools
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from opinara.llm import (byte_bpe, components, exact_dedup, fingerprints, language, licenses, ngram_join, packing, quality,
                         queries, token_counts, token_ids, toxicity)
from opinara.llm.shingles import LONG_WORD, STRETCH, WordHashes, shingle_set, word_hashes
from tests.duck import connect, difference

SCHEMA = "doc_id long, text string, digest string, key int, stats int, score string, file string"
ODD = [None, "", " \t\n", "one", "two  words", "TWO words", "x" * 70_000, "word " * 20_000, "é" * 50 + "\n" + "ñandú 中文 " * 9,
       "<|endoftext|> it's 12!! a\n\n \n b", "The MIT License. GNU General Public License, CC BY", "one"]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, "d", 1, 2, "s", "f") for i, t in enumerate(ODD)]
    return spark.createDataFrame([*rows, rows[4], rows[3], (None, "one", "d", 1, 2, "s", "f"), (None, None, None, None, None, None, None)], SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def operators():
    model = quality.fit(np.zeros((0, len(quality.STATISTICS))), np.zeros(0))
    tox = toxicity.train([b"a b", b"c d"], [0, 1])
    return {
        "ngram_join": lambda d: ngram_join.near_duplicates(d, 3, 90), "quality": lambda d: quality.scored(d, model),
        "language": lambda d: language.identify(d, {"en": b"the and one two word", "es": b"el y uno dos palabra"}),
        "licenses": licenses.scan, "token_counts": lambda d: token_counts.token_counts(d, queries.WORD_BPE, 100),
        "exact_dedup": exact_dedup.copies, "byte_bpe": lambda d: byte_bpe.encoded(d, queries.BYTE_BPE, P.PATTERN),
        "toxicity": lambda d: toxicity.scored(d, tox), "packing": lambda d: packing.pack(d, queries.WORD_BPE, 64),
        "fingerprints": fingerprints.fingerprints}


@pytest.mark.parametrize("name", list(operators()))
def test_odd_rows_and_empty_tables(odd, none, name):
    run = operators()[name]
    rows = run(odd).toPandas()
    assert run(none).count() == 0
    if name == "packing":
        rows = rows[rows.piece == 0]
    assert len(rows) == odd.count()
    assert Counter(rows.doc_id.dropna().astype(int)) == Counter({i: 1 + (i in (3, 4)) for i in range(len(ODD))})
    if name not in ("packing", "exact_dedup", "fingerprints"):
        stable = rows.drop(columns=[c for c in rows if c in ("ids", "decoded", "prefix_counts")])
        assert stable[stable.doc_id == 4].drop_duplicates().shape[0] == 1


def test_untrained_models(spark, none, odd):
    labels = spark.createDataFrame([], "doc_id long, label int")
    for learn, scored in ((quality.learn, quality.scored), (toxicity.learn, toxicity.scored)):
        scores = scored(odd, learn(none, labels)).toPandas().score
        assert scores.between(0, 1).all() and scores.nunique() == 1
    assert set(language.identify(odd, language.learn(none.withColumn("lang", F.lit(None).cast("string")))).toPandas().lang_pred) == {"und"}


# --- joins and duplicates -----------------------------------------------------------------------------------------

def brute_components(texts: dict, k: int, percent: int) -> tuple[dict, dict]:
    sets = {}
    for i, t in texts.items():
        w = (t or "").encode().lower().split()
        sets[i] = {tuple(w[j:j + k]) for j in range(max(1, len(w) - k + 1))} if w else set()
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in itertools.combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    return {i: root(i) for i in sets}, {i: len(s) for i, s in sets.items()}


def near_copies(seed: int, groups: int = 6, size: int = 30) -> dict:
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    out = {}
    for _ in range(groups):
        base = rng.choices(words, k=rng.randint(20, 120))
        for _ in range(rng.randint(1, size)):
            w = list(base)
            for _ in range(rng.randint(0, 6)):
                w[rng.randrange(len(w))] = rng.choice(words)
            out[len(out)] = " ".join(w[:len(w) - rng.randint(0, 2)])
    ids = list(range(len(out)))
    rng.shuffle(ids)
    return dict(zip(ids, out.values()))


@pytest.mark.parametrize("seed, words, percent", [(1, 3, 90), (2, 5, 80), (3, 3, 90)])
def test_join_equals_brute_force(spark, monkeypatch, seed, words, percent):
    monkeypatch.setattr(ngram_join, "LIST_BLOCK", 7)  # long lists are worked on in blocks
    texts = near_copies(seed)
    rows = ngram_join.near_duplicates(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), words, percent).collect()
    expected, sizes = brute_components(texts, words, percent)
    assert {r.doc_id: r.component_id for r in rows} == expected
    assert {r.doc_id: r.n_shingles for r in rows} == sizes


def test_one_large_group_of_near_copies(spark):
    texts = near_copies(9, groups=1, size=1) | {}
    base = list(texts.values())[0].split() * 2
    rng = random.Random(3)
    for i in range(300):
        w = list(base)
        for _ in range(rng.randint(0, 5)):
            w[rng.randrange(len(w))] = f"v{rng.randrange(50)}"
        texts[i] = " ".join(w)
    rows = ngram_join.near_duplicates(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), 3, 90).collect()
    assert {r.doc_id: r.component_id for r in rows} == brute_components(texts, 3, 90)[0]


@pytest.mark.parametrize("block, columns", [(256, 4096), (7, 50)])
def test_links_are_counted_as_brute_force_does(spark, monkeypatch, block, columns):
    monkeypatch.setattr(ngram_join, "LINK_BLOCK", block)
    monkeypatch.setattr(ngram_join, "LINK_COLUMNS", columns)
    texts = near_copies(4, groups=4, size=60)
    texts |= {1000 + i: t for i, t in list(texts.items())[::5]} | {2000: "", 2001: None, 2002: "alone here"}
    sets = {i: {tuple(w[j:j + 3]) for j in range(max(1, len(w) - 2))} if (w := (t or "").split()) else set() for i, t in texts.items()}
    expected = Counter()
    for a, b in itertools.combinations(sets, 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
            expected.update((a, b))
    rows = ngram_join.near_duplicates(spark.createDataFrame([*texts.items(), (None, "alone here")], "doc_id long, text string"), 3, 80, True)
    got = {r.doc_id: r.n_links for r in rows.collect()}
    assert max(expected.values()) > ngram_join.SHORT_LIST
    assert got == {i: expected[i] for i in texts} | {None: 0}


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 90), (90, 95)], "a long, b long")
    got = {r.node: r.component for r in components.components(edges).collect()}
    assert got == {i: 0 for i in range(41)} | {90: 90, 95: 90, 100: 90}


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_equals_sql(spark, sf, name):
    assert difference(queries.QUERIES[name](spark, sf), connect(sf), queries.ORACLE[name]) == ""


def test_dedup_over_several_batches(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").repartition(5)
    docs = docs.union(docs.withColumn("doc_id", F.col("doc_id") + 1000))
    once, often = (exact_dedup.copies(docs, n).drop("file", "row").toPandas().sort_values("doc_id").reset_index(drop=True) for n in (None, 2))
    assert once.equals(often) and (once.keep_id < 1000).all() and (once.group_size >= 2).all()


def test_dedup_tells_texts_of_one_digest_apart(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup.F, "sha2", lambda c, bits: F.substring(c, 1, 1))  # a digest that collides
    texts = {1: "ab", 2: "ac", 3: "ab", 4: "ac", 5: "b"}
    rows = exact_dedup.copies(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()
    assert {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in rows} == {
        1: (1, 2, True), 2: (2, 2, True), 3: (1, 2, False), 4: (2, 2, False), 5: (5, 1, True)}


# --- tokens -------------------------------------------------------------------------------------------------------

WORDS = ["don't we'rest it's've 123 a b !!!'s ", "ÜNÏ Å é İstanbul ΣΑΣ\x1cy", "a<|endoftext|>b", "中文字 12ab ------====",
         "hahahahaha aaaaaaaaaaa Internationalization"]


def test_counts_at_every_prefix():
    library, counts = Tokenizer.from_file(queries.WORD_BPE), token_counts.PrefixCounts(queries.WORD_BPE)
    for text in WORDS:
        steps = next(counts.texts([text.encode()]))
        stored = zlib.compress(steps.tobytes())
        for i in range(1, len(text) + 1):
            n = len(text[:i].encode())
            expected = len(library.encode(text[:i], add_special_tokens=False).ids)
            assert token_counts.tokens_within(stored, n) == expected, text[:i]
        assert token_counts.longest_prefix(steps, 10 ** 6) == len(text.encode())


def test_token_queries_equal_the_libraries(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").toPandas()
    library = Tokenizer.from_file(queries.WORD_BPE)
    ids = {r.doc_id: library.encode(r.text, add_special_tokens=False).ids for r in docs.itertuples()}
    for r in queries.QUERIES["op5_token_counts"](spark, sf_small).collect():
        assert (r.n_tokens, r.over_limit) == (len(ids[r.doc_id]), len(ids[r.doc_id]) > 2048)
    encoding = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=byte_bpe.read_ranks(queries.BYTE_BPE), special_tokens={})
    texts = dict(zip(docs.doc_id, docs.text))
    for r in queries.QUERIES["op7_byte_bpe"](spark, sf_small).collect():
        expected = np.array(encoding.encode_ordinary(texts[r.doc_id]), "<u4")
        assert r.n_tokens == len(expected) and r.ids_sha256 == hashlib.sha256(expected.tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
    places = defaultdict(list)
    for r in queries.QUERIES["op9_best_fit_packing"](spark, sf_small).collect():
        piece = (ids[r.doc_id] + [1])[r.start:r.start + r.length]
        assert r.ids_crc32 == zlib.crc32(np.array(piece, "<u4").tobytes()) and r.start == 4096 * r.piece
        places[r.sequence_id].append((r.offset, r.length))
    for held in places.values():
        held.sort()
        assert [o for o, _ in held] == [sum(n for _, n in held[:i]) for i in range(len(held))] and sum(n for _, n in held) <= 4096
    assert len(places) <= 1.01 * sum(len(i) + 1 for i in ids.values()) / 4096 + 1


def test_byte_bpe_on_random_strings():
    ranks = byte_bpe.read_ranks(queries.BYTE_BPE)
    encoding, own = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={}), byte_bpe.ByteBPE(queries.BYTE_BPE, P.PATTERN)
    rng = random.Random(4)
    signs = [" ", " ", "\n", "\t", "a", "b", "'s", "1", "!", "é", " ", "\x1c", "　"]
    texts = ["".join(rng.choices(signs, k=rng.randint(1, 12))) for _ in range(4000)] + ["ab" * 3000 + " " * 2000, "a" * 1500]
    for text, ids in zip(texts, own.encode(texts)):
        assert ids.tolist() == encoding.encode_ordinary(text)
        assert own.decode(ids) == text.encode()


def test_packing_plan_uses_every_piece_once():
    rng = random.Random(5)
    for capacity in (8, 50, 4096):
        counts = {rng.randint(1, capacity - 1): rng.randint(1, 60) for _ in range(200)}
        uses = packing.plan(counts, capacity)
        used = Counter()
        for times, lengths in uses:
            assert times > 0 and sum(lengths) <= capacity
            for x in lengths:
                used[x] += times
        assert used == Counter(counts)


def test_a_pair_that_cannot_be_used_does_not_hide_others():
    assert packing.exact_fills({60: 1, 25: 1, 20: 1, 15: 1}, 100) == [(1, (60, 25, 15))]


# --- models -------------------------------------------------------------------------------------------------------

def test_models_on_held_out_documents(spark):
    sf = "/root/testdata/sf0.1"
    truth = spark.read.parquet(f"{sf}/labels.parquet").toPandas().set_index("doc_id")
    q = queries.QUERIES["op2_quality_classifier"](spark, sf).toPandas().set_index("doc_id").join(truth, how="inner")
    t = queries.QUERIES["op8_toxicity"](spark, sf).toPandas().set_index("doc_id").join(truth, how="inner")
    q, t = q[q.held_out], t[t.held_out]
    assert (q.predicted == q.quality).mean() > 0.97
    assert t[t.toxic == 1].predicted.mean() > 0.85 and t[t.toxic == 0].predicted.mean() < 0.03
    lang = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang").toPandas().set_index("doc_id")
    found = queries.QUERIES["op3_language_id"](spark, sf).toPandas().set_index("doc_id").join(lang)
    found = found[found.held_out]
    assert (found.lang_pred == found.lang).mean() > 0.98


def test_network_gradients():
    rng = np.random.default_rng(0)
    net = toxicity.Network()
    x, real = rng.standard_normal((6, 4, toxicity.INPUTS)).astype("f4"), np.ones((6, 4), bool)
    real[4:, 1] = False
    y = np.array([0, 1, 1, 0], "f4")
    _, g = net.gradients(x, real, y)
    for name, value in net.p.items():
        at = (0,) * value.ndim
        before, losses = value[at], []
        for step in (0.01, -0.01):
            value[at] = before + step
            losses.append(net.gradients(x, real, y)[0])
        value[at] = before
        assert abs((losses[0] - losses[1]) / 0.02 - g[name][at]) < 2e-4, name


def test_compiled_rules_equal_numpy(spark):
    rng = np.random.default_rng(2)
    x = rng.random((400, len(quality.STATISTICS)))
    model = quality.fit(x, ((x[:, 1] > 0.5) & (x[:, 2] < 0.7)).astype(float))
    assert 0 < len(model.rules) < 60
    odds = model.bias + sum(w * quality._holds(x, r) for w, r in zip(model.weights, model.rules))
    got = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "i long, stats array<double>") \
        .select("i", model.score(F.col("stats")).alias("s")).toPandas().sort_values("i").s
    assert np.allclose(got, 1 / (1 + np.exp(-odds)))


# --- licences and fingerprints ------------------------------------------------------------------------------------

def test_template_scan_equals_brute_force(spark):
    rng = random.Random(6)
    vocabulary = sorted({w for t in licenses.TEMPLATES.values() for w in t.split()}) + ["foo", "bar"]
    texts = []
    for i in range(150):
        t = rng.choice(list(licenses.TEMPLATES.values())).split()
        for _ in range(rng.randint(0, 3)):
            t.insert(rng.randrange(len(t)), rng.choice(vocabulary)) if rng.random() < 0.5 else t.pop(rng.randrange(len(t)))
        texts.append(" ".join(rng.choices(vocabulary, k=rng.randint(0, 30)) + t + rng.choices(vocabulary, k=rng.randint(0, 30))))
    got = {r.doc_id: r for r in licenses.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), 0.8).collect()}
    for i, text in enumerate(texts):
        words = text.lower().split()
        base = [(k, label) for k in range(len(words)) for p, label in licenses.PHRASES.items() if words[k:k + len(p.split())] == p.split()]
        labels = {label for _, label in base}
        for label, template in licenses.TEMPLATES.items():
            t = set(template.split())
            width = -int(-licenses.WIDTH * len(t) // 1)
            if any(len(t & set(words[k:k + width])) >= 0.8 * len(t) - 1e-9 for k in range(len(words))):
                labels.add(label)
        assert got[i].n_base == len(base) and got[i].labels == ",".join(sorted(labels)), text
        assert (got[i].first_word, got[i].last_word) == ((base[0][0], base[-1][0]) if base else (None, None))


PUBLISHED = {
    "apache-2.0-terms": """Copyright 2024 Example Authors

        Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the
        License. You may obtain a copy of the License at

            http://www.apache.org/licenses/LICENSE-2.0

        Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an
        "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.""",
    "bsd-terms": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that
        the following conditions are met:
        1. Redistributions of source code must retain the above copyright notice.""",
    "all-rights-reserved": "Copyright (c) 1990, 1993 The Regents of the University of California. All rights reserved.",
    "gpl-terms": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General
        Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any
        later version.""",
    "isc-terms": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
        granted, provided that the above copyright notice and this permission notice appear in all copies.""",
    "mit-terms": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
        documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
        rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software""",
    "mpl-2.0-notice": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL
        was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.""",
    "cc-long-notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "public-domain": "This is free and unencumbered software released into the public domain.",
}


def test_published_notices_are_found_at_the_threshold_of_op4(spark):
    rows = [(i, "Some prose before. " + text + " And some after.") for i, text in enumerate(PUBLISHED.values())]
    got = {r.doc_id: set(r.labels.split(",")) for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [label for i, label in enumerate(PUBLISHED) if label not in got[i]] == []


def test_every_notice_of_a_text_is_a_block(spark):
    notice, filler = PUBLISHED["apache-2.0-terms"], "foo bar baz " * 40
    docs = spark.createDataFrame([(1, filler + notice + filler + notice + filler + PUBLISHED["isc-terms"]), (2, filler), (3, None)],
                                 "doc_id long, text string")
    rows = sorted(licenses.blocks(docs).collect(), key=lambda r: r.start)
    assert [(r.label, r.containment) for r in rows if r.label in PUBLISHED] == [
        ("apache-2.0-terms", 1.0), ("apache-2.0-terms", 1.0), ("isc-terms", 1.0)]
    words = licenses.words_of(docs.where("doc_id = 1").first().text.encode())
    for r in rows:
        assert {w.encode() for w in licenses.TEMPLATES[r.label].split()} <= set(words[r.start:r.end])
    got = {r.doc_id: r for r in licenses.scan(docs).collect()}
    assert (got[1].n_blocks, got[1].first_block, got[1].last_block) == (len(rows), rows[0].start, rows[-1].start)
    assert got[1].blocks_sha256 == licenses.digest_of([(r.label, r.start, r.end, r.containment) for r in rows])
    assert got[2].n_blocks == got[3].n_blocks == 0 and got[3].first_block is None


def test_blocks_equal_brute_force():
    rng = random.Random(8)
    for _ in range(3000):
        size, width = rng.randint(1, 5), rng.randint(5, 9)
        need = rng.randint(1, size)
        words = [rng.choice("abcdexyz").encode() for _ in range(rng.randint(0, 30))]
        template = {c.encode() for c in "abcde"[:size]}
        got = list(licenses._blocks(words, [i for i, w in enumerate(words) if w in template], need, width))
        share = lambda i, j: len(template & set(words[i:j]))
        most = [0] * (len(words) + 1)  # most blocks side by side in the first words
        for j in range(1, len(words) + 1):
            most[j] = max([most[j - 1]] + [most[i] + 1 for i in range(max(0, j - width), j) if share(i, j) >= need])
        assert len(got) == most[-1]
        assert all(need <= n == share(i, j) and j - i <= width for i, j, n in got)
        assert all(a[1] <= b[0] for a, b in zip(got, got[1:]))


def test_fingerprints_add_up_in_any_order():
    memo, of = WordHashes(), fingerprints.Fingerprint.of
    parts = [b"one two three four", b"five", b"six seven eight", b"one two three four"]
    whole = of(b"\n".join(parts), memo)
    assert str(sum((of(p, memo) for p in reversed(parts)), fingerprints.Fingerprint())) == str(whole)
    assert str(whole - of(b"five", memo)) == str(of(b"\n".join([parts[3], parts[0], parts[2]]), memo))
    assert str(whole) != str(of(b"\n".join(parts[:3]), memo)) and whole.likeness(whole) == 1.0


def test_likeness_of_texts_with_very_many_equal_runs():
    memo, of, rng = WordHashes(), fingerprints.Fingerprint.of, random.Random(7)
    other = " ".join(f"w{rng.randrange(5000)}" for _ in range(100_000))
    for n in (20_000, 50_000, 70_000, 200_000):
        text = "spam " * n
        changed = fingerprints.edited(text, other)
        assert 0.9 < of(text.encode(), memo).likeness(of(changed.encode(), memo)) <= 1.0


def test_edited_texts_follow_descending_ids(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").toPandas().sort_values("doc_id", ascending=False)
    texts = docs.text.tolist()
    expected = {i: hashlib.sha256(fingerprints.edited(a, b).encode()).hexdigest()
                for i, a, b in zip(docs.doc_id, texts, texts[1:] + texts[:1])}
    rows = queries.QUERIES["op10_document_fingerprints"](spark, sf_small).toPandas()
    assert dict(zip(rows.doc_id, rows.edited_sha256)) == expected
    assert rows.near_edited.mean() > 0.4 and rows.near_next.mean() < 0.1
    assert rows.merge(docs, on="doc_id").groupby("text").fingerprint.nunique().max() == 1


# --- pipeline -----------------------------------------------------------------------------------------------------

def test_pipeline_keeps_one_of_each_and_all_that_is_clean(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    columns, held = docs.columns, [docs]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        held.append(corpus_pipeline.stored(stage(spark, held[-1], sf_small)))
        assert held[-1].columns == columns and held[-1].exceptAll(held[-2]).count() == 0
    languages, good, single, apart = (h.toPandas() for h in held[1:])
    assert len(languages) > 0.97 * docs.count()
    truth = spark.read.parquet(f"{sf_small}/labels.parquet").toPandas().set_index("doc_id").quality
    # The model learns from about 70 labels here.
    assert truth.reindex(languages.doc_id).dropna().mean() < truth.reindex(good.doc_id).dropna().mean() > 0.95
    key = lambda t: " ".join(t.split())
    assert sorted(single.doc_id) == sorted(good.assign(k=good.text.map(key)).groupby("k").doc_id.min())
    parents, _ = brute_components(dict(zip(single.doc_id, single.text)), 5, 80)
    assert sorted(apart.doc_id) == sorted(set(parents.values()))
    packed = corpus_pipeline.STAGES[-1][1](spark, held[-1], sf_small).toPandas()
    assert set(packed.doc_id) == set(apart.doc_id)


def test_short_documents_of_a_learnt_language_stay(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    short = docs.where("length(text) between 4 and 60 and lang is not null").cache()
    known = queries.dictionaries(docs)
    for some in (short, short.where(queries.fold(4) == 2)):  # the second: not learnt from
        assert language.accepted(some, known, corpus_pipeline.LEAST_MARGIN).count() == some.count() > 0
    other = spark.createDataFrame([(1, "中文字"), (2, "1 2 3"), (3, None)], "doc_id long, text string")
    assert language.accepted(other, known, corpus_pipeline.LEAST_MARGIN).count() == 0


def test_a_run_of_common_shingles_gives_a_pair_once():
    def found(before):
        rows = {"sid": [1, 2] * 3, "n": [50] * 6, "pos": [0, 0, 1, 1, 2, 2], "before": before, "comp": [1, 2] * 3,
                "block": [0] * 6, "cross": [0] * 6, "bits": [bytes(64)] * 6}
        return sum(len(a) for a, _ in ngram_join._Lists(pa.table(rows), 80).pairs(np.array([0, 2, 4]), True))

    assert found([0, 0, 10, 10, 11, 11]) == 1
    assert found([0, 0, 10, 9, 11, 11]) == 2  # another shingle lies between in one of them
    assert found([0, 0, 0, 0, 11, 12]) == 2


def test_word_hashes_do_not_depend_on_place_or_neighbours():
    """Words keep their hash wherever a stretch of a long text ends, and different words differ."""
    random.seed(5)
    words = [bytes(random.choices(b"ABab\x00\xc3\xa9.1", k=random.randint(1, 9))) for _ in range(60_000)]
    words += [b"q" * n for n in (LONG_WORD - 1, LONG_WORD, LONG_WORD + 1, STRETCH - 1, STRETCH, STRETCH + 1, 3 * STRETCH)]
    seen: dict[bytes, int] = {}
    for gap in (b" ", b"\t\n", b" \x0b\x0c\r "):
        random.shuffle(words)
        for text in (gap.join(words), gap + gap.join(words[:50]) + gap, words[0], b"", gap):
            split = text.lower().split()
            hashes = word_hashes(text).tolist()
            assert len(hashes) == len(split)
            assert all(seen.setdefault(w, h) == h for w, h in zip(split, hashes))
    assert len(set(seen.values())) == len(seen)


@pytest.mark.parametrize("text,size", [(b"", 0), (b" \n", 0), (b"one", 1), (b"a b", 1), (b"a b c", 1), (b"a a a a", 1),
                                       (b"a b c a b c", 3), (b"A b C a B c", 3)])
def test_shingle_sets(text, size):
    found = shingle_set(text, 3)
    assert len(found) == size and (np.diff(found.astype(object)) > 0).all()


def test_memos_forget_by_bytes_and_stay_exact():
    texts = [f"Word{i}, word é{i}É!! {'lines ' * (i % 7)}it's <|endoftext|> ab. Ab. ab".encode() for i in range(300)]
    library = Tokenizer.from_file(queries.WORD_BPE)
    want = [library.encode(t.decode(), add_special_tokens=False).ids for t in texts]
    ids, counts = token_ids.ChunkIds(queries.WORD_BPE, limit_bytes=400), token_counts.PrefixCounts(queries.WORD_BPE, limit_bytes=400)
    assert [x.tolist() for x in ids.encode(texts, group=5)] == want
    assert [int(d.sum(dtype=np.int64)) for d in counts.texts(texts, group=5)] == [len(w) for w in want]
    assert len(ids.young) + len(ids.old) < 200 and len(counts.young) + len(counts.old) < 200


def test_language_stage_on_odd_rows(spark, odd, none):
    held = {"en": b"the and one two word words", "es": b"el y uno dos palabra"}
    kept = language.accepted(odd, held, 0.0)
    assert kept.columns == odd.columns and kept.where("text is null or trim(text) = ''").isEmpty()
    assert kept.where("text = 'one'").count() == 4
    assert language.accepted(none, held, 0.0).isEmpty() and language.accepted(odd, {}, 0.0).isEmpty()


def test_shingle_counts_hold_few_sets_at_a_time(monkeypatch):
    """A worker's memory follows from a slice of a batch, not from the batch."""
    import tracemalloc

    import pyarrow as pa

    from opinara.llm import ngram_join
    kept = []
    monkeypatch.setattr(ngram_join, "fixed_array", lambda df, fill, size: kept.append(fill) or np.zeros(size, np.uint32))

    class Texts:
        def select(self, *_):
            return self
    ngram_join.rank_order(Texts(), 3)
    texts = [b" ".join(b"w%d" % (i * 7 + j * j) for j in range(250)) for i in range(4000)]
    batch, total = pa.record_batch({"text": pa.array(texts, pa.binary())}), np.zeros(1 << ngram_join.BUCKET_BITS, np.uint32)
    tracemalloc.start()
    try:
        kept[0](batch, total)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert total.sum() == sum(len(ngram_join.shingle_set(t, 3)) for t in texts)
    assert peak < 20_000_000


def test_chunks_are_taken_apart_all_at_once():
    """Words and signs of all chunks by one pass over them; ids as the library gives them, also for letters that only become Latin in lower case."""
    from opinara.llm import queries, token_ids
    ids = token_ids.ChunkIds(queries.WORD_BPE)
    chunks = ["\u00c0B!!".encode(), b"a-b", b"Word", b"\xff\xfe", "\u212aelvin".encode(), b"(x)", b"cut\xc3", b"end..."]
    assert ids._parts(chunks) == [["\u00e0b".encode(), b"", b"word", b"", b"", b"", b"", b"end"], [b"!!", b"", b"", b"", b"", b"", b"", b"..."]]
    assert ids._parts([]) == [[], []]
    library = Tokenizer.from_file(queries.WORD_BPE)
    for text in (b" ".join(chunks), b"", b"only", b"a\x00b \x00 !"):
        assert next(ids.encode([text])).tolist() == library.encode(text.decode("utf-8", "replace"), add_special_tokens=False).ids


def test_a_worker_drops_what_it_learnt_for_the_stage_before():
    """The next stages of the pipeline run in the same worker processes as the encoding of texts."""
    from opinara.llm import common, queries, token_ids
    batch = pa.RecordBatch.from_pydict({"text": [b"a b"] * 450})
    token_ids.chunk_ids(queries.WORD_BPE)
    assert token_ids.chunk_ids.cache_info().currsize == 1
    assert [b.num_rows for b in common.slices([batch])] == [200, 200, 50]
    assert token_ids.chunk_ids.cache_info().currsize == 0


def test_packing_with_a_small_memo(spark):
    rng = random.Random(8)
    rows = [(i, " ".join(rng.choice("abcdefgh") * rng.randint(1, 9) + str(rng.randint(0, 99)) for _ in range(30))) for i in range(500)]
    docs = spark.createDataFrame([*rows, (500, None), (501, "")], "doc_id long, text string").coalesce(1)
    few, many = (packing.pack(docs, queries.WORD_BPE, capacity=64, **k).drop("sequence_id", "offset") for k in ({"memo": 20}, {}))
    assert sorted(few.collect()) == sorted(many.collect())


def test_a_worker_that_encodes_keeps_what_it_learnt_and_few_texts():
    from opinara.llm import common
    batch = pa.RecordBatch.from_pydict({"text": [b"a b"] * 450})
    ids = token_ids.chunk_ids(queries.WORD_BPE, 100)
    assert [b.num_rows for b in common.slices([batch], encodes=True)] == [200, 200, 50]
    assert token_ids.chunk_ids(queries.WORD_BPE, 100) is ids
    for at in range(0, 4000, 200):
        list(ids.encode([b"w%d" % (at + i) for i in range(200)]))
    assert len(ids.young) + len(ids.old) < 2000  # limit and what one group adds, twice
