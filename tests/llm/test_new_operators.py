"""Ranked search, tokenizer alignment and the web archive: odd rows, brute force, exact round trips."""

import hashlib
import math
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from opinara.llm import alignment, exact_dedup, queries, search, warc
from tests.duck import connect, difference

ODD = [None, "", " \t\n", "one", "two  words", "TWO words", "x" * 70_000, "word " * 20_000, "é" * 50 + "\n" + "ñandú 中文 " * 9,
       "<|endoftext|> it's 12!! a\n\n \n b <s> </s>", "a \n b c \x1c d", "▁piece a▁b", "ﬁne ́ é", "one", "  two　x  ",
       "tab\tand\r\nline\n", "\nfirst", "\x00nul \x7f", "🙂🙂 emoji🙂", "don't WON'T 'S's"]
SCHEMA = "doc_id long, text string, item long, score string, pairs string, n long, rank string, part string"


def frame(spark, texts):
    return spark.createDataFrame([(i, t, 1, "s", "p", 2, "r", "q") for i, t in texts], SCHEMA)


@pytest.fixture(scope="module")
def odd(spark):
    return frame(spark, [*enumerate(ODD), (3, "one"), (3, "one"), (None, "one"), (None, None)])


@pytest.mark.parametrize("name", ["op11_ranked_search", "op13_warc_archive"])
def test_query_equals_its_sql(spark, sf, name):
    assert difference(queries.QUERIES[name](spark, sf), connect(sf), queries.ORACLE[name]) == ""


# --- search -------------------------------------------------------------------------------------------------------

def brute_search(docs, items, k):
    """Straight from the definition, document by document."""
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    words = [(i, Counter(w := split(t)), len(w)) for i, t in docs]
    n_docs, n_terms = sum(n > 0 for *_, n in words), sum(n for *_, n in words)
    df = Counter(t for _, c, _ in words for t in c)
    out = []
    for item, text in items:
        found = []
        for doc_id, c, n in words:
            m = 75 + (25 * n * n_docs) // max(1, n_terms)
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m))
                        for t in split(text) if c[t])
            if score > 0:
                found.append((-score, doc_id is None, doc_id or 0))
        out += [(item, rank, None if none else d, -s) for rank, (s, none, d) in enumerate(sorted(found)[:k], 1)]
    return Counter(out)


ITEMS = [(1, "one word TWO"), (2, None), (3, ""), (4, "ñandú é"), (5, "one one word word word"), (None, "it's 12"), (1, "one word TWO"), (7, "absent")]


@pytest.mark.parametrize("most_items, k", [(1024, 20), (2, 3)])
def test_search_equals_brute_force(spark, odd, most_items, k):
    items = spark.createDataFrame([(i, t, "x") for i, t in ITEMS], "item_id long, text string, doc_id string")
    rows = search.ranked(odd, items, k, most_items=most_items).collect()
    docs = [(r.doc_id, r.text) for r in odd.collect()]
    assert Counter(tuple(r) for r in rows) == brute_search(docs, ITEMS, k)


def test_search_in_small_steps(spark, odd, monkeypatch):
    monkeypatch.setattr(search, "SCORES_AT_ONCE", 5)
    index = search.Index([b"one word", b"two"])
    scorer = search.Scorer(index, np.array([7, 5, 3]), 10, 100)
    texts = [b"one one two", b"", b"word", b"two two word one"]
    steps = list(scorer.scores(texts))
    assert [at for at, _ in steps] == [0, 2, 3] or len(steps) > 1
    monkeypatch.undo()
    whole = np.concatenate([s for _, s in scorer.scores(texts)])
    assert (np.concatenate([s for _, s in steps]) == whole).all()


def test_search_with_ties_and_empty_tables(spark):
    docs = spark.range(500).select((500 - F.col("id")).alias("doc_id"), F.lit("same words").alias("text")).repartition(7)
    items = spark.createDataFrame([(1, "same")], "item_id long, text string")
    rows = search.ranked(docs.union(spark.createDataFrame([(1000, "others")], docs.schema)), items).collect()
    assert sorted((r["rank"], r.doc_id) for r in rows) == [(i, i) for i in range(1, 21)]
    assert search.ranked(docs.limit(0), items).count() == 0
    assert search.ranked(docs, items.limit(0)).count() == 0


# --- alignment ----------------------------------------------------------------------------------------------------

def brute_alignment(texts):
    """Whole texts, byte by byte."""
    a_model, b_model = Tokenizer.from_file(queries.BYTE_BPE_JSON), sentencepiece.SentencePieceProcessor(model_file=queries.PIECE_BPE)
    a_model.encode_special_tokens = True
    alphabet = alignment.byte_of_char()
    rows, held = [], Counter()
    for text in texts:
        text = text or ""
        a = a_model.encode(" " + text, add_special_tokens=False).ids
        b = b_model.encode(text)
        a_bytes = [bytes(map(alphabet.__getitem__, a_model.id_to_token(i))) for i in a]
        pieces = [b_model.id_to_piece(i) for i in b]
        b_bytes = [bytes.fromhex(p[3:5]) if re.fullmatch("<0x..>", p) else p.replace("▁", " ").encode() for p in pieces]
        if not text or not b"".join(a_bytes) == b"".join(b_bytes) == (" " + text).encode():
            rows.append(None)
            continue
        spans = []
        for ids, parts in ((a, a_bytes), (b, b_bytes)):
            at, out = 0, []
            for i, x in zip(ids, parts):
                out.append((i, at, at + len(x)))
                at += len(x)
            spans.append(out)
        cuts = sorted({e for *_, e in spans[0]} & {e for *_, e in spans[1]})
        groups, at = [], [0, 0]
        for cut in cuts:
            sides = []
            for k, side in enumerate(spans):
                upto = at[k]
                while upto < len(side) and side[upto][2] <= cut:
                    upto += 1
                sides.append(",".join(str(i) for i, *_ in side[at[k]:upto]))
                at[k] = upto
            groups.append("|".join(sides))
        links, j = [], 0
        for x, s, e in spans[0]:
            while spans[1][j][2] <= s:
                j += 1
            k = j
            while k < len(spans[1]) and spans[1][k][1] < e:
                links.append((x, spans[1][k][0]))
                k += 1
        held.update(set(links))
        rows.append((len(a), len(b), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    best = defaultdict(int)
    for (x, _), n in held.items():
        best[x] = max(best[x], n)
    return [(0, 0, 0, 0, 0, 0, "") if r is None else
            (*r[:3], len(r[3]), sum(held[p] == best[p[0]] for p in r[3]), sum(held[p] for p in r[3]), r[4]) for r in rows]


def alignment_rows(df):
    return Counter((r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in df.collect())


def test_alignment_equals_brute_force_on_odd_rows(spark, odd):
    docs = odd.collect()
    expected = Counter((d.doc_id, *x) for d, x in zip(docs, brute_alignment([d.text for d in docs])))
    assert alignment_rows(alignment.aligned(odd, queries.BYTE_BPE_JSON, queries.PIECE_BPE)) == expected
    assert sum(x[1] > 0 for x in expected) > 12


def test_alignment_equals_brute_force_on_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    expected = Counter((d.doc_id, *x) for d, x in zip(docs, brute_alignment([d.text for d in docs])))
    assert alignment_rows(queries.op12_tokenizer_alignment(spark, sf)) == expected


def test_alignment_of_an_empty_table_and_in_blocks(spark, odd):
    assert alignment.aligned(odd.limit(0), queries.BYTE_BPE_JSON, queries.PIECE_BPE).count() == 0
    rows = alignment.stored(alignment.documents_aligned(odd, queries.BYTE_BPE_JSON, queries.PIECE_BPE))
    counts = alignment.pair_counts(rows, 32000)
    whole, parts = (alignment_rows(alignment.weighed(rows, counts, most)) for most in (1 << 22, 17))
    assert whole == parts


def test_aligner_forgets_within_its_bytes():
    work = alignment.Aligner(queries.BYTE_BPE_JSON, queries.PIECE_BPE, kept_bytes=100_000)
    texts = [" ".join(f"w{i}x{j}" for j in range(50)).encode() for i in range(100)]
    first, most = [], 0
    for at in range(0, 100, 5):
        first += work.align(texts[at:at + 5])[1]
        most = max(most, work.size)
    assert 100_000 < most < 250_000 and len(work.numbers) < 1000
    assert [work.align([t])[1][0] for t in texts] == first


def test_runs_of_stretches_that_are_not_given_back():
    """One stretch that a tokenizer changes does not spoil the others of its run."""
    work, alone = (alignment.Aligner(queries.BYTE_BPE_JSON, queries.PIECE_BPE) for _ in range(2))
    texts = ["plain words here".encode(), "a▁b and more words".encode(), "\nnew line\n\n".encode(), b"bad \xff byte", b"", "x ﬁ y".encode()]
    together = list(zip(*work.align(texts)[1:]))
    assert together == [tuple(c[0] for c in alone.align([t])[1:]) for t in texts]
    assert [bool(d) for d, *_ in together] == [True, False, True, False, False, True]


# --- archive ------------------------------------------------------------------------------------------------------

BIG = "<html>" + "ü" * 100
PAGES = [(5, "http://a/x y", BIG), (3, "http://b/", BIG), (9, None, BIG), (4, "http://c/\r\nWARC-Type: revisit", "short"), (6, "u", "short"),
         (7, "u", None), (8, "u", ""), (10, "u", f"WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\nWARC/1.1\r\n{'y' * 100}"), (3, "again", BIG),
         (None, "none", BIG), (None, None, None), (11, "u", "z" * 3_000_000), (12, "u", "\r\n\r\n" * 60), (13, "u", "\u0000" * 200)]


@pytest.fixture()
def pages(spark):
    return spark.createDataFrame([(i, u, h, "x", 5) for i, u, h in PAGES], "page_id long, url string, html string, digest string, number int")


def expected_pages():
    groups = defaultdict(list)
    for i, _, h in PAGES:
        groups[h or ""].append(i)
    out = []
    for h, ids in groups.items():
        order = sorted(ids, key=lambda i: (i is None, i or 0))
        data = h.encode()
        for at, i in enumerate(order):
            again = at > 0 and len(data) >= 100
            out.append((i, len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response", order[0] if again else None))
    return Counter(out)


def test_archive_round_trip(spark, pages, tmp_path):
    root = str(tmp_path / "archive")
    rows = warc.archived(pages, root).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    assert Counter(map(tuple, rows)) == expected_pages()
    restored = warc.originals(spark, root).collect()
    assert Counter((r.page_id, bytes(r.payload)) for r in restored) == Counter((i, (h or "").encode()) for i, _, h in PAGES)
    stored = spark.read.parquet(f"{root}/payloads")
    assert stored.count() == len({h or "" for *_, h in PAGES})


def test_files_are_plain_warc(spark, pages, tmp_path):
    """A reader that knows only the standard finds the same records."""
    root = str(tmp_path / "archive")
    archive = warc.store(pages, root)
    warc.write_warc(spark, root, archive, compression="none")
    exact = {r.header: bytes(r.http.encode() + b"\r\n\r\n" + r.payload) for r in warc.originals(spark, root).collect()}
    seen = Counter()
    for path in (tmp_path / "archive" / "warc").glob("part-*"):
        data, at = path.read_bytes(), 0
        while at < len(data):
            end = data.index(b"\r\n\r\n", at)
            header = data[at:end].decode()
            fields = dict(line.split(": ", 1) for line in header.split("\r\n")[1:])
            block = data[end + 4:end + 4 + int(fields["Content-Length"])]
            assert data[end + 4 + len(block):end + 8 + len(block)] == b"\r\n\r\n"
            at = end + 8 + len(block)
            kind = fields["WARC-Type"]
            seen[kind] += 1
            if kind == "response":
                assert exact[header] == block
            elif kind == "revisit":
                assert exact[header].startswith(block) and fields["WARC-Refers-To"][1:-1] in {r.record_id for r in warc.originals(spark, root).collect()}
    assert seen == {"warcinfo": 1, "response": 10, "revisit": 4}


def test_damaged_and_foreign_files(spark, pages, tmp_path):
    root = str(tmp_path / "archive")
    warc.write_warc(spark, root, warc.store(pages.where("page_id in (4, 5, 10)"), root), compression="none")
    rows = warc.read_warc(spark, f"{root}/warc", f"{warc.VERSION}{warc.CRLF}").collect()
    assert sum(r.intact for r in rows if r.type == "response") == 2  # the page that holds the line itself is seen to be cut
    part = next(p for p in (tmp_path / "archive" / "warc").glob("part-*") if b"short" in p.read_bytes())
    part.write_bytes(part.read_bytes().replace(b"short", b"shart"))
    for crc in (tmp_path / "archive" / "warc").glob(".part-*.crc"):
        crc.unlink()
    with pytest.raises(Exception, match="damaged record"):
        warc.read_back(spark, root).collect()


def test_digests_that_prove_nothing_stop_the_archive(spark, pages, tmp_path, monkeypatch):
    real = F.sha2
    monkeypatch.setattr(warc.F, "sha2", lambda c, n: F.lit("same") if n == 256 else real(c, n))
    with pytest.raises(Exception, match="different payloads share the digest"):
        warc.store(pages, str(tmp_path / "archive"))


def test_archive_of_an_empty_table(spark, pages, tmp_path):
    assert warc.archived(pages.limit(0), str(tmp_path / "a")).count() == 0


# --- exact dedup, in several batches and on any DataFrame -----------------------------------------------------------

def test_copies_meet_the_state_of_earlier_batches(spark, tmp_path, monkeypatch):
    seen = []
    real = exact_dedup.drain

    def watch(spark, path, schema, root, files_per_batch=None):
        state = real(spark, path, schema, root, files_per_batch)
        seen.append(state.sparkSession.read.parquet(f"{root}/states/*").select("version").distinct().count())
        return state

    monkeypatch.setattr(exact_dedup, "drain", watch)
    docs = spark.range(60).select("id", (F.col("id") % 7).cast("string").alias("text")).repartition(6).withColumnRenamed("id", "doc_id")
    docs.write.parquet(str(tmp_path / "docs"))
    rows = exact_dedup.copies(spark.read.parquet(str(tmp_path / "docs"))).collect()
    assert seen[0] > 1
    assert all(r.keep_id == r.doc_id % 7 and r.group_size == len(range(r.doc_id % 7, 60, 7)) and r.kept == (r.doc_id < 7) for r in rows) and len(rows) == 60


def test_rows_that_stay_on_any_frame(spark):
    rows = [(3, "a  b", "x"), (1, "a b", "y"), (2, None, "z"), (None, "", "w"), (5, "c", "v"), (5, "c", "v"), (None, "only", "u")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, file string")
    stays = Counter(map(tuple, exact_dedup.without_copies(docs.filter("true")).collect()))
    assert stays == Counter([(1, "a b", "y"), (2, None, "z"), (5, "c", "v"), (None, "only", "u")])
    assert exact_dedup.without_copies(docs.limit(0)).count() == 0
