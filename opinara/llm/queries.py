"""The operators of this package as named queries over the given tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opinara.llm import (alignment, byte_bpe, exact_dedup, fingerprints, language, licenses, packing, quality, search, token_counts,
                         toxicity, warc)
from opinara.llm.common import documents
from opinara.llm.ngram_join import near_duplicates

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
BYTE_BPE_JSON = public_tokenizers.path("byte_bpe_50k.json")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def fold(of: int) -> Column:
    """The documents' fold: crc32 of the doc_id as text, modulo `of`."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(of))


def labels(spark: SparkSession, sf_dir: str, column: str) -> DataFrame:
    """doc_id and label of the rows that may be learnt from."""
    return (spark.read.parquet(f"{sf_dir}/labels.parquet").where(fold(5) != 0)
            .select("doc_id", F.col(column).cast("int").alias("label")))


def dictionaries(docs: DataFrame) -> dict[str, bytes]:
    return language.learn(docs.where(fold(4) != 2))


def query(build):
    QUERIES[build.__name__] = build
    return build


@query
def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir), words=3, percent=90).drop("class_id")


ORACLE["op1_ngram_jaccard_join"] = """
    with recursive words as (
        select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
               'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') as w from documents),
    sets as (
        select doc_id, case when len(w) = 0 then [] when len(w) < 3 then [array_to_string(w, ' ')]
               else list_distinct(list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' '))) end as s
        from words),
    shingles as (select doc_id, unnest(s) as g from sets),
    sizes as (select doc_id, len(s) as n from sets),
    common as (select x.doc_id as a, y.doc_id as b, count(*) as c from shingles x join shingles y
             on x.g = y.g and x.doc_id <> y.doc_id group by 1, 2),
    links as (select a, b from common join sizes p on p.doc_id = a join sizes q on q.doc_id = b
              where 100 * c >= 90 * (p.n + q.n - c)),
    reach(doc_id, r) as (
        select doc_id, doc_id from documents
        union select l.b, reach.r from reach join links l on l.a = reach.doc_id)
    select doc_id, n as n_shingles, min(r) as component_id from reach join sizes using (doc_id) group by 1, 2"""


@query
def op1_ngram_jaccard_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir), words=3, percent=90, count_links=True)


ORACLE["op1_ngram_jaccard_links"] = """
    with recursive words as (
        select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
               'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') as w from documents),
    sets as (
        select doc_id, case when len(w) = 0 then [] when len(w) < 3 then [array_to_string(w, ' ')]
               else list_distinct(list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' '))) end as s
        from words),
    shingles as (select doc_id, unnest(s) as g from sets),
    sizes as (select doc_id, len(s) as n from sets),
    common as (select x.doc_id as a, y.doc_id as b, count(*) as c from shingles x join shingles y
             on x.g = y.g and x.doc_id <> y.doc_id group by 1, 2),
    links as (select a, b, c = p.n and c = q.n as equal from common join sizes p on p.doc_id = a join sizes q on q.doc_id = b
              where 100 * c >= 90 * (p.n + q.n - c)),
    counts as (select a as doc_id, count(*) as n_links, min(b) filter (where equal) as first from links group by 1),
    reach(doc_id, r) as (
        select doc_id, doc_id from documents
        union select l.b, reach.r from reach join links l on l.a = reach.doc_id),
    parts as (select doc_id, min(r) as component_id from reach group by 1)
    select doc_id, n as n_shingles, least(doc_id, coalesce(first, doc_id)) as class_id, component_id,
           coalesce(n_links, 0) as n_links
    from parts join sizes using (doc_id) left join counts using (doc_id)"""


@query
def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.copies(documents(spark, sf_dir)).drop("file", "row")


ORACLE["op6_exact_dedup"] = """
    with texts as (select doc_id, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g') as t from documents)
    select doc_id, min(doc_id) over (partition by t) as keep_id, count(*) over (partition by t) as group_size,
           doc_id = min(doc_id) over (partition by t) as kept, sha256(t) as text_sha256 from texts"""


@query
def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), WORD_BPE, capacity=4096, end_id=1)


@query
def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = quality.learn(docs, labels(spark, sf_dir, "quality"))
    return quality.scored(docs, model).select("doc_id", (fold(5) == 0).alias("held_out"), "score",
                                              (F.col("score") >= 0.3).cast("int").alias("predicted"))


@query
def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return language.identify(docs, dictionaries(docs)).select("doc_id", (fold(4) == 2).alias("held_out"), "lang_pred", "score", "margin")


@query
def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(documents(spark, sf_dir))


@query
def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(documents(spark, sf_dir), WORD_BPE, budget=2048, keep_prefixes=False)


@query
def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.encoded(documents(spark, sf_dir), BYTE_BPE, public_tokenizers.PATTERN, keep_ids=False)


@query
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = toxicity.learn(docs, labels(spark, sf_dir, "toxic"))
    return toxicity.scored(docs, model).select("doc_id", (fold(5) == 0).alias("held_out"), "score",
                                               (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query
def op10_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprints(documents(spark, sf_dir))


@query
def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.ranked(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), k=20)


ORACLE["op11_ranked_search"] = """
    with docs as (
        select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') as w from documents),
    totals as (select count(*) filter (len(w) > 0)::bigint as n_docs, sum(len(w))::bigint as n_terms from docs),
    asked as (
        select item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
               'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) as t from benchmark),
    uses as (select item_id, t, count(*) as times from asked group by 1, 2),
    spread as (select doc_id, len(w) as n, unnest(w) as t from docs),
    counts as (select doc_id, n, t, count(*) as tf from spread group by 1, 2, 3),
    weights as (
        select t, floor(1000 * ln((2 * n_docs + 2)::double / (2 * count(*) + 1)::double))::bigint as w
        from counts, totals group by t, n_docs),
    scored as (
        select item_id, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + ((25 * n * n_docs) // n_terms)))))::bigint as score
        from uses join counts using (t) join weights using (t), totals group by 1, 2),
    ranked as (
        select item_id, row_number() over (partition by item_id order by score desc, doc_id) as rank, doc_id, score
        from scored where score > 0)
    select item_id, rank::int as rank, doc_id, score from ranked where rank <= 20"""


@query
def op12_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.aligned(documents(spark, sf_dir), BYTE_BPE_JSON, PIECE_BPE)


@query
def op13_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived(spark.read.parquet(f"{sf_dir}/pages.parquet"))


ORACLE["op13_warc_archive"] = """
    with sizes as (select page_id, coalesce(html, '') as body, strlen(coalesce(html, '')) as n from pages),
    heads as (select *, min(page_id) over (partition by body) as head from sizes)
    select page_id, n::bigint as payload_bytes, sha256(body) as payload_digest,
           case when n >= 100 and page_id <> head then 'revisit' else 'response' end as record_type,
           case when n >= 100 and page_id <> head then head end as refers_to from heads"""
