"""From raw documents to packed training sequences, in five stages.

STAGES lists them; each reads what the one before kept. run() applies them to `documents`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from opinara.llm import exact_dedup, language, ngram_join, packing, quality
from opinara.llm.common import documents, stored
from opinara.llm.queries import WORD_BPE, dictionaries, labels

LEAST_MARGIN, LEAST_QUALITY = 0.002, 0.3
#: Chunks a worker keeps the ids of, half as many as op9: here it lives beside what four other stages have left.
MEMO = 200_000


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told apart with a margin; others go."""
    return language.accepted(docs, dictionaries(docs), LEAST_MARGIN)


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules do not reject."""
    return quality.accepted(docs, quality.learn(docs, labels(spark, sf_dir, "quality")), LEAST_QUALITY)


def unique(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.without_copies(docs)


def distinct_enough(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word shingles of Jaccard similarity 0.8 or more."""
    return ngram_join.one_of_each(docs, words=5, percent=80)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of the remaining documents with its place in a sequence of 4096 tokens."""
    return packing.pack(docs, WORD_BPE, capacity=4096, end_id=1, memo=MEMO)


STAGES = [("language_id", known_language), ("quality_classifier", good_quality), ("exact_dedup", unique),
          ("ngram_jaccard_join", distinct_enough), ("best_fit_packing", packed)]

#: Language, quality and packing are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage over the whole of `documents`; each result is stored as Parquet and read again."""
    docs = documents(spark, sf_dir)
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stored(docs)
    return docs
