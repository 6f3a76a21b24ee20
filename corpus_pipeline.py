"""The corpus pipeline: five stages from raw documents to token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns
of documents. A stage sees every row that the one before kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from listmill.engine import cut, load
from listmill.llm import decontaminate, language_id, quality, queries, simhash


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language go."""
    return language_id.keep_identified(docs)


def check_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the fixed rules or the limits of their language and source fail go."""
    return quality.keep_good(docs)


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group stays."""
    return simhash.drop_near_duplicates(docs)


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.drop_leaks(docs, load(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and the digests of the ids and of what they decode to."""
    return queries.bpe_digests(docs)


STAGES = [
    ("language ID", identify_language),
    ("quality rules", check_quality),
    ("near duplicates", remove_near_duplicates),
    ("decontamination", remove_benchmark),
    ("byte-level BPE", encode),
]

#: No stage but the second can be said in SQL; the tests hold run() against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``, each stored before the next reads it."""
    docs = load(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
