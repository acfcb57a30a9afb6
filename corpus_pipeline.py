"""From raw documents to a deduplicated, decontaminated, weighted and tokenized corpus.

Each stage takes what the one before kept. All but the last return the columns they got, so any stage can be left out
or run again on its own; the last writes token files and reports what it reads back from them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tributary.llm import contamination, minhash, mixing, quality, tokens
from tributary.llm.common import table, written
from tributary.llm.queries import word_tokenizer

#: The stages draw on libraries, trained weights and iterations that SQL does not have. Tests hold the operators to
#: brute force; of the whole pipeline they check columns and row counts only.
ORACLE_SQL = None


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the classifier rejects. It learns from the given documents that have labels."""
    net = quality.fit(docs, quality.learnable(table(spark, sf_dir, "labels")))
    return quality.keep_good(docs, net)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document, the smallest doc_id, of each group of near copies: five-word shingles, similarity 0.8.

    Copies are found by ball hashing of fingerprints, then by min-hashes what that cannot reach, and verified on both texts.
    """
    return minhash.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold benchmark passages beyond the contamination share."""
    return contamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats or leaves out documents until every source has its target of tokens."""
    return mixing.mixed(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Writes token files and returns ``(doc_id, start, n_tokens, ids_crc32)`` for each document in them."""
    return tokens.read_tokens(tokens.write_tokens(docs, word_tokenizer()))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_filter", quality_filter),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("mix", mix),
    ("write_tokens", write_tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's rows are written as Parquet and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs, _ = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
