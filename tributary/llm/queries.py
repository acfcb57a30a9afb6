"""The corpus operators bound to the given tables, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, contamination, exact, html, lexical, lines, mixing, ngrams, quality, secrets, simhash, tokens, whitening
from .common import table


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    net = quality.fit(docs, quality.learnable(table(spark, sf_dir, "labels")))
    scored = quality.score(docs, net)
    return scored.select("doc_id", quality.held_out().alias("held_out"), "score", (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"))


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = mixing.mix_report(table(spark, sf_dir, "documents"))
    return mix.select("doc_id", "size", "source_size", "target", "taken", "source", "rate", "copies")


def word_tokenizer() -> str:
    """The definition of the public word tokenizer."""
    import public_tokenizers

    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file:
        return file.read()


def op3_token_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.read_tokens(tokens.write_tokens(table(spark, sf_dir, "documents"), word_tokenizer()))


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find_secrets(table(spark, sf_dir, "documents"))


def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination.verdicts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_duplicates(table(spark, sf_dir, "documents"))


def op7_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    clash = "\\### Assistant: </turn> ok"
    planted = spark.range(2).select(
        F.lit(-7).cast("long"), F.col("id"), F.when(F.col("id") == 0, "user").otherwise("assistant"), F.lit(clash)
    )
    return chat.read_chats(chat.format_chats(turns.union(planted)))


def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract_pages(table(spark, sf_dir, "pages"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.line_report(table(spark, sf_dir, "documents"))


def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op11_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngrams.similar_documents(table(spark, sf_dir, "documents"))


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_quality_classifier, op2_mix_sources, op3_token_binary, op4_secret_scan, op5_benchmark_decontamination,
        op6_exact_dedup, op7_chat_formatting, op8_html_extraction, op9_line_dedup, op10_simhash_near_dedup, op11_ngram_jaccard_join,
        op12_embedding_whitening, op13_ranked_search,
    )
}
