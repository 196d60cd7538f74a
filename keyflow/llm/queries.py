"""One query per operator, over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keyflow.llm import bpe, brown, chat, decontaminate, hard_negatives, language, near_copies, nearest, repeats, source_divergence, token_counts, token_files, toxicity
from keyflow.llm.common import fold_of, table
from keyflow.session import scratch_path

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def op1_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return repeats.remove(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), PIECES)


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = fold_of(F.col("doc_id"), 5) == 0
    model = language.fit(docs, ~held_out)
    return language.predict(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score", F.size("spans").alias("n_spans")
    )


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "tokens")
    token_files.write(table(spark, sf_dir, "documents"), WORD_BPE, path)
    return token_files.digests(token_files.read_tokens(spark, path))


def op5_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op6_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.render(table(spark, sf_dir, "conversations"))


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = bpe.encode(table(spark, sf_dir, "documents"), BYTE_BPE)
    return bpe.digests(bpe.decode(encoded, BYTE_BPE))


def op8_brown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return brown.score(table(spark, sf_dir, "documents"), fold_of(F.col("doc_id"), 10) == 0)


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_near_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_copies.classes(table(spark, sf_dir, "documents"))


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = fold_of(F.col("doc_id"), 5) == 0
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), ~held_out)
    return toxicity.predict(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out.alias("held_out"), "score", "predicted", F.size("passages").alias("n_passages")
    )


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence.audit(table(spark, sf_dir, "documents"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return hard_negatives.mine(vectors, F.col("vec_id") % 50 == 0, hard_negatives.relabelled())


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        op1_repeats,
        op2_token_counts,
        op3_language,
        op4_token_files,
        op5_nearest,
        op6_chat,
        op7_bpe,
        op8_brown,
        op9_decontaminate,
        op10_near_copies,
        op11_toxicity,
        op12_source_divergence,
        op13_hard_negatives,
    )
}
ORACLES: dict[str, str] = {
    "op6_chat": chat.SQL,
    "op12_source_divergence": source_divergence.SQL,
    "op13_hard_negatives": hard_negatives.SQL,
}
