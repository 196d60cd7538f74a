"""From raw documents to token ids: five stages, each over all that the one before kept.

1. language: documents without a language, or whose letters are mostly of other languages, go.
2. near copies: one document of each class of near copies stays, the one with the smallest id.
3. repeats: bytes of 100-byte strings that start earlier in the corpus are cut; characters cut in part go whole.
4. decontamination: documents that hold a passage of the benchmark go.
5. tokens: byte-pair ids of what is left, and the text they decode to.

Rows without id go through all stages; null texts have no language and go in the first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keyflow.llm import bpe, decontaminate, language, near_copies, repeats
from keyflow.llm.common import table
from keyflow.llm.components import written
from keyflow.llm.queries import BYTE_BPE

#: Least share of letters in the main language.
LANGUAGE_SHARE = 0.5
#: Percent of shared five-word shingles from which documents are near copies.
NEAR_COPY = 80


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = language.fit(docs, F.lit(True))
    found = language.predict(docs, model)
    rejected = (F.col("lang_pred") == language.UNDETERMINED) | (F.col("score") < LANGUAGE_SHARE)
    return found.where(~rejected).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_copies.deduplicated(docs, NEAR_COPY)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    changed = F.col("n_removed") > 0
    cut = repeats.remove(docs, as_text=True).withColumn("text", F.when(changed, F.col("kept")).otherwise(F.col("text")))
    cut = cut.withColumn("n_chars", F.when(changed, F.char_length("text").cast("long")).otherwise(F.col("n_chars")))
    return cut.select(*docs.columns)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.round_trip(docs, BYTE_BPE).withColumn("n_tokens", F.size("ids").cast("long"))


STAGES = [
    ("language", identify_language),
    ("near_copies", drop_near_copies),
    ("repeats", cut_repeats),
    ("decontamination", drop_benchmark),
    ("tokens", encode_tokens),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's result is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
