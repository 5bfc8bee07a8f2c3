"""Documents to training tokens: five stages, each written as Parquet and read by the next.

language ID -> MinHash near-dedup -> benchmark decontamination -> mixing -> token ids.

A stage is ``(spark, docs, sf_dir) -> DataFrame``.  All but the last return the columns of
``documents``: rejected, duplicate and contaminated documents are gone, and mixing repeats a
document as often as it takes it.  The last returns one row per document of the written tokens.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyframe.llm import decontaminate, fair_mix, lang_crf, near_dedup, queries, token_codes
from tallyframe.llm.tables import written
from tallyframe.session import scratch_dir


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: documents without an identified language go."""
    return lang_crf.reject_unidentified(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: one document of each group of near-duplicates stays (five words, 0.8)."""
    return near_dedup.drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: documents that hold a benchmark item go."""
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: sources to their target weights; rows repeat as they are taken."""
    return fair_mix.mix_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: token ids in directly addressable codes, read back per document."""
    path = scratch_dir(spark, "tokens")
    token_codes.write_tokens(docs, path, queries.tokenizer_path())
    return token_codes.read_documents(spark, path)


STAGES = [
    ("language ID", language),
    ("MinHash near-dedup", near_dedup_stage),
    ("benchmark decontamination", decontamination),
    ("mixing sources to target weights", mixing),
    ("token-ID output", tokens),
]

#: Model training and tokenization are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written before the next begins."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        docs = written(stage(spark, docs, sf_dir), f"stage{number}")
    return docs
