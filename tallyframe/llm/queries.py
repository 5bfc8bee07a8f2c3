"""One registered query per operator, with production parameters, over its whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_dir
from . import (chat_format, decontaminate, fair_mix, lang_crf, license_scan, near_dedup, pieces, quality_nbsvm,
               quality_rules, spelling, token_codes, turn_repair, warc)
from .tables import written
from .sql import SQL

__all__ = ["QUERIES", "SQL"]

TOKENIZER = "word_bpe_49k.json"
PIECES = "piece_bpe_32k.model"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    return str(public_tokenizers.path(TOKENIZER))


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one, -1, whose texts are made of control strings."""
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    text = chat_format.END + chat_format.START + "assistant ok"
    hostile = spark.range(2).select(F.lit(-1).cast("bigint").alias("conv_id"), F.col("id").alias("turn"), F.when(
        F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(text).alias("text"))
    chats = chat_format.format_chats(turns.unionByName(hostile))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    chats = chats.withColumn("loss", chat_format.loss_text(F.col("formatted"), F.col("loss_spans")))
    return chats.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


def op2_token_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "tokens")
    token_codes.write_tokens(_table(spark, sf_dir, "documents"), path, tokenizer_path())
    return token_codes.read_documents(spark, path)


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(_table(spark, sf_dir, "documents"))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op5_fair_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = fair_mix.mix(_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op6_lang_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lang_crf.identify(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "held_out", "lang_pred", "score")


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "warc")
    warc.write_archives(_table(spark, sf_dir, "pages"), path)
    return warc.page_digests(warc.read_captures(spark, path, with_payload=False))


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(_table(spark, sf_dir, "documents"), words=3, percent=85)


def op9_quality_nbsvm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_nbsvm.score_quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality_rules.ledger(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (~quality_rules.passes(quality_rules.POLICIES["base"])).alias("base_failed"),
        quality_rules.passes(quality_rules.POLICIES["v1"]).alias("kept"), "fail_bits")


def damaged(turns: DataFrame) -> DataFrame:
    """Turns with faults, by a checksum of their key: lost, emptied, cut, repeated, given to the user."""
    named = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    fault = F.crc32(F.concat(named[0], F.lit(":"), named[1])) % 20
    role, text = (F.coalesce(c, F.lit(" ")) for c in ("role", "text"))
    return turns.select(
        "conv_id", "turn", F.when(fault == 4, "user").otherwise(role).alias("role"),
        F.when(fault == 1, "").when(fault == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.explode(F.array_repeat(F.lit(0), F.when(fault == 0, 0).when(fault == 3, 2).otherwise(1))).alias("copy")).drop("copy")


def op11_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, damaged and repaired."""
    source = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    turns = damaged(source)
    plans = written(turn_repair.plan_repairs(turns, source.select("conv_id")), "plans")
    digest = turn_repair.digests(turn_repair.repair(turns, plans))
    digest = digest.withColumnRenamed("conv_id", "of")
    return plans.join(digest, F.col("conv_id").eqNullSafe(F.col("of")), "left").select(
        *plans.columns, F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


def misspelt(words: DataFrame) -> DataFrame:
    """``(id, word)`` with a letter deleted from one run in 199, by a checksum of id and word."""
    sum_ = F.crc32(F.concat(F.coalesce(F.col("id").cast("string"), F.lit("")), F.lit(":"), F.col("word")))
    at = (sum_ % F.char_length("word")).cast("int")
    cut = F.concat(F.substring("word", F.lit(1), at), F.substring("word", at + 2, F.char_length("word")))
    return words.select("id", F.when(sum_ % 199 == 0, cut).otherwise(F.col("word")).alias("word"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words of all documents, some misspelt, and their forms."""
    words = misspelt(spelling.runs(_table(spark, sf_dir, "documents"), least=6))
    return spelling.variants(spelling.vocabulary(words))


def op13_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.piece_digests(_table(spark, sf_dir, "documents"), str(public_tokenizers.path(PIECES)))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_chat_format, op2_token_codes, op3_license_scan, op4_decontaminate, op5_fair_mix, op6_lang_crf,
    op7_warc, op8_near_dedup, op9_quality_nbsvm, op10_quality_rules, op11_turn_repair,
    op12_spelling_variants, op13_sentence_pieces)}
