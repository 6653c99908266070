"""Queries of the training-data operators: ``opN_<name>`` over the whole table it is meant for."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dosecast.llm import (chat, decontaminate, langid, line_dedup, merkle, mixing, ngram_join, oracle, pii, quality, records, simhash,
                          spelling, token_counts)
from dosecast.llm.common import need, read_table
from dosecast.session import ship_package

TOKENIZER = "byte_bpe_50k.json"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.digest(read_table(spark, sf_dir, "documents"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.digest(token_counts.prefix_table(read_table(spark, sf_dir, "documents"), tokenizer_path()))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(read_table(spark, sf_dir, "documents"))


def op4_binary_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.digest(read_table(spark, sf_dir, "documents"), tokenizer_path())


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.personal_data(read_table(spark, sf_dir, "documents")))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.digest(simhash.near_duplicates(read_table(spark, sf_dir, "documents")))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken(read_table(spark, sf_dir, "documents"))


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = r"\### Assistant: </turn> ok"
    added = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(text).alias("text"))
    rows = need(read_table(spark, sf_dir, "conversations"), "conv_id", "turn", "role", "text").unionByName(added)
    messages = rows.withColumn("parts", chat.text_part(F.col("text")))
    return chat.digest(chat.format_conversations(messages))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(read_table(spark, sf_dir, "documents"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.digest(decontaminate.matches(read_table(spark, sf_dir, "documents"),
                                                      read_table(spark, sf_dir, "benchmark")))


def op11_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.digest(ngram_join.Join(read_table(spark, sf_dir, "documents")))


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(read_table(spark, sf_dir, "documents"))


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    lowered = F.translate(F.col("text"), upper, upper.lower())
    return merkle.digest(merkle.manifest(read_table(spark, sf_dir, "documents"), merkle.tampered(), lowered))


_QUERIES = [op1_line_dedup, op2_token_counts, op3_quality_rules, op4_binary_records, op5_pii, op6_simhash, op7_mixing,
            op8_chat_format, op9_language_id, op10_decontamination, op11_ngram_join, op12_spelling, op13_merkle]


def _shipped(fn):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return fn(spark, sf_dir)
    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    import corpus_pipeline
    return {f.__name__: _shipped(f) for f in _QUERIES} | {"pipeline": _shipped(corpus_pipeline.run)}


def oracle_sql() -> dict[str, str]:
    return dict(oracle.SQL)
