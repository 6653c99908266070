"""The training corpus, from ``documents`` to token records, in five stages.

Quality rules, SimHash near-duplicates, benchmark decontamination, mixing of
sources, binary token records.  Every stage takes what its predecessor kept
and returns the columns of ``documents``; the last returns the records that it
wrote.  ``ORACLE_SQL`` is None: SQL can express neither the fingerprints' hash
nor the tokenizer; the stages are tested against brute-force versions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from dosecast.llm import decontaminate, mixing, quality, records, simhash
from dosecast.llm.common import read_table
from dosecast.llm.queries import tokenizer_path
from dosecast.session import materialize


# Units that a worker of the last stage keeps: its workers also hold what the stages before have left.
TOKEN_UNITS = 400_000


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.filter_documents(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs, shingle=3, bits=3)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.remove_spans(docs, read_table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def token_records(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return records.digest(docs, tokenizer_path(), units=TOKEN_UNITS)


STAGES = [
    ("quality rules", quality_rules),
    ("SimHash near-dedup", simhash_near_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("mixing sources to target weights", mix_sources),
    ("token-ID / binary output", token_records),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; each one's result is a written table that the next one reads."""
    docs = read_table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = materialize(docs, f"stage{i + 1}")
    return docs
