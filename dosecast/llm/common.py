"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The white space of the contracts: U+0020 and U+0009 to U+000D.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sealed(df: DataFrame, *own: str) -> DataFrame:
    """``df`` with its columns, but for those of ``own``, renamed by place, so that no name of the input can
    clash with one that an operator adds.  ``unsealed`` gives the names back."""
    names = [f"in{i}" for i in range(len(df.columns))]
    for c in own:
        if c in df.columns:
            names[df.columns.index(c)] = c
    return df.toDF(*names)


def unsealed(df: DataFrame, like: DataFrame, *own: str) -> DataFrame:
    """The columns of ``like``, in order and under their names, from a frame derived from ``sealed(like, *own)``."""
    return df.select(*sealed(like, *own).columns).toDF(*like.columns)


def need(df: DataFrame, *cols: str) -> DataFrame:
    """Only the named columns; further columns of the input, whatever their names, play no part."""
    return sealed(df, *cols).select(*cols)


ROW = ("row1", "row2")      # a row, by id and text


def row_key() -> list[Column]:
    """``ROW`` of doc_id and text."""
    text = F.coalesce("text", F.lit(""))
    return [F.xxhash64("doc_id", text).alias(ROW[0]), F.xxhash64(F.lit(1), "doc_id", text).alias(ROW[1])]


def word_list(text: Column) -> Column:
    """Words of a text (null: none) as an array, empty strings removed."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
