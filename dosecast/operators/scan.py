"""Scans along an order in groups of any size.

Rows are sorted into range partitions, whose borders Spark samples from the
data, so a group (a tile, a segment) may span any number of them and no partition
is large because its coordinates lie close together.  Each partition works on its
own stretch of a group; what it must know of the stretches before or behind comes
from a summary with one row for each group and partition that meet.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dosecast.session import large, materialize

STRETCH = "_stretch"


def stretches(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """``df`` as a written table with ``_stretch``: the range partition of (``keys``, ``order``) that holds a row."""
    return materialize(df.orderBy(*keys, *order).select("*", F.spark_partition_id().alias(STRETCH)), "stretches")


def carried(summary: DataFrame, keys: list[str], values: dict[str, Column]) -> DataFrame:
    """``values`` (aggregates over earlier stretches) for each row of ``summary`` (``keys``, ``_stretch``, ...)."""
    before = Window.partitionBy(*keys).orderBy(STRETCH).rowsBetween(Window.unboundedPreceding, -1)
    return summary.select(*keys, STRETCH, *[v.over(before).alias(name) for name, v in values.items()])


def sequence(df: DataFrame, keys: list[str], order: list[str], ahead: list[str]) -> DataFrame:
    """``df`` with ``_idx``, a row's number from 0 in its group, and for each column c of ``ahead`` ``next_c``, its value
    in the group's next row (null in the last)."""
    s = stretches(df, keys, order)
    w = Window.partitionBy(*keys, STRETCH).orderBy(*order)
    # The struct tells a next row whose values are null from no next row.
    s = s.withColumns({"_i": F.row_number().over(w) - 1, "_next": F.lead(F.struct(*ahead)).over(w)})
    runs = s.groupBy(*keys, STRETCH).agg(F.count(F.lit(1)).alias("_n"), F.min_by(F.struct(*ahead), F.struct(*order)).alias("_first"))
    by = Window.partitionBy(*keys).orderBy(STRETCH)
    runs = runs.select(*keys, STRETCH, F.coalesce(F.sum("_n").over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"),
                       F.lead("_first").over(by).alias("_behind"))
    j = s.join(large(runs), [*keys, STRETCH]).withColumn("_next", F.coalesce("_next", "_behind"))
    return j.select(*df.columns, (F.col("_off") + F.col("_i")).alias("_idx"), *[F.col(f"_next.{c}").alias(f"next_{c}") for c in ahead])
