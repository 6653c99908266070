"""Helpers for operators whose groups or keys may be of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def dealt(rows: DataFrame, key: str, item: str, dense: int) -> tuple[DataFrame, DataFrame]:
    """``rows`` as the two sides of a self-join on ``key``, with columns cell_r and cell_c to join on as well.

    A key with more than ``dense`` rows is dealt out over a square grid of cells, a side's row to one line
    of it (by the hash of ``item``) and the other's to one column, so each pair of rows meets in one
    cell and no task gets all rows of the key twice."""
    heavy = rows.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > dense).select(
        key, F.ceil(F.col("_n") / dense).cast("long").alias("_side"))
    rows = rows.join(heavy, key, "left").withColumn("_side", F.coalesce("_side", F.lit(1)))
    own = F.pmod(F.xxhash64(F.col(item)), F.col("_side"))
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.col("_side") - 1))
    return (rows.withColumn("cell_r", own).withColumn("cell_c", every).drop("_side"),
            rows.withColumn("cell_c", own).withColumn("cell_r", every).drop("_side"))


def numbered(rows: DataFrame, group: str, order: list[Column], write) -> DataFrame:
    """``rows`` (without the columns part, seq) with idx, the number from 0 in the order within ``group``
    (not null), and n, the group's size.

    One range shuffle by (group, order), written with each row's place in its partition; a group's
    share of each partition is counted and the counts are summed up, one row for each partition and
    group that meet, so a group may span all partitions.  Rows equal in group and order must be
    interchangeable."""
    at = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    s = write(rows.orderBy(group, *order).select("*", F.spark_partition_id().alias("part"), at.alias("seq")))
    runs = s.groupBy(group, "part").agg(F.min("seq").alias("_first"), F.count(F.lit(1)).alias("_n"))
    by = Window.partitionBy(group)
    before = F.sum("_n").over(by.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    runs = runs.select(group, "part", (F.coalesce(before, F.lit(0)) - F.col("_first")).alias("_shift"),
                       F.sum("_n").over(by).alias("n"))
    return s.join(runs, [group, "part"]).withColumn("idx", F.col("seq") + F.col("_shift")).drop("part", "seq", "_shift")
