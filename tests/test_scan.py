"""Scans over range partitions: one dense group, one long segment, nothing large in one task."""

import statistics

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from dosecast.operators import geometry as ge
from dosecast.operators import scan


def test_many_coordinates_in_a_few_units(spark):
    """A million distinct coordinates in 64 units, all of one tile, in balanced stretches."""
    n = 1_000_000
    df = spark.range(n).select(F.when(F.col("id") % 1000 == 0, 2).otherwise(1).alias("tile"), "id",
                               (F.col("id") * 7919 % n * 64.0 / n + F.when(F.col("id") * 7919 % n > n / 2, 0.5).otherwise(0)).alias("pc"))
    got = ge.gap_islands(df, "pc", eps=0.25).groupBy("tile", "pgroup").agg(
        F.count(F.lit(1)).alias("n"), F.min("pc").alias("lo"), F.max("pc").alias("hi")).collect()
    pdf = df.toPandas()
    want = []
    for t, x in pdf.groupby("tile")["pc"]:
        x = np.sort(x)
        group = np.cumsum(np.concatenate([[1], (np.diff(x) > 0.25).astype(int)]))
        want += [(t, int(g), len(v), v.min(), v.max()) for g, v in pd.Series(x).groupby(group)]
    assert sorted((r.tile, r.pgroup, r.n, r.lo, r.hi) for r in got) == sorted(want)
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    sizes = [r["count"] for r in scan.stretches(df.select("tile", "pc"), ["tile"], ["pc"]).groupBy(scan.STRETCH).count().collect()]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    assert len(sizes) == 8 and max(sizes) <= 2 * statistics.median(sizes)


def test_one_segment_with_many_cuts(spark):
    n = 100_000
    v = spark.createDataFrame([(1, 7, 5.0, 0.0, float(n + 1)), (1, 8, 6.0, 0.0, 10.0)], "tile long, id long, x double, y1 double, y2 double")
    cross = spark.range(n).select(F.lit(1).alias("tile"), F.lit(7).alias("v_id"), "id", F.lit(5.0).alias("x"),
                                  (F.col("id") * 7919 % n + 1.0).alias("y")).withColumnRenamed("id", "h_id")
    got = ge.split_vertical_at_crossings(v, cross)
    assert got.where("v_id = 8").collect()[0][2:] == (0, 6.0, 0.0, 10.0)
    one = got.where("v_id = 7")
    assert one.count() == n + 1 and one.where("y_to - y_from = 1 and piece = y_from").count() == n + 1


def test_sequence_against_sorting(spark):
    rng = np.random.default_rng(3)
    rows = [(int(k), float(v), int(t)) for k, v, t in zip(rng.integers(0, 4, 500), rng.integers(0, 90, 500), rng.integers(0, 9, 500))]
    got = scan.sequence(spark.createDataFrame(rows, "k long, v double, t long"), ["k"], ["v", "t"], ["v", "t"]).collect()
    for k in range(4):
        own = sorted((r[1], r[2]) for r in rows if r[0] == k)
        mine = sorted((r for r in got if r.k == k), key=lambda r: r._idx)
        assert [(r.v, r.t) for r in mine] == own and [r._idx for r in mine] == list(range(len(own)))
        assert [(r.next_v, r.next_t) for r in mine] == [*own[1:], (None, None)]
