"""Connected components of an edge table, by alternating large-star and small-star steps.

Each step is one aggregation by node and one join back, so no neighbourhood is
ever gathered in a task, and each round's edges are a written table.  The steps
end at stars whose centres are the smallest nodes of their components; the
number of rounds grows with the logarithm of the number of nodes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dosecast.session import materialize


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """``edges``: u > v, distinct.  Large star: every larger neighbour of a node is linked to the node's
    smallest neighbour (or itself).  Small star: every smaller neighbour is, and the node itself."""
    if large:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        new = both.join(low, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        low = edges.groupBy("u").agg(F.min("v").alias("m"))
        linked = edges.join(low, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        new = linked.unionByName(low.select("u", F.col("m").alias("v")))
    return new.distinct()


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b) of any comparable type -> (node, label): the label is the component's smallest node.
    Nodes without an edge do not occur."""
    e = edges.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    e = materialize(e, "cc_edges")
    seen = None
    while True:
        e = materialize(_star(_star(e, True), False), "cc_round")
        # Rounds that change nothing have the same edges; one row of sums reaches the driver.
        now = e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen:
            break
        seen = now
    return e.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())
