"""Join audits, many-to-one checks, duplicate reports, emptiness counters."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def join_audit(left: DataFrame, right: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """The row counts of every join type from one pass over each side.

    The keys of both sides are tagged, united and counted by key (combined map-side, so a key with a
    third of all rows is one row); a key with l and r rows has l * r joined rows.  Null keys join nothing.
    ``row_rule_ok`` applies the reference's rule for ``how``: a left (right)
    join keeps the left (right) row count, an inner join is no larger than
    either side, a cross join has left x right rows.
    """
    tagged = [df.select(*keys, F.lit(l).alias("_l"), F.lit(1 - l).alias("_r")) for df, l in ((left, 1), (right, 0))]
    by_key = tagged[0].unionByName(tagged[1]).groupBy(*keys).agg(F.sum("_l").alias("l"), F.sum("_r").alias("r"))
    joins = F.lit(True)
    for k in keys:
        joins = joins & F.col(k).isNotNull()
    r, l = F.when(joins, F.col("r")).otherwise(0), F.when(joins, F.col("l")).otherwise(0)
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    a = by_key.agg(total(F.when(joins, F.col("l") * F.col("r")).otherwise(0)).alias("both_sides"),
                   total(F.when(r == 0, F.col("l")).otherwise(0)).alias("left_only"),
                   total(F.when(l == 0, F.col("r")).otherwise(0)).alias("right_only"),
                   total(F.col("l")).alias("left_rows"), total(F.col("r")).alias("right_rows"))
    a = a.withColumns({"left_join_rows": F.col("both_sides") + F.col("left_only"),
                       "right_join_rows": F.col("both_sides") + F.col("right_only"),
                       "outer_join_rows": F.col("both_sides") + F.col("left_only") + F.col("right_only"),
                       "cross_join_rows": F.col("left_rows").cast("decimal(38,0)") * F.col("right_rows")})
    rule = {"left": F.col("left_join_rows") == F.col("left_rows"),
            "right": F.col("right_join_rows") == F.col("right_rows"),
            "inner": (F.col("both_sides") <= F.col("left_rows")) & (F.col("both_sides") <= F.col("right_rows")),
            "outer": F.col("outer_join_rows") >= F.greatest("left_rows", "right_rows"),
            "cross": F.col("cross_join_rows") == F.col("left_rows").cast("decimal(38,0)") * F.col("right_rows")}[how]
    return a.withColumn("how", F.lit(how)).withColumn("row_rule_ok", rule)


def m1_violations(right: DataFrame, keys: list[str]) -> DataFrame:
    """Right-side keys that break a many-to-one join (count > 1)."""
    return right.groupBy(*keys).agg(F.count(F.lit(1)).alias("count")).where(F.col("count") > 1)


def keep_last(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """``drop_duplicates(keep='last')`` -- the last row per key in ``order``.

    ``max`` of a struct led by the order columns is a partial aggregation, so
    a key holding a large share of the rows is combined map-side.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    best = F.max(F.struct(*[F.col(c) for c in order], *[F.col(c) for c in rest])).alias("_m")
    return df.groupBy(*keys).agg(best).select(*keys, *[F.col(f"_m.{c}").alias(c) for c in order + rest])


def with_row_count(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Count rows as a side effect of the next action (no extra job).

    ``obs.get['rows'] == 0`` after the action flags an empty step.
    """
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs
