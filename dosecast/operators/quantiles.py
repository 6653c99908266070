"""Exact quantiles of groups of any size.

A group's values are counted first (one row for each distinct value), then each
wanted rank is searched: the interval that holds it is cut into ``BINS`` equal
bins, a partial aggregation counts them, and the one bin that holds the rank
becomes the next interval.  An interval of at most ``BINS`` distinct values is cut
by value, which ends its search.  No group is ever gathered: a task holds at
most the bins of one interval, and 1024 times more values cost one more pass.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from dosecast.session import materialize

BINS = 1024


def _same(left: str, right: str, keys: list[str]) -> Column:
    """Equality of the keys on both sides, null with null."""
    return reduce(lambda a, b: a & b, [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys], F.lit(True))


def _ranks(probs: list[float]) -> Column:
    """The ranks (from 0) between which each quantile of ``_n`` values lies."""
    at = [F.col("_n").cast("double") * p - p for p in probs]
    return F.array_distinct(F.array(*[f(a).cast("long") for a in at for f in (F.floor, F.ceil)]))


def at_ranks(df: DataFrame, by: list[str], value: str, probs: list[float], bins: int = BINS) -> DataFrame:
    """``by``, _n (values of the group), _rank, _value: the values at the ranks that ``probs`` need."""
    values = df.where(F.col(value).isNotNull()).groupBy(*by, F.col(value).cast("double").alias("_v")).agg(F.count(F.lit(1)).alias("_c"))
    values = materialize(values, "quantile_values")
    state = values.groupBy(*by).agg(F.sum("_c").alias("_n"), F.count(F.lit(1)).alias("_d"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    state = state.select(*by, "_n", F.explode(_ranks(probs)).alias("_rank"), "_lo", "_hi", F.lit(0).cast("long").alias("_before"), "_d")
    found = []
    while True:
        seen = Observation("quantile_state")
        state = materialize(state, "quantile_state", (seen, F.count_if(F.col("_lo") < F.col("_hi")).alias("open")))
        found.append(state.where(F.col("_lo") == F.col("_hi")).select(*by, "_n", "_rank", F.col("_lo").alias("_value")))
        if not seen.get["open"]:
            return reduce(DataFrame.unionByName, found)
        state = _narrowed(values, state.where(F.col("_lo") < F.col("_hi")), by, bins)


def _narrowed(values: DataFrame, state: DataFrame, by: list[str], bins: int) -> DataFrame:
    """Every open rank's interval cut to the bin that holds it."""
    cut = state.select(*by, "_lo", "_hi", "_d").distinct()
    inside = values.alias("v").join(cut.alias("s"), _same("v", "s", by) & (F.col("v._v") >= F.col("s._lo")) & (F.col("v._v") <= F.col("s._hi")))
    # Halves first: the width of the largest interval is no double.
    share = (F.col("_v") / 2 - F.col("_lo") / 2) / (F.col("_hi") / 2 - F.col("_lo") / 2)
    number = F.when(F.col("_d") <= bins, F.col("_v")).otherwise(F.least(F.floor(share * bins), F.lit(bins - 1)).cast("double"))
    counted = inside.select(*[F.col(f"s.{k}").alias(k) for k in by], "_lo", "_hi", number.alias("_bin"), "_v", "_c").groupBy(
        *by, "_lo", "_hi", "_bin").agg(F.sum("_c").alias("_in"), F.count(F.lit(1)).alias("_d"), F.min("_v").alias("_from"), F.max("_v").alias("_to"))
    below = F.sum("_in").over(Window.partitionBy(*by, "_lo", "_hi").orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1))
    counted = counted.withColumn("_below", F.coalesce(below, F.lit(0)))
    first = F.col("s._before") + F.col("b._below")
    return state.alias("s").join(
        counted.alias("b"), _same("s", "b", [*by, "_lo", "_hi"]) & (F.col("s._rank") >= first) & (F.col("s._rank") < first + F.col("b._in"))).select(
        *[F.col(f"s.{k}").alias(k) for k in by], "s._n", "s._rank", F.col("b._from").alias("_lo"), F.col("b._to").alias("_hi"),
        first.alias("_before"), F.col("b._d").alias("_d"))


def quantiles(df: DataFrame, by: list[str], value: str, probs: dict[str, float], bins: int = BINS) -> DataFrame:
    """``by`` and a column for each of ``probs`` (name: share), interpolated between the two nearest ranks; groups without
    a value are missing."""
    at = at_ranks(df, by, value, list(probs.values()), bins)
    q = at.groupBy(*by).agg(F.max("_n").alias("_n"), F.map_from_entries(F.collect_list(F.struct("_rank", "_value"))).alias("_at"))

    def one(p: float) -> Column:
        place = F.col("_n").cast("double") * p - p
        lo, hi = F.floor(place).cast("long"), F.ceil(place).cast("long")
        a, b = F.col("_at")[lo], F.col("_at")[hi]
        return F.when(lo == hi, a).otherwise((hi - place) * a + (place - lo) * b)
    return q.select(*by, *[one(p).alias(name) for name, p in probs.items()])


def with_quantiles(stats: DataFrame, q: DataFrame, by: list[str]) -> DataFrame:
    """The group table ``stats`` with the columns of ``q`` (null for groups without a value)."""
    more = [c for c in q.columns if c not in by]
    return stats.alias("g").join(q.alias("q"), _same("g", "q", by), "left").select("g.*", *[f"q.{c}" for c in more])
