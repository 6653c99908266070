"""Report tables: describes, box statistics, coverage, filter shares, checks.

The numbers behind the reference's plots and CSV summaries; every report is
one or two group-bys, no driver loops.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dosecast.operators.quantiles import quantiles, with_quantiles
from dosecast.params import DEFAULT, Params
from dosecast.session import materialize


def long_metrics(df: DataFrame, ids: list[str], metrics: list[str]) -> DataFrame:
    """Wide metric columns to (ids..., metric, value)."""
    return df.select(*ids, *[F.col(m).cast("double").alias(m) for m in metrics]) \
             .unpivot(ids, metrics, "metric", "value")


def describe(df: DataFrame, by: list[str]) -> DataFrame:
    """Count, mean, sample std, min, exact linear quartiles, max per group, whatever the group's size."""
    v = F.col("value")
    g = df.groupBy(*by).agg(F.count(v).alias("count"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"),
                            F.min(v).alias("min"), F.max(v).alias("max"))
    q = quantiles(df, by, "value", {"q25": 0.25, "q50": 0.5, "q75": 0.75})
    return with_quantiles(g, q, by).select(*by, "count", "mean", "std", "min", "q25", "q50", "q75", "max")


def box_stats(df: DataFrame, by: list[str]) -> DataFrame:
    """Quartiles, mean, 1.5 IQR whiskers (most extreme points inside) and outlier count."""
    v = F.col("value")
    q = materialize(quantiles(df, by, "value", {"q1": 0.25, "median": 0.5, "q3": 0.75}), "box_quartiles")
    fences = q.select(*by, (F.col("q1") - 1.5 * (F.col("q3") - F.col("q1"))).alias("lo_fence"),
                      (F.col("q3") + 1.5 * (F.col("q3") - F.col("q1"))).alias("hi_fence"))
    j = with_quantiles(df.select(*by, "value"), fences, by)
    inside = (v >= F.col("lo_fence")) & (v <= F.col("hi_fence"))
    w = j.groupBy(*by).agg(F.avg(v).alias("mean"), F.min(F.when(inside, v)).alias("whisker_lo"),
                           F.max(F.when(inside, v)).alias("whisker_hi"), F.count(F.when(~inside, 1)).alias("n_outliers"))
    return with_quantiles(w, q, by).select(*by, "q1", "median", "q3", "mean", "whisker_lo", "whisker_hi", "n_outliers")


def strict_keep(p: Params = DEFAULT) -> dict:
    """Report-variant filters (nulls dropped): column -> keep condition."""
    name = F.lower(F.col("medfullname"))
    hit = F.lit(False)
    for k in p.name_keys:
        hit = hit | name.contains(k)
    return {
        "non_drug_items": F.coalesce(F.col("meditemflag") == 1, F.lit(False)),
        "insulins": F.coalesce(F.col("medfullname").isNotNull() & ~hit, F.lit(False)),
        "anesthesia_stations": F.coalesce(F.col("devicetypekey").isin(*p.device_types), F.lit(False)),
        "outofrange_inv": F.coalesce(F.col("inventoryquantity") <= p.inv_cutoff, F.lit(False)),
    }


def coverage(panel: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """Per client and month -- rows, rows removed by each filter, total removed,
    remaining, rows with the EED within 0..120 days.  One ``groupBy``."""
    keep = strict_keep(p)
    all_keep = keep["non_drug_items"] & keep["insulins"] & keep["anesthesia_stations"] & keep["outofrange_inv"]
    aggs = [F.count(F.lit(1)).alias("total_pairs")]
    aggs += [F.count_if(~c).alias(n) for n, c in keep.items()]
    aggs += [F.count_if(~all_keep).alias("total_pairs_removed"), F.count_if(all_keep).alias("pairs_remaining"),
             F.count_if(F.col("dist_eed_120") == 1).alias("pairs_eed_between_0_and_120")]
    return panel.groupBy("skclientkey", "month").agg(*aggs)


def filter_share(panel: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """Rows removed by each filter per client, count and share, long format.

    ``all_filters`` is the plain sum of the four (rows hit twice count twice).
    """
    keep = strict_keep(p)
    wide = panel.groupBy("skclientkey").agg(
        F.count(F.lit(1)).alias("_n"), *[F.count_if(~c).alias(n) for n, c in keep.items()])
    wide = wide.withColumn("all_filters", sum(F.col(n) for n in keep))
    names = list(keep) + ["all_filters"]
    lng = wide.unpivot(["skclientkey", "_n"], names, "filter", "removed")
    return lng.select("skclientkey", "filter", F.col("removed").cast("long").alias("removed"),
                      (F.col("removed") / F.col("_n")).alias("proportion"))


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("count")).where(F.col("count") > 1)


def nameless(panel: DataFrame) -> DataFrame:
    """Medicines without a name."""
    return panel.where(F.col("medfullname").isNull()).select("skclientkey", "medid").distinct()


def flag_drift(rows: DataFrame) -> DataFrame:
    """Pairs whose standard-stock flag changes over time (0 < mean < 1), per client."""
    m = rows.groupBy("skclientkey", "medid", "device_naturalkey").agg(
        F.avg("standardstockwithindispensingdeviceflag").alias("m"))
    return m.groupBy("skclientkey").agg(F.count(F.lit(1)).alias("pairs"),
                                        F.count_if((F.col("m") > 0) & (F.col("m") < 1)).alias("drifting_pairs"))


def ratio_outliers(res: DataFrame) -> DataFrame:
    """estimate/actual ratio in (2, 10) or below 0.5."""
    r = F.col("Predicted_to_Actual")
    return res.where(((r > 2) & (r < 10)) | (r < 0.5))


def score_histogram(scores: DataFrame, col: str = "y_predict", bins: int = 10) -> DataFrame:
    """Equal-width histogram of the non-negative scores (the bounds are one row of one aggregation)."""
    s = scores.where(F.col(col) >= 0)
    bounds = s.agg(F.struct(F.min(col).alias("lo"), F.max(col).alias("hi")).alias("b")).scalar()
    lo, hi = bounds["lo"], bounds["hi"]
    width = F.when(hi > lo, (hi - lo) / bins).otherwise(F.lit(1.0))
    b = F.least(F.floor((F.col(col) - lo) / width), F.lit(bins - 1)).cast("int")
    return s.groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("count"),
                                         F.min(col).alias("bin_min"), F.max(col).alias("bin_max"))
