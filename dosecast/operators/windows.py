"""Training windows, pair counts, model tiers and the training rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dosecast.functions.months import fold_month, mi_of_yyyymm, yyyymm_of_mi
from dosecast.operators.extract import PAIR, PAIR4
from dosecast.params import DEFAULT, Params


def training_months(usage: DataFrame, window_months: int = 12) -> DataFrame:
    """T3 per client: the n latest months are test months, n = months - 13.

    The distinct months of a client are bounded by calendar time, so the
    per-client window after ``distinct`` is small whatever the data size.
    """
    u = usage.withColumnRenamed("clientkey", "skclientkey")
    return test_months(u.select("skclientkey", mi_of_yyyymm("year_month").alias("mi")), window_months)


def test_months(months: DataFrame, window_months: int = 12) -> DataFrame:
    """``training_months`` of the months (skclientkey, mi) of the usage rows."""
    m = months.distinct()
    w = Window.partitionBy("skclientkey")
    r = (m.withColumn("n", F.count(F.lit(1)).over(w) - (window_months + 1))
          .withColumn("rk", F.row_number().over(w.orderBy(F.col("mi").desc()))))
    return (r.where(F.col("rk") <= F.col("n"))
             .select("skclientkey",
                     F.col("mi").alias("test_month"),
                     (F.col("mi") - window_months).alias("train_start"),
                     yyyymm_of_mi(F.col("mi")).alias("test_yyyymm"),
                     yyyymm_of_mi(F.col("mi") - window_months).alias("train_start_yyyymm")))


def month_except(usage: DataFrame, tm: DataFrame) -> DataFrame:
    """Months of the usage that are not test months."""
    m = usage.select(F.col("clientkey").alias("skclientkey"), mi_of_yyyymm("year_month").alias("mi")).distinct()
    return m.subtract(tm.select("skclientkey", F.col("test_month").alias("mi")))


def training_pairs(rows: DataFrame, start: int, months: int = 12, min_cnt: int = 1) -> DataFrame:
    """A5: removal months per pair in the window, ``count > min_cnt``."""
    return (rows.where(F.col("month").between(start, start + months - 1))
                .groupBy(*PAIR4).agg(F.count(F.lit(1)).alias("count"))
                .where(F.col("count") > min_cnt))


def pair_counts(rows: DataFrame, start: int, months: int) -> DataFrame:
    """A5, pair-count form: a one-month request looks one year on and keeps count > 0."""
    if months == 1:
        start = start + 12
    return training_pairs(rows, start, months, min(1, months - 1))


def pair_count_by_client(pairs: DataFrame) -> DataFrame:
    """Number of pairs per client (and window when present)."""
    keys = ["skclientkey"] + (["train_start"] if "train_start" in pairs.columns else [])
    return pairs.groupBy(*keys).agg(F.count(F.lit(1)).alias("pairs"))


def removal_histogram(pairs: DataFrame, max_bin: int = 12) -> DataFrame:
    """Pairs per right-closed bin (k-1, k] of removal months, k = 1..12, per client."""
    c = F.col("count")
    keys = ["skclientkey"] + (["train_start"] if "train_start" in pairs.columns else [])
    return (pairs.where((c > 0) & (c <= max_bin))
                 .groupBy(*keys, F.ceil(c).cast("int").alias("bin"))
                 .agg(F.count(F.lit(1)).alias("pairs")))


def prediction_cutoff(removals: DataFrame, start: int, months: int = 12, margin: float = 0.0) -> DataFrame:
    """The pair's largest monthly removal in the window x (1 + margin), half-even."""
    w = removals.where(F.col("month").between(start, start + months - 1))
    return (w.groupBy(*PAIR).agg(F.max("transactionquantity").alias("max_removal"))
             .withColumn("prediction_cutoff", F.bround(F.col("max_removal") * (1 + margin), 0)))


def two_or_more_flag(rows: DataFrame, start: int, months: int = 12) -> DataFrame:
    """A10 (intended meaning): per pair and window, at least two removal months."""
    w = rows.where(F.col("any_expiry_removal") & F.col("month").between(start, start + months - 1))
    cnt = w.groupBy(*PAIR).agg(F.count(F.lit(1)).alias("n"))
    return (rows.join(cnt, PAIR, "left")
                .withColumn("two_or_more", F.coalesce(F.col("n") >= 2, F.lit(False)))
                .drop("n"))


def model_assignment(pairs: DataFrame, p: Params = DEFAULT, grouped: bool = True) -> DataFrame:
    """M1 (and M9 with ``grouped=False``): a model key per training pair.

    More than ``own_model_min`` removal months -> the pair's own model;
    ``pool_min`` .. ``own_model_min`` -> one pooled model per client and k.
    """
    c = F.col("count")
    own = F.concat_ws("|", F.lit("pair"), "skclientkey", "medid", "device_naturalkey")
    pool = F.concat_ws("|", F.lit("pool"), "skclientkey", c)
    if grouped:
        key = F.when(c > p.own_model_min, own).when(c >= p.pool_min, pool)
    else:
        key = own
    start = F.col("train_start") if "train_start" in pairs.columns else F.lit(p.train_start)
    return (pairs.withColumn("model_key", F.concat_ws("|", start.cast("string"), key))
                 .where(key.isNotNull())
                 .withColumn("tier", F.when(c > p.own_model_min, "own").otherwise("pool"))
                 .withColumnRenamed("count", "months_w_removals"))


def training_rows(rows: DataFrame, assign: DataFrame, start: int, months: int = 12,
                  p: Params = DEFAULT) -> DataFrame:
    """M2 + J9: window rows of the assigned pairs with features and target."""
    w = rows.where(F.col("month").between(start, start + months - 1))
    a = assign.select(*PAIR4, "model_key", "months_w_removals")
    return w.join(a, PAIR4).select(
        "model_key", *PAIR4, "month", "months_w_removals",
        *[F.col(f).cast("double").alias(f) for f in p.features],
        F.col("transactionquantity").alias("y"))


def scaler(train: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """M3 fit: per model min and max of each feature (partial aggregation)."""
    aggs = []
    for f in p.features:
        aggs += [F.min(f).alias(f"{f}_min"), F.max(f).alias(f"{f}_max")]
    return train.groupBy("model_key").agg(*aggs)


def apply_scaler(rows: DataFrame, sc: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """M3 apply: ``(x - min) / range``, a zero range divides by 1; no clipping."""
    j = rows.join(sc, "model_key")
    out = {}
    for f in p.features:
        rng = F.col(f"{f}_max") - F.col(f"{f}_min")
        out[f"{f}_norm"] = (F.col(f) - F.col(f"{f}_min")) / F.when(rng == 0, F.lit(1.0)).otherwise(rng)
    return j.withColumns(out).drop(*[c for f in p.features for c in (f"{f}_min", f"{f}_max")])


def training_profile(train: DataFrame, start, single: float = 1.0, keys=PAIR) -> DataFrame:
    """Per pair first/last removal month (folded), counts, means, frequency.

    ``start`` is a month, or the column of the window's start where ``keys`` holds it.
    """
    g = train.groupBy(*keys).agg(
        F.max("month").alias("_last"), F.min("month").alias("_first"),
        F.count("y").alias("Month_w_Removal_count"),
        F.avg("inventoryquantity").alias("_avg_inv"),
        F.min("y").alias("Min_Removal_Qty"), F.max("y").alias("Max_Removal_Qty"),
        F.avg("y").alias("_avg_y"))
    last, first = fold_month("_last", start), fold_month("_first", start)
    n = F.col("Month_w_Removal_count")
    return g.select(
        *keys, last.alias("Last_Removal_month"), first.alias("First_Removal_month"), n,
        F.col("_avg_inv").cast("long").alias("Avg_Inventory_Qty_training_peroid"),
        "Min_Removal_Qty", "Max_Removal_Qty",
        F.col("_avg_y").cast("long").alias("Avg_Removal_Qty"),
        F.when(n == 1, F.lit(single)).otherwise(F.try_divide((last - first).cast("double"), n - 1))
         .alias("Frequency_of_Removals"))


def window_rows(rows: DataFrame, windows: DataFrame, months: int = 12) -> DataFrame:
    """M10 input: every row once per training window that contains it.

    A row of month m belongs to the windows starting in m-11 .. m: a bounded
    12-fold explode and an equi-join with the client's window starts, not a
    range join.
    """
    e = rows.withColumn("train_start", F.explode(F.sequence(F.col("month") - (months - 1), F.col("month"))))
    ws = windows.select("skclientkey", "train_start").distinct()
    return e.join(F.broadcast(ws), ["skclientkey", "train_start"])   # clients x months


def all_window_pairs(rows: DataFrame, windows: DataFrame, months: int = 12, min_cnt: int = 1) -> DataFrame:
    """Training pairs of every client and window in one job."""
    e = window_rows(rows, windows, months)
    return (e.groupBy("train_start", *PAIR4).agg(F.count(F.lit(1)).alias("count"))
             .where(F.col("count") > min_cnt))


def grouped_rows(rows: DataFrame, pairs: DataFrame, start: int, months: int = 12) -> DataFrame:
    """Window rows of a pair list (inner join on the unique pairs; keeps ``count``)."""
    w = rows.where(F.col("month").between(start, start + months - 1))
    return w.join(pairs.select(*PAIR, "count"), PAIR)


def debug_pairs(pairs: DataFrame, n: int = 10) -> DataFrame:
    """T4: a small deterministic subset of pairs for debugging runs (an option, never a default)."""
    return pairs.orderBy("skclientkey", "medid", "device_naturalkey").limit(n)


def all_window_training(rows: DataFrame, windows: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """M10 + M1 + M2 for every client and window at once.

    Each removal row is exploded into the (at most 12) windows containing it;
    pairs, tiers and model keys are computed per window, and the model key
    carries the window start, so one ``groupBy('model_key')`` fits them all.
    """
    e = window_rows(rows, windows, p.window_months)
    # A pair's rows of a window are at most its months: they are counted where they lie, without a join back.
    pair = Window.partitionBy(*PAIR4, "train_start")
    counted = e.dropna(subset=PAIR4).withColumn("count", F.count(F.lit(1)).over(pair)).where(F.col("count") > p.min_pair_count)
    return model_assignment(counted, p).select(
        "model_key", "train_start", *PAIR4, "month", "months_w_removals",
        *[F.col(f).cast("double").alias(f) for f in p.features],
        F.col("transactionquantity").alias("y"))
