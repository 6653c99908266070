"""Test-month features, result assembly, business rules and error summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dosecast.functions.months import fold_month
from dosecast.functions.scalars import guarded_ratio
from dosecast.operators.extract import PAIR, PAIR4
from dosecast.params import DEFAULT, Params
from dosecast.session import large


def test_features(rem: DataFrame, snap: DataFrame, usage: DataFrame, assign: DataFrame,
                  test_month: int, p: Params = DEFAULT, carry: tuple[str, ...] = ()) -> DataFrame:
    """Features of every trained pair in the test month; ``carry`` columns come along.

    A removal row of the month wins; otherwise the snapshot row with usage
    (zero when missing) and target 0; a pair with neither stays unscored.
    Both branches are whole-table joins, unioned -- no per-pair lookups.
    """
    a = assign.select(*PAIR4, "model_key", "months_w_removals")
    feats = [F.col(f).cast("double").alias(f) for f in p.features]
    r = (rem.where(F.col("month") == test_month).join(a, PAIR4)
            .select("model_key", *PAIR4, "month", "months_w_removals", *carry, *feats,
                    F.col("transactionquantity").alias("y"), F.lit("removal").alias("source")))
    u = usage.where(F.col("month") == test_month).select(*PAIR4, "usage100")
    s = (snap.where(F.col("month") == test_month).join(a, PAIR4)
             .join(r.select(*PAIR4), PAIR4, "left_anti")
             .join(u, PAIR4, "left")
             .fillna(0, subset=["usage100"])
             .select("model_key", *PAIR4, "month", "months_w_removals", *carry, *feats,
                     F.lit(0.0).alias("y"), F.lit("snapshot").alias("source")))
    return r.unionByName(s)


def unscored_pairs(assign: DataFrame, scored: DataFrame) -> DataFrame:
    """Trained pairs without a test row (or without a model)."""
    return assign.join(scored.select(*PAIR4), PAIR4, "left_anti")


def modified_predictions(res: DataFrame, p: Params = DEFAULT, cutoff: DataFrame | None = None) -> DataFrame:
    """P6 (+ J12): floor, >= 0, <= inventory; the less conservative form is capped
    by the pair's cut-off (inner join) or by the fixed ``prediction_cutoff``."""
    y = F.col("y_predict")
    mod = F.when(y < 0, 0.0).otherwise(F.floor(y).cast("double"))
    less = F.floor(y).cast("double")
    out = (res.withColumn("modified_y_predict", F.least(mod, F.col("inventoryquantity")))
              .withColumn("modified_y_predict_less_cons", F.when(less < 0, 0.0).otherwise(less)))
    lc = F.col("modified_y_predict_less_cons")
    if cutoff is not None:
        key = [c for c in ("train_start", *PAIR) if c in cutoff.columns]
        out = (out.join(cutoff.select(*key, "max_removal", "prediction_cutoff"), key)
                  .withColumn("modified_y_predict_less_cons",
                              F.when(lc > F.col("prediction_cutoff"), F.col("prediction_cutoff")).otherwise(lc)))
    else:
        out = out.withColumn("modified_y_predict_less_cons",
                             F.when(lc > p.prediction_cutoff, F.lit(p.prediction_cutoff)).otherwise(lc))
    return out


def dashboard_estimate(res: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """Baseline floor(45 % of inventory) when 0 <= dist_eed <= 120, else 0.  Results without ``dist_eed`` take the
    category ``dist_eed_120``: 1 within the days (the baseline holds), 2 past the EED (the model's estimate stays)."""
    if "dist_eed" in res.columns:
        d = F.col("dist_eed")
        due, near = (d <= p.baseline_days) & (d >= 0), d <= p.baseline_days
    else:
        d = F.col("dist_eed_120")
        due, near = d == 1, d.isin(1, 2)
    dash = F.when(due, F.floor(F.lit(p.baseline_pct) * F.col("inventoryquantity")).cast("double")).otherwise(0.0)
    return (res.withColumn("dashboard_estimate", dash)
               .withColumn("modified_y_predict_120", F.when(near, F.col("modified_y_predict")).otherwise(0.0))
               .withColumn("MSE_Dashboard", (F.col("dashboard_estimate") - F.col("y_df")) ** 2)
               .withColumn("MAE_Dashboard", F.abs(F.col("dashboard_estimate") - F.col("y_df"))))


def estimate_errors(res: DataFrame) -> DataFrame:
    """Squared / absolute errors of the model and the guarded ratio."""
    e = F.col("modified_y_predict_less_cons") - F.col("y_df")
    return (res.withColumn("MSE_Estimator_Model", e ** 2)
               .withColumn("MAE_Estimator_Model", F.abs(e))
               .withColumn("Predicted_to_Actual", guarded_ratio("modified_y_predict_less_cons", "y_df")))


def result_table(scored: DataFrame, p: Params = DEFAULT, cutoff: DataFrame | None = None) -> DataFrame:
    """P10: one row per scored test row with raw and normalised features, then P6-P8."""
    r = scored.withColumnRenamed("y", "y_df")
    return estimate_errors(dashboard_estimate(modified_predictions(r, p, cutoff), p))


def error_summary(res: DataFrame, keys=("skclientkey",)) -> DataFrame:
    """RMSE of both estimators, MAE, max ratio per client (x month x setting)."""
    return res.groupBy(*keys).agg(
        F.sqrt(F.avg("MSE_Dashboard")).alias("RMSE_Dashboard"),
        F.sqrt(F.avg("MSE_Estimator_Model")).alias("RMSE_Estimator"),
        F.avg("MAE_Estimator_Model").alias("MAE_Estimator"),
        F.max("Predicted_to_Actual").alias("Max_Error_Percentage"))


def group_rule(profile: DataFrame, res: DataFrame, start, test_month, p: Params = DEFAULT, keys=PAIR) -> DataFrame:
    """P11 + P12 (+ J13): pooled-tier rule on the profile joined to the test result.

    k = 2..5: 0 when dist_eed > 90 or < 0; otherwise keep the estimate only
    if frequency < f_k and the last removal is recent; k > 5 and k = 1 keep.
    ``start`` and ``test_month`` are months, or columns of the window where ``keys`` holds it.
    """
    j = profile.join(large(res.select(*keys, "max_par_level", "standardstockwithindispensingdeviceflag", "usage100",
                                "inventoryquantity", "dist_eed", "y_df", "y_predict",
                                "modified_y_predict_less_cons", "dashboard_estimate", "MSE_Dashboard",
                                "MSE_Estimator_Model", "MAE_Estimator_Model", "MAE_Dashboard")), list(keys))
    k, d = F.col("Month_w_Removal_count"), F.col("dist_eed")
    pooled = k.between(p.pool_min, p.own_model_min)
    first = F.when(pooled & ((d > p.group_days) | (d < 0)), 0.0).otherwise(F.col("modified_y_predict_less_cons"))
    tm = fold_month(F.lit(test_month) if isinstance(test_month, int) else test_month, start)
    keep = (k > p.own_model_min) | (k == 1)
    freq = dict(p.freq_limits)
    rec = dict(p.recency_months)
    for kk in sorted(freq):
        keep = keep | ((k == kk) & (F.col("Frequency_of_Removals") < freq[kk])
                       & (F.col("Last_Removal_month") >= tm - rec[kk]))
    return (j.withColumn("y_removal_group", F.when(keep, first).otherwise(0.0))
             .withColumn("MSE_Group_Model", (F.col("y_df") - F.col("y_removal_group")) ** 2)
             .withColumn("MAE_Group_Model", F.abs(F.col("y_df") - F.col("y_removal_group"))))


def all_pairs_test(elig: DataFrame, pairs0: DataFrame, test_month: int) -> DataFrame:
    """Every eligible row of the test month with its training count (0 if none)."""
    t = elig.where(F.col("month") == test_month)
    return (t.join(pairs0.select(*PAIR4, "count"), PAIR4, "left")
             .fillna(0, subset=["transactionquantity", "count"]))


def one_zero_rule(allp: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """Rule for pairs with zero or one removal month (script form).

    Every row gets count 1 and the baseline floor(45 % of inventory) when
    0 <= dist_eed <= 120, else 0.
    """
    d = F.col("dist_eed")
    cat = F.when(d > p.baseline_days, 0).when(d < 0, 2).otherwise(1)
    x = (allp.withColumn("Month_w_Removal_count", F.lit(1).cast("long"))
             .withColumn("dist_eed_120", cat)
             .withColumn("y_removal_group",
                         F.when(cat == 1, F.floor(F.lit(p.baseline_pct) * F.col("inventoryquantity")).cast("double"))
                          .otherwise(0.0))
             .withColumn("y_df", F.col("transactionquantity")))
    e = F.col("y_df") - F.col("y_removal_group")
    return (x.withColumn("MSE_Dashboard", e ** 2).withColumn("MAE_Dashboard", F.abs(e))
             .withColumn("MSE_Group_Model", e ** 2).withColumn("MAE_Group_Model", F.abs(e)))


def one_month_rule_nb(g: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """P15 (notebook form): for count 1, 45 % of the *estimate* when the EED
    is within 0..120 days, 0 otherwise; other counts keep their estimate."""
    d = F.col("dist_eed")
    cat = F.when(d > p.baseline_days, 0).when(d < 0, 2).otherwise(1)
    one = F.col("Month_w_Removal_count") == 1
    return (g.withColumn("dist_eed_120", cat)
             .withColumn("y_removal_group",
                         F.when(one & (cat == 1), F.floor(F.lit(p.baseline_pct) * F.col("y_removal_group")))
                          .when(one, 0.0).otherwise(F.col("y_removal_group")).cast("double")))


OVERLAY_COLS = ["Month_w_Removal_count", "dist_eed", "inventoryquantity", "y_df", "y_removal_group",
                "MAE_Dashboard", "MAE_Group_Model"]


def duplicated_keys(upd: DataFrame, keys=PAIR) -> DataFrame:
    """Keys that an update holds more than once, with their number of rows."""
    return upd.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def overlay(base: DataFrame, upd: DataFrame, keys=PAIR, cols=OVERLAY_COLS, scope=("skclientkey",)) -> DataFrame:
    """``DataFrame.update`` -- non-null values of ``upd`` replace ``base`` by key.

    The update needs unique keys on the right.  Where they are not, the
    reference logs the error and returns the base rows unchanged; it runs client
    by client, so only the clients (``scope``) with a duplicated key keep their
    base rows.  ``duplicated_keys`` reports them.
    """
    # one row per key on the right (no fan-out of the base rows); with a
    # duplicated key the client's values are ignored anyway
    u = upd.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"),
                               *[F.first(c).alias(f"_u_{c}") for c in cols])
    bad = duplicated_keys(upd, keys).select(*scope).distinct().withColumn("_bad", F.lit(True))
    j = base.join(large(u), list(keys), "left").join(F.broadcast(bad), list(scope), "left")   # bad: clients and windows
    return j.select(*[
        (F.when(F.col("_bad"), F.col(c)).otherwise(F.coalesce(F.col(f"_u_{c}"), F.col(c))).alias(c)
         if c in cols else F.col(c)) for c in base.columns])


def dollar_values(res: DataFrame, cost: DataFrame) -> DataFrame:
    """Unit cost of the shard's client x estimate, baseline and actual."""
    key = ["hdp_shardid", "skclientkey", "medid"]
    j = res.join(cost.select(*key, "unitcost"), key, "left")
    c = F.coalesce(F.col("unitcost"), F.lit(0.0))
    return j.select(*[k for k in ("train_start", *PAIR) if k in res.columns], "unitcost",
                    (c * F.col("modified_y_predict_less_cons")).alias("estimate_value"),
                    (c * F.col("dashboard_estimate")).alias("baseline_value"),
                    (c * F.col("y_df")).alias("actual_value"))
