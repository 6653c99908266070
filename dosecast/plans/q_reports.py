"""Reports and counts over all clients and training windows."""

from __future__ import annotations

from pyspark.sql import functions as F

from dosecast.operators import models as md
from dosecast.operators import report as rp
from dosecast.operators import rules as ru
from dosecast.operators import windows as wn
from dosecast.operators.backtest import WPAIR4, window_last_status
from dosecast.params import DEFAULT
from dosecast.plans.catalog import register
from dosecast.plans.q_model import AV, K, PAIR4_SPEC, ridge_views
from dosecast.plans.q_windows import KEY4, NORM, WKEY, WKEY4, WRES_SPEC, WV, back_test, stand_in
from dosecast.session import large, materialize

P = DEFAULT
METRICS = ["MAE_Dashboard", "MAE_Estimator_Model"]
LONG = " union all ".join(f"select train_start, skclientkey, months_w_removals, '{m}' as metric, {m} as value from aw_result" for m in METRICS)
OUTLIER = "(Predicted_to_Actual > 2 and Predicted_to_Actual < 10) or Predicted_to_Actual < 0.5"
RIDGE = AV | WV | {"aw_train_norm": f"select x.*, {', '.join(NORM)} from aw_train x join aw_scaler s using (model_key)"}
RIDGE |= ridge_views("aw_train_norm")


def long_errors(b):
    ids = ["train_start", "skclientkey", "months_w_removals"]
    # read by several passes, which take two of the results' columns: written once
    return rp.long_metrics(materialize(b.results(True).select(*ids, *METRICS), "errors"), ids, METRICS)


@register("all_window_describe", "train_start:l months_w_removals:l metric:s count:l mean:d std:d min:d q25:d q50:d q75:d max:d", f"""
select train_start, months_w_removals, metric, count(value) as count, avg(value) as mean, stddev_samp(value) as std, min(value) as min,
       quantile_cont(value, 0.25) as q25, quantile_cont(value, 0.5) as q50, quantile_cont(value, 0.75) as q75, max(value) as max
from ({LONG}) where months_w_removals <= 5 group by all""", WV)
def q_describe(t):
    """A11 for every window and pooled tier."""
    lng = long_errors(stand_in(t)).where(F.col("months_w_removals") <= P.own_model_min)
    return rp.describe(lng, ["train_start", "months_w_removals", "metric"])


@register("all_window_describe_individuals", "train_start:l metric:s count:l mean:d std:d min:d q25:d q50:d q75:d max:d", f"""
select train_start, metric, count(value) as count, avg(value) as mean, stddev_samp(value) as std, min(value) as min,
       quantile_cont(value, 0.25) as q25, quantile_cont(value, 0.5) as q50, quantile_cont(value, 0.75) as q75, max(value) as max
from ({LONG}) where months_w_removals > 5 group by all""", WV)
def q_describe_individuals(t):
    """A11 over the own-model pairs of every window."""
    lng = long_errors(stand_in(t)).where(F.col("months_w_removals") > P.own_model_min)
    return rp.describe(lng, ["train_start", "metric"])


@register("all_window_box", "train_start:l metric:s q1:d median:d q3:d mean:d whisker_lo:d whisker_hi:d n_outliers:l", """
select q.train_start, q.metric, q1, median, q3, mean,
       min(case when value between lo and hi then value end) as whisker_lo,
       max(case when value between lo and hi then value end) as whisker_hi,
       count(case when not (value between lo and hi) then 1 end) as n_outliers
from (select train_start, metric, quantile_cont(value, 0.25) as q1, quantile_cont(value, 0.5) as median,
             quantile_cont(value, 0.75) as q3, avg(value) as mean, q1 - 1.5 * (q3 - q1) as lo, q3 + 1.5 * (q3 - q1) as hi
      from aw_long group by all) q join aw_long using (train_start, metric)
group by q.train_start, q.metric, q1, median, q3, mean""", WV | {"aw_long": LONG})
def q_box(t):
    """A15 for every window."""
    return rp.box_stats(long_errors(stand_in(t)), ["train_start", "metric"])


@register("all_window_ratio_outliers", WRES_SPEC, f"select * from aw_result where {OUTLIER}", WV)
def q_outliers(t):
    """F18 for every window."""
    return rp.ratio_outliers(stand_in(t).results(True))


@register("all_window_outlier_counts", "train_start:l skclientkey:l model_key:s n:l",
          f"select train_start, skclientkey, model_key, count(*) as n from aw_result where {OUTLIER} group by all", WV)
def q_outlier_counts(t):
    """F18 per model of every window."""
    return rp.ratio_outliers(stand_in(t).results(True)).groupBy("train_start", "skclientkey", "model_key").agg(F.count(F.lit(1)).alias("n"))


@register("all_window_pair_counts", "skclientkey:l train_start:l pairs:l",
          "select skclientkey, train_start, count(*) as pairs from aw_assign group by all", WV)
def q_pair_counts(t):
    """A6 for every window."""
    b = back_test(t)
    return wn.pair_count_by_client(wn.all_window_pairs(b.removal_rows, b.windows, P.window_months, P.min_pair_count))


@register("all_window_histogram", "skclientkey:l train_start:l bin:l pairs:l", f"""
select skclientkey, train_start, count as bin, count(*) as pairs
from (select {WKEY4}, count(*) as count from aw_rows group by {WKEY4}) where count <= 12 group by all""", WV)
def q_histogram(t):
    """A13 for every window."""
    b = back_test(t)
    return wn.removal_histogram(wn.all_window_pairs(b.removal_rows, b.windows, P.window_months, 0))


@register("all_window_modeled_pairs", "skclientkey:l train_start:l modeled_pairs:l unscored_pairs:l", f"""
select skclientkey, train_start, count(*) as modeled_pairs, count(*) - count(s.month) as unscored_pairs
from aw_assign a left join aw_test s using ({WKEY4}) group by all""", WV)
def q_modeled(t):
    """A21 and J10 for every window: trained pairs, and those of them without a test row."""
    return stand_in(t).pair_counts


@register("all_window_unscored", "train_start:l " + PAIR4_SPEC + " model_key:s", f"""
select {WKEY4}, model_key from aw_assign a anti join aw_test s using ({WKEY4})""", WV)
def q_unscored(t):
    """J10 for every window, as a table."""
    b = stand_in(t)
    return b.unscored


@register("all_window_dollars", "train_start:l skclientkey:l medid:s device_naturalkey:l unitcost:d estimate_value:d baseline_value:d "
          "actual_value:d", f"""
select {WKEY}, c.unitcost, coalesce(c.unitcost, 0.0) * modified_y_predict_less_cons as estimate_value,
       coalesce(c.unitcost, 0.0) * dashboard_estimate as baseline_value, coalesce(c.unitcost, 0.0) * y_df as actual_value
from aw_result r left join (select hdp_shardid, skclientkey, medid, unitcost from latest_cost) c using (hdp_shardid, skclientkey, medid)""", WV)
def q_dollars(t):
    """P17 for every window."""
    b = stand_in(t)
    return ru.dollar_values(b.results(True), b.inputs.cost)


@register("all_window_ridge_models", "model_key:s intercept:d " + " ".join(f"w{i}:d" for i in range(K)) + " n_rows:l r2:d",
          "select * from ridge_m", RIDGE)
def q_ridge(t):
    """M5 for every window."""
    m = back_test(t, model="Ridge").models
    return m.select("model_key", "intercept", *[F.col("coef")[i].alias(f"w{i}") for i in range(K)], "n_rows", "r2")


@register("all_window_ridge_r2", "model_key:s n:l r2:d", "select model_key, n_rows as n, r2 from ridge_m", RIDGE)
def q_ridge_r2(t):
    """M7 for every window, from the predictions of the training rows."""
    b = back_test(t, model="Ridge")
    return md.model_r2(md.score(wn.apply_scaler(b.train, b.scaler, P), b.models, P))


@register("all_window_unloaded", "train_start:l " + PAIR4_SPEC + " last_month:l isinactive:l", f"""
select train_start, {KEY4}, max(month) as last_month, max_by(isinactive, month) as isinactive
from snap_feat s join aw_windows w using (skclientkey) where month between train_start and train_start + 11
group by all having max_by(isinactive, month) = 1""", WV)
def q_unloaded(t):
    """J7 + S10 for every window: pairs fully unloaded in their last month of the window."""
    b = back_test(t)
    return window_last_status(b.inputs.snap, b.windows, P).where(F.col("isinactive") == 1)


@register("all_window_not_unloaded", f"train_start:l {PAIR4_SPEC} month:l y:d", f"""
select {WKEY4}, month, y from aw_train anti join (
  select train_start, {KEY4} from snap_feat s join aw_windows w using (skclientkey) where month between train_start and train_start + 11
  group by all having max_by(isinactive, month) = 1) using ({WKEY4})
semi join (select train_start, {KEY4} from snap_feat s join aw_windows w using (skclientkey) where month between train_start and train_start + 11)
  using ({WKEY4})""", WV)
def q_not_unloaded(t):
    """J8 for every window: training rows of pairs that are not unloaded in their last month."""
    b = back_test(t)
    last = window_last_status(b.inputs.snap, b.windows, P).where(F.col("isinactive") != 1).select(*WPAIR4)
    return b.train.join(large(last), WPAIR4, "left_semi")
