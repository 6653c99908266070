"""Back-test queries over all clients and training windows.

The checked ones run on the fixture's stand-in score, ``all_window_final_model``
on the fitted Huber models.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from dosecast.operators import backtest as bk
from dosecast.operators import panel as pn
from dosecast.params import DEFAULT
from dosecast.plans.catalog import register
from dosecast.plans.q_model import FEATS, PAIR4_SPEC
from dosecast.plans.q_rules import FINAL_SPEC, OV_COLS, RES_SPEC

P = DEFAULT
KEY4 = "hdp_shardid, skclientkey, medid, device_naturalkey"
WKEY4 = "train_start, " + KEY4
WKEY = "train_start, skclientkey, medid, device_naturalkey"
SCORE = "cast((device_naturalkey * 3 + cast(substr(medid, 7) as integer) * 7 + month) % 40 - 5 as double)"
X = [f"cast({f} as double) as {f}" for f in FEATS]
NORM = [f"(x.{f} - s.{f}_lo) / case when s.{f}_hi = s.{f}_lo then 1.0 else s.{f}_hi - s.{f}_lo end as {f}_norm"
        for f in FEATS]


def _result(scored: str, pair_cap: bool) -> str:
    """P6-P8 on scored rows: one step for each group of columns."""
    src = f"{scored} join aw_cutoff using ({WKEY})" if pair_cap else scored
    cap = "prediction_cutoff" if pair_cap else "50.0"
    return f"""
select *, power(modified_y_predict_less_cons - y_df, 2) as MSE_Estimator_Model,
       abs(modified_y_predict_less_cons - y_df) as MAE_Estimator_Model,
       power(dashboard_estimate - y_df, 2) as MSE_Dashboard, abs(dashboard_estimate - y_df) as MAE_Dashboard,
       case when y_df > 0 then modified_y_predict_less_cons / (y_df + 0.000001) else 0.0 end as Predicted_to_Actual
from (select * exclude (y), y as y_df, least(greatest(floor(y_predict), 0.0), inventoryquantity) as modified_y_predict,
             case when dist_eed <= 120 then least(greatest(floor(y_predict), 0.0), inventoryquantity) else 0.0 end
               as modified_y_predict_120,
             least(greatest(floor(y_predict), 0.0), {cap}) as modified_y_predict_less_cons,
             case when dist_eed between 0 and 120 then floor(0.45 * inventoryquantity) else 0.0 end as dashboard_estimate
      from {src})"""


WV = {
    "aw_windows": """
select clientkey as skclientkey, mi - 12 as train_start, mi as test_month
from (select clientkey, mi, count(*) over (partition by clientkey) - 13 as n,
             row_number() over (partition by clientkey order by mi desc) as place
      from (select distinct clientkey, cast(floor(year_month / 100) * 12 + year_month % 100 - 1 as integer) as mi
            from monthly_usage)) where place <= n""",
    "aw_rows": """
select w.train_start, r.* from removal_panel r
join aw_windows w on w.skclientkey = r.skclientkey and r.month between w.train_start and w.train_start + 11""",
    "aw_assign": f"""
select {WKEY4}, count(*) as months_w_removals,
       concat_ws('|', train_start, case when count(*) > 5 then 'pair' else 'pool' end, skclientkey,
                 case when count(*) > 5 then concat_ws('|', medid, device_naturalkey) else cast(count(*) as varchar) end)
         as model_key
from aw_rows group by {WKEY4} having count(*) > 1""",
    "aw_train": f"""
select model_key, {WKEY4}, month, months_w_removals, {', '.join(X)}, transactionquantity as y
from aw_rows join aw_assign using ({WKEY4})""",
    "aw_scaler": "select model_key, " + ", ".join(f"min({f}) as {f}_lo, max({f}) as {f}_hi" for f in FEATS)
                 + " from aw_train group by model_key",
    "aw_trial": "select *, train_start + 12 as month from aw_assign",
    "aw_test": f"""
select model_key, {WKEY4}, month, months_w_removals, {', '.join(X)}, transactionquantity as y, 'removal' as source
from removal_panel join aw_trial using ({KEY4}, month)
union all
select model_key, {WKEY4}, month, months_w_removals,
       {', '.join(X).replace('cast(usage100 as', 'cast(coalesce(usage100, 0) as')}, 0.0, 'snapshot'
from (select * from aw_trial anti join removal_panel using ({KEY4}, month))
join snap_feat using ({KEY4}, month)
left join (select {KEY4}, month, usage100 from usage_feat) using ({KEY4}, month)""",
    "aw_scored": f"""
select x.*, {', '.join(NORM)}, {SCORE} as y_predict from aw_test x join aw_scaler s using (model_key)""",
    "aw_train_scored": f"""
select x.*, {', '.join(NORM)}, {SCORE} as y_predict from aw_train x join aw_scaler s using (model_key)""",
    "aw_cutoff": f"""
select {WKEY}, max(transactionquantity) as max_removal, round_even(max(transactionquantity) * 1.0, 0) as prediction_cutoff
from monthly_removals r join aw_windows w using (skclientkey)
where month between train_start and train_start + 11 group by {WKEY}""",
    "aw_result": _result("aw_scored", True),
    "aw_result_fixed": _result("aw_scored", False),
    "aw_profile": f"""
select {WKEY}, max(month) - train_start + train_start % 12 + 1 as last_m, count(y) as k,
       case when count(y) = 1 then 1.0 else (max(month) - min(month)) / (count(y) - 1) end as gap
from aw_train group by {WKEY}""",
    "aw_limits": "select * from (values (2, 3.0, 4), (3, 2.5, 5), (4, 2.3, 5), (5, 2.0, 5)) v(k, gap_max, back)",
    "aw_group": f"""
select {WKEY}, p.k as Month_w_Removal_count, dist_eed, inventoryquantity, y_df, MAE_Dashboard,
       case when p.k = 1 or p.k > 5 then modified_y_predict_less_cons
            when dist_eed between 0 and 90 and gap < gap_max and last_m >= 13 + train_start % 12 - back
              then modified_y_predict_less_cons
            else 0.0 end as y_removal_group,
       abs(y_df - y_removal_group) as MAE_Group_Model
from aw_profile p join aw_result using ({WKEY}) left join aw_limits l on l.k = p.k""",
    "aw_all": f"""
select w.train_start, e.skclientkey, e.medid, e.device_naturalkey, cast(1 as bigint) as Month_w_Removal_count, dist_eed,
       inventoryquantity, coalesce(transactionquantity, 0) as y_df,
       case when dist_eed between 0 and 120 then floor(0.45 * inventoryquantity) else 0.0 end as y_removal_group,
       abs(y_df - y_removal_group) as MAE_Dashboard, abs(y_df - y_removal_group) as MAE_Group_Model
from eligible e join aw_windows w on w.skclientkey = e.skclientkey and w.test_month = e.month""",
}

WRES_SPEC = "train_start:l " + RES_SPEC
TRES_SPEC = WRES_SPEC.replace(" source:s", "")


def back_test(t, **kw) -> bk.WindowedBackTest:
    return bk.WindowedBackTest(pn.Inputs.shared(t, P), None, P, **kw)


def stand_in(t) -> bk.WindowedBackTest:
    return back_test(t, predictions="stand_in")


@register("all_window_results", WRES_SPEC + " max_removal:d prediction_cutoff:d", "select * from aw_result", WV)
def q_results(t):
    """M10 + P9 + P10 + J12: the test rows of every client and window with the pair cut-off."""
    return stand_in(t).results(True)


@register("training_results", TRES_SPEC, _result("aw_train_scored", False), WV)
def q_training_results(t):
    """P10, training side, of every client and window (fixed cap)."""
    return stand_in(t).training_results


@register("all_window_errors", """skclientkey:l train_start:l test_month:l is_pair_prediction_cutoff:b margin_percent:d
RMSE_Dashboard:d RMSE_Estimator:d MAE_Estimator:d Max_Error_Percentage:d""", """
select skclientkey, train_start, train_start + 12 as test_month, is_pair_prediction_cutoff, 0.0 as margin_percent,
       sqrt(avg(MSE_Dashboard)) as RMSE_Dashboard, sqrt(avg(MSE_Estimator_Model)) as RMSE_Estimator,
       avg(MAE_Estimator_Model) as MAE_Estimator, max(Predicted_to_Actual) as Max_Error_Percentage
from (select true as is_pair_prediction_cutoff, skclientkey, train_start, MSE_Dashboard, MSE_Estimator_Model,
             MAE_Estimator_Model, Predicted_to_Actual from aw_result
      union all
      select false, skclientkey, train_start, MSE_Dashboard, MSE_Estimator_Model, MAE_Estimator_Model,
             Predicted_to_Actual from aw_result_fixed)
group by all""", WV)
def q_errors(t):
    """A12 for every client, test month and setting."""
    return stand_in(t).errors


@register("all_window_final", "train_start:l " + FINAL_SPEC, f"""
select {WKEY}, {', '.join(f'coalesce(u.{c}, b.{c}) as {c}' for c in OV_COLS)}
from aw_all b left join (select * from aw_group
  where (train_start, skclientkey) not in (select (train_start, skclientkey) from (select {WKEY} from aw_group
    group by {WKEY} having count(*) > 1))) u using ({WKEY})""", WV)
def q_final(t):
    """P11-P16 for every client and window: the modelled pairs' estimates over the all-pair rule."""
    return stand_in(t).final


@register("all_window_final_model", "train_start:l " + FINAL_SPEC)
def q_final_model(t):
    """The same with the fitted Huber models (rows-only check)."""
    return back_test(t).final


@register("all_pairs_windows", "train_start:l " + PAIR4_SPEC + " month:l transactionquantity:d count:l", f"""
select w.train_start, e.hdp_shardid, e.skclientkey, e.medid, e.device_naturalkey, e.month,
       coalesce(e.transactionquantity, 0) as transactionquantity,
       (select count(*) from eligible b where b.hdp_shardid = e.hdp_shardid and b.skclientkey = e.skclientkey
          and b.medid = e.medid and b.device_naturalkey = e.device_naturalkey
          and b.month between e.month - 12 and e.month - 1) as count
from eligible e join aw_windows w on w.skclientkey = e.skclientkey and w.test_month = e.month""", WV)
def q_all_pairs_windows(t):
    """P13 / J14 for every client and window."""
    b = stand_in(t)
    return bk.window_all_pairs(b.eligible, b.windows, P)


@register("two_or_more_windows", "skclientkey:l medid:s device_naturalkey:l month:l windows:s", """
select e.skclientkey, e.medid, e.device_naturalkey, e.month, coalesce(f.windows, '') as windows
from eligible e left join (
  select skclientkey, medid, device_naturalkey, string_agg(train_start, ',' order by train_start) as windows
  from (select train_start, skclientkey, medid, device_naturalkey from aw_rows group by all having count(*) >= 2)
  group by all) f using (skclientkey, medid, device_naturalkey)""", WV)
def q_two_or_more_windows(t):
    """A10 for every window, attached to the panel."""
    b = stand_in(t)
    return bk.window_flags(b.eligible, b.windows, P).withColumn(
        "windows", F.array_join(F.col("two_or_more_windows").cast("array<string>"), ","))

