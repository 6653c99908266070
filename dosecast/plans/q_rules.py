"""Rule, result and report queries.

The O checks run the rules on the fixture's deterministic stand-in score so
SQL can reproduce them exactly; the same functions run on model scores in
the R queries (``result_table``, ``final_estimates``, ``score_histogram``).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from dosecast.operators import report as rp
from dosecast.operators import rules as ru
from dosecast.operators.estimate import BackTest
from dosecast.params import DEFAULT
from dosecast.plans.catalog import register
from dosecast.plans.q_model import FEATS, MV, TEST_SPEC
from dosecast.operators.extract import PAIR

P = DEFAULT
S, E, T = P.train_start, P.train_end, P.test_month
TFOLD = T - (S // 12) * 12 + 1


def _res_sql(src: str, pair_cap: bool) -> str:
    less = "case when floor(y_predict) < 0 then 0.0 else floor(y_predict) end"
    if pair_cap:
        capped = f"case when {less} > c.prediction_cutoff then c.prediction_cutoff else {less} end"
        join = "join cutoff_v c using (skclientkey, medid, device_naturalkey)"
        extra = ", c.max_removal, c.prediction_cutoff"
    else:
        capped = f"case when {less} > 50.0 then 50.0 else {less} end"
        join, extra = "", ""
    return f"""
select *, (modified_y_predict_less_cons - y_df) ** 2 as MSE_Estimator_Model,
       abs(modified_y_predict_less_cons - y_df) as MAE_Estimator_Model,
       case when y_df > 0 then modified_y_predict_less_cons / (y_df + 0.000001) else 0.0 end as Predicted_to_Actual
from (select *, (dashboard_estimate - y_df) ** 2 as MSE_Dashboard, abs(dashboard_estimate - y_df) as MAE_Dashboard
      from (select *, case when dist_eed <= 120 and dist_eed >= 0 then floor(0.45 * inventoryquantity) else 0.0 end
                        as dashboard_estimate,
                   case when dist_eed <= 120 then modified_y_predict else 0.0 end as modified_y_predict_120
            from (select s.* rename (y as y_df){extra},
                         least(case when y_predict < 0 then 0.0 else floor(y_predict) end, inventoryquantity)
                           as modified_y_predict,
                         {capped} as modified_y_predict_less_cons
                  from {src} s {join})))"""


RV = dict(MV)
RV["cutoff_v"] = f"""
select skclientkey, medid, device_naturalkey, max(transactionquantity) as max_removal,
       round_even(max(transactionquantity) * (1 + 0.0), 0) as prediction_cutoff
from monthly_removals where month between {S} and {E} group by skclientkey, medid, device_naturalkey"""
RV["res_pair"] = _res_sql("scored_si", True)
RV["res_fixed"] = _res_sql("scored_si", False)
RV["group_v"] = f"""
select *, (y_df - y_removal_group) ** 2 as MSE_Group_Model, abs(y_df - y_removal_group) as MAE_Group_Model
from (select *, case when Month_w_Removal_count > 5 or Month_w_Removal_count = 1
           or (Month_w_Removal_count = 2 and Frequency_of_Removals < 3.0 and Last_Removal_month >= {TFOLD} - 4)
           or (Month_w_Removal_count = 3 and Frequency_of_Removals < 2.5 and Last_Removal_month >= {TFOLD} - 5)
           or (Month_w_Removal_count = 4 and Frequency_of_Removals < 2.3 and Last_Removal_month >= {TFOLD} - 5)
           or (Month_w_Removal_count = 5 and Frequency_of_Removals < 2.0 and Last_Removal_month >= {TFOLD} - 5)
           then y0 else 0.0 end as y_removal_group
      from (select pf.*, r.max_par_level, r.standardstockwithindispensingdeviceflag, r.usage100, r.inventoryquantity,
                   r.dist_eed, r.y_df, r.y_predict, r.modified_y_predict_less_cons, r.dashboard_estimate,
                   r.MSE_Dashboard, r.MSE_Estimator_Model, r.MAE_Estimator_Model, r.MAE_Dashboard,
                   case when pf.Month_w_Removal_count between 2 and 5 and (r.dist_eed > 90 or r.dist_eed < 0)
                        then 0.0 else r.modified_y_predict_less_cons end as y0
            from profile_v pf join res_pair r using (skclientkey, medid, device_naturalkey)))"""
RV["allp_v"] = f"""
select e.* replace (coalesce(e.transactionquantity, 0) as transactionquantity), coalesce(c.count, 0) as count
from eligible e left join (select hdp_shardid, skclientkey, medid, device_naturalkey, count(*) as count
  from eligible where month between {S} and {E} group by all) c
  using (hdp_shardid, skclientkey, medid, device_naturalkey)
where e.month = {T}"""
RV["one_zero_v"] = """
select *, (y_df - y_removal_group) ** 2 as MSE_Dashboard, abs(y_df - y_removal_group) as MAE_Dashboard,
       (y_df - y_removal_group) ** 2 as MSE_Group_Model, abs(y_df - y_removal_group) as MAE_Group_Model
from (select * replace (cast(1 as bigint) as Month_w_Removal_count, cat as dist_eed_120),
             case when cat = 1 then floor(0.45 * inventoryquantity) else 0.0 end as y_removal_group,
             transactionquantity as y_df
      from (select *, cast(1 as bigint) as Month_w_Removal_count,
                   case when dist_eed > 120 then 0 when dist_eed < 0 then 2 else 1 end as cat from allp_v))"""

RES_SPEC = TEST_SPEC.replace(" y:d", " y_df:d") + " " + " ".join(f"{f}_norm:d" for f in FEATS) + """
y_predict:d modified_y_predict:d modified_y_predict_less_cons:d dashboard_estimate:d modified_y_predict_120:d
MSE_Dashboard:d MAE_Dashboard:d MSE_Estimator_Model:d MAE_Estimator_Model:d Predicted_to_Actual:d"""


def si(t):
    return BackTest(t, P, predictions="stand_in")


@register("modified_predictions", RES_SPEC, "select * from res_fixed", RV)
def q_modified(t):
    """P6 + P7 + P8 with the fixed cap of 50 (on the stand-in score)."""
    return si(t).result(pair_cap=False)


@register("clipped_predictions", RES_SPEC + " max_removal:d prediction_cutoff:d", "select * from res_pair", RV)
def q_clipped(t):
    """The pair cut-off joined on and applied (margin 0)."""
    return si(t).result(pair_cap=True)


@register("dashboard_estimate", "skclientkey:l medid:s device_naturalkey:l dist_eed:d inventoryquantity:d "
          "dashboard_estimate:d modified_y_predict_120:d MSE_Dashboard:d MAE_Dashboard:d", "select * from res_pair", RV)
def q_dashboard(t):
    """P7."""
    return si(t).result(pair_cap=True)


@register("row_errors", "skclientkey:l medid:s device_naturalkey:l y_df:d modified_y_predict_less_cons:d "
          "MSE_Estimator_Model:d MAE_Estimator_Model:d Predicted_to_Actual:d", "select * from res_pair", RV)
def q_row_errors(t):
    """P8 (+ X18 guarded ratio)."""
    return si(t).result(pair_cap=True)


ERR_SPEC = """skclientkey:l test_month:l is_pair_prediction_cutoff:b margin_percent:d RMSE_Dashboard:d
RMSE_Estimator:d MAE_Estimator:d Max_Error_Percentage:d"""
ERR_SQL = f"""
select skclientkey, {T} as test_month, true as is_pair_prediction_cutoff, 0.0 as margin_percent,
       sqrt(avg(MSE_Dashboard)) as RMSE_Dashboard, sqrt(avg(MSE_Estimator_Model)) as RMSE_Estimator,
       avg(MAE_Estimator_Model) as MAE_Estimator, max(Predicted_to_Actual) as Max_Error_Percentage
from res_pair group by skclientkey
union all
select skclientkey, {T}, false, 0.0, sqrt(avg(MSE_Dashboard)), sqrt(avg(MSE_Estimator_Model)),
       avg(MAE_Estimator_Model), max(Predicted_to_Actual)
from res_fixed group by skclientkey"""


def _errors(b):
    a = b.result(True).withColumn("is_pair_prediction_cutoff", F.lit(True))
    c = b.result(False).withColumn("is_pair_prediction_cutoff", F.lit(False))
    keys = ["skclientkey", "is_pair_prediction_cutoff"]
    out = ru.error_summary(a, keys).unionByName(ru.error_summary(c, keys))
    return out.withColumn("test_month", F.lit(T)).withColumn("margin_percent", F.lit(P.margin_percent))


@register("error_summary", ERR_SPEC, ERR_SQL, RV)
def q_error_summary(t):
    """A12 for both settings (pair cap, fixed cap)."""
    return _errors(si(t))


@register("error_report", ERR_SPEC, ERR_SQL, RV)
def q_error_report(t):
    """The error report, sorted at output."""
    return _errors(si(t)).orderBy("skclientkey", "is_pair_prediction_cutoff")


GROUP_SPEC = """skclientkey:l medid:s device_naturalkey:l Last_Removal_month:l First_Removal_month:l
Month_w_Removal_count:l Frequency_of_Removals:d dist_eed:d inventoryquantity:d y_df:d
modified_y_predict_less_cons:d y_removal_group:d MSE_Group_Model:d MAE_Group_Model:d"""


@register("group_rule", GROUP_SPEC, "select * from group_v", RV)
def q_group_rule(t):
    """P11 + P12 + J13."""
    return si(t).group_result


ALLP_SPEC = """hdp_shardid:l skclientkey:l medid:s device_naturalkey:l month:l inventoryquantity:d dist_eed:l
transactionquantity:d count:l"""


@register("all_pairs_test", ALLP_SPEC, "select * from allp_v", RV)
def q_all_pairs(t):
    """All eligible rows of the test month with training counts (0 filled)."""
    return si(t).all_pairs


OZ_SPEC = """skclientkey:l medid:s device_naturalkey:l Month_w_Removal_count:l dist_eed:l dist_eed_120:l
inventoryquantity:d y_df:d y_removal_group:d MSE_Dashboard:d MAE_Dashboard:d MSE_Group_Model:d MAE_Group_Model:d"""


@register("one_zero_rule", OZ_SPEC, "select * from one_zero_v", RV)
def q_one_zero(t):
    """P14."""
    return si(t).one_zero


@register("one_zero_rule_nb", "skclientkey:l medid:s device_naturalkey:l Month_w_Removal_count:l dist_eed_120:l "
          "y_removal_group:d", """
select skclientkey, medid, device_naturalkey, Month_w_Removal_count, cat as dist_eed_120,
       case when Month_w_Removal_count = 1 and cat = 1 then floor(0.45 * y_removal_group)
            when Month_w_Removal_count = 1 then 0.0 else y_removal_group end as y_removal_group
from (select *, case when dist_eed > 120 then 0 when dist_eed < 0 then 2 else 1 end as cat from group_v)""", RV)
def q_one_zero_nb(t):
    """Notebook form on the group result (45 % of the estimate)."""
    return ru.one_month_rule_nb(si(t).group_result, P)


FINAL_SPEC = """skclientkey:l medid:s device_naturalkey:l Month_w_Removal_count:d dist_eed:d inventoryquantity:d
y_df:d y_removal_group:d MAE_Dashboard:d MAE_Group_Model:d"""
OV_COLS = ["Month_w_Removal_count", "dist_eed", "inventoryquantity", "y_df", "y_removal_group", "MAE_Dashboard",
           "MAE_Group_Model"]


@register("overlay_update", FINAL_SPEC, f"""
select b.skclientkey, b.medid, b.device_naturalkey,
       {', '.join(f'case when d.skclientkey is not null then b.{c} else coalesce(u.{c}, b.{c}) end as {c}' for c in OV_COLS)}
from one_zero_v b
left join group_v u using (skclientkey, medid, device_naturalkey)
left join (select distinct skclientkey from (select skclientkey, count(*) as n from group_v
                                             group by skclientkey, medid, device_naturalkey) where n > 1) d
  on d.skclientkey = b.skclientkey""", RV)
def q_overlay(t):
    """J15 / P16 on the stand-in score: the group result overlays the all-pair result."""
    return si(t).final


@register("final_estimates", FINAL_SPEC)
def q_final(t):
    """P16 with the fitted Huber models (rows-only check)."""
    return BackTest(t, P).final


@register("result_table", RES_SPEC + " max_removal:d prediction_cutoff:d")
def q_result_table(t):
    """P10 with the fitted Huber models (rows-only check)."""
    return BackTest(t, P).result(pair_cap=True)


@register("dollar_values", "skclientkey:l medid:s device_naturalkey:l unitcost:d estimate_value:d baseline_value:d "
          "actual_value:d", """
select r.skclientkey, r.medid, r.device_naturalkey, c.unitcost,
       coalesce(c.unitcost, 0.0) * r.modified_y_predict_less_cons as estimate_value,
       coalesce(c.unitcost, 0.0) * r.dashboard_estimate as baseline_value,
       coalesce(c.unitcost, 0.0) * r.y_df as actual_value
from res_pair r left join latest_cost c on c.skclientkey = r.skclientkey and c.medid = r.medid
  and c.hdp_shardid = r.hdp_shardid""", RV)
def q_dollars(t):
    """P17."""
    b = si(t)
    return ru.dollar_values(b.result(True), b.inputs.cost)


DESC_SPEC = "months_w_removals:l metric:s count:l mean:d std:d min:d q25:d q50:d q75:d max:d"


def _desc_sql(where: str, by: str) -> str:
    return f"""
select {by}, metric, count(value) as count, avg(value) as mean, stddev_samp(value) as std, min(value) as min,
       quantile_cont(value, 0.25) as q25, quantile_cont(value, 0.5) as q50, quantile_cont(value, 0.75) as q75,
       max(value) as max
from (select months_w_removals, 'MAE_Dashboard' as metric, MAE_Dashboard as value from res_pair where {where}
      union all
      select months_w_removals, 'MAE_Estimator_Model', MAE_Estimator_Model from res_pair where {where})
group by {by}, metric"""


@register("error_describe", DESC_SPEC, _desc_sql("months_w_removals <= 5", "months_w_removals"), RV)
def q_describe(t):
    """A11 per pooled tier k = 2..5."""
    r = si(t).result(True).where(F.col("months_w_removals") <= P.own_model_min)
    lng = rp.long_metrics(r, ["months_w_removals"], ["MAE_Dashboard", "MAE_Estimator_Model"])
    return rp.describe(lng, ["months_w_removals", "metric"])


@register("error_describe_individuals", DESC_SPEC.replace("months_w_removals:l ", ""),
          _desc_sql("months_w_removals > 5", "'all'").replace("select 'all', metric", "select metric")
          .replace("group by 'all', metric", "group by metric"), RV)
def q_describe_ind(t):
    """A11 over the own-model pairs."""
    r = si(t).result(True).where(F.col("months_w_removals") > P.own_model_min)
    lng = rp.long_metrics(r, ["months_w_removals"], ["MAE_Dashboard", "MAE_Estimator_Model"])
    return rp.describe(lng, ["metric"])


@register("box_stats", "months_w_removals:l metric:s q1:d median:d q3:d mean:d whisker_lo:d whisker_hi:d "
          "n_outliers:l", """
select q.months_w_removals, q.metric, q1, median, q3, mean,
       min(case when value between lo and hi then value end) as whisker_lo,
       max(case when value between lo and hi then value end) as whisker_hi,
       count(case when not (value between lo and hi) then 1 end) as n_outliers
from (select months_w_removals, metric, quantile_cont(value, 0.25) as q1, quantile_cont(value, 0.5) as median,
             quantile_cont(value, 0.75) as q3, avg(value) as mean,
             quantile_cont(value, 0.25) - 1.5 * (quantile_cont(value, 0.75) - quantile_cont(value, 0.25)) as lo,
             quantile_cont(value, 0.75) + 1.5 * (quantile_cont(value, 0.75) - quantile_cont(value, 0.25)) as hi
      from lng group by all) q
join lng using (months_w_removals, metric)
group by q.months_w_removals, q.metric, q1, median, q3, mean""", {**RV, "lng": """
select months_w_removals, 'MAE_Estimator_Model' as metric, MAE_Estimator_Model as value from res_pair
union all select months_w_removals, 'MAE_Dashboard', MAE_Dashboard from res_pair"""})
def q_box(t):
    """A15."""
    r = si(t).result(True)
    lng = rp.long_metrics(r, ["months_w_removals"], ["MAE_Dashboard", "MAE_Estimator_Model"])
    return rp.box_stats(lng, ["months_w_removals", "metric"])


@register("ratio_outliers", "skclientkey:l medid:s device_naturalkey:l month:l y_df:d "
          "modified_y_predict_less_cons:d Predicted_to_Actual:d", """
select * from res_pair where (Predicted_to_Actual > 2 and Predicted_to_Actual < 10) or Predicted_to_Actual < 0.5""",
          RV)
def q_ratio_outliers(t):
    """outlier rows (sorted descending at output)."""
    return rp.ratio_outliers(si(t).result(True)).orderBy(F.col("Predicted_to_Actual").desc())


@register("ratio_outlier_counts", "model_key:s n:l", """
select model_key, count(*) as n from res_pair
where (Predicted_to_Actual > 2 and Predicted_to_Actual < 10) or Predicted_to_Actual < 0.5 group by model_key""", RV)
def q_ratio_outlier_counts(t):
    """outlier rows per model."""
    return rp.ratio_outliers(si(t).result(True)).groupBy("model_key").agg(F.count(F.lit(1)).alias("n"))


@register("score_histogram", "bin:l count:l bin_min:d bin_max:d")
def q_score_hist(t):
    """A14 on the fitted models' scores (rows-only check)."""
    return rp.score_histogram(BackTest(t, P).scored)


COV_SPEC = """skclientkey:l month:l total_pairs:l non_drug_items:l insulins:l anesthesia_stations:l outofrange_inv:l
total_pairs_removed:l pairs_remaining:l pairs_eed_between_0_and_120:l"""
KEEP_SQL = {
    "non_drug_items": "coalesce(meditemflag = 1, false)",
    "insulins": "coalesce(medfullname is not null and not (lower(medfullname) like '%insuli%' "
                "or lower(medfullname) like '%patient%'), false)",
    "anesthesia_stations": "coalesce(devicetypekey in (1, 2), false)",
    "outofrange_inv": "coalesce(inventoryquantity <= 1000, false)",
}
ALL_KEEP = " and ".join(f"({v})" for v in KEEP_SQL.values())


@register("coverage", COV_SPEC, f"""
select skclientkey, month, count(*) as total_pairs,
       {', '.join(f'count_if(not ({v})) as {k}' for k, v in KEEP_SQL.items())},
       count_if(not ({ALL_KEEP})) as total_pairs_removed, count_if({ALL_KEEP}) as pairs_remaining,
       count_if(dist_eed_120 = 1) as pairs_eed_between_0_and_120
from panel group by skclientkey, month""")
def q_coverage(t):
    """A16."""
    return rp.coverage(si(t).panel, P)


@register("filter_share", "skclientkey:l filter:s removed:l proportion:d", f"""
select skclientkey, filter, removed, removed / n as proportion from (
  select skclientkey, count(*) as n,
         {', '.join(f'count_if(not ({v})) as {k}' for k, v in KEEP_SQL.items())},
         {' + '.join(f'count_if(not ({v}))' for v in KEEP_SQL.values())} as all_filters
  from panel group by skclientkey)
unpivot (removed for filter in ({', '.join(list(KEEP_SQL) + ['all_filters'])}))""")
def q_filter_share(t):
    """A17 (U7 unpivot)."""
    return rp.filter_share(si(t).panel, P)


@register("nameless_meds", "skclientkey:l medid:s",
          "select distinct skclientkey, medid from panel where medfullname is null")
def q_nameless(t):
    """A19."""
    return rp.nameless(si(t).panel)


@register("flag_drift", "skclientkey:l pairs:l drifting_pairs:l", """
select skclientkey, count(*) as pairs, count_if(m > 0 and m < 1) as drifting_pairs
from (select skclientkey, medid, device_naturalkey, avg(standardstockwithindispensingdeviceflag) as m
      from removal_panel group by all) group by skclientkey""")
def q_flag_drift(t):
    """A20."""
    return rp.flag_drift(si(t).removal_rows)
