"""Window, pair, tier and model queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from dosecast.operators import extract as ex
from dosecast.operators import models as md
from dosecast.operators import panel as pn
from dosecast.operators import windows as wn
from dosecast.operators.estimate import BackTest
from dosecast.operators.features import BY_CATEGORY
from dosecast.params import DEFAULT
from dosecast.plans.catalog import register
from dosecast.session import large

P = DEFAULT
S, E, T = P.train_start, P.train_end, P.test_month
FEATS = list(P.features)
PAIR4_SPEC = "hdp_shardid:l skclientkey:l medid:s device_naturalkey:l"

def feature_views(feats: list[str], of=None, carry: str = "", suffix: str = "") -> dict[str, str]:
    """Training rows, scaler and test rows of a feature list; ``of(feature, r)`` is a feature on the row named r."""
    of = of or (lambda f, r: "u.usage100" if (f, r) == ("usage100", "s") else f"{r}.{f}")
    row = lambda r: ", ".join(f"cast(coalesce({of(f, r)}, 0) as double) as {f}" if (f, r) == ("usage100", "s")
                              else f"cast({of(f, r)} as double) as {f}" for f in feats)
    same = lambda r: " and ".join(f"a.{k} = {r}.{k}" for k in ("hdp_shardid", "skclientkey", "medid", "device_naturalkey"))
    scaled = lambda t: "select x.*, " + ", ".join(
        f"(x.{f} - s.{f}_min) / case when s.{f}_max - s.{f}_min = 0 then 1.0 else s.{f}_max - s.{f}_min end"
        f" as {f}_norm" for f in feats) + f" from {t}{suffix} x join scaler_v{suffix} s using (model_key)"
    keys = lambda r: f"a.model_key, {r}.hdp_shardid, {r}.skclientkey, {r}.medid, {r}.device_naturalkey, {r}.month, a.months_w_removals"
    more = lambda r: "".join(f", {r}.{c}" for c in carry.split())
    return {
        f"train_rows{suffix}": f"""
select {keys('r')}, {row('r')}, r.transactionquantity as y
from removal_panel r join assign a on {same('r')} where r.month between {S} and {E}""",
        f"scaler_v{suffix}": "select model_key, " + ", ".join(f"min({f}) as {f}_min, max({f}) as {f}_max" for f in feats)
                             + f" from train_rows{suffix} group by model_key",
        f"train_scaled{suffix}": scaled("train_rows"),
        f"test_feat{suffix}": f"""
select {keys('r')}{more('r')}, {row('r')}, r.transactionquantity as y, 'removal' as source
from removal_panel r join assign a on {same('r')} where r.month = {T}
union all
select {keys('s')}{more('s')}, {row('s')}, 0.0, 'snapshot'
from snap_feat s join assign a on {same('s')}
left join usage_feat u on u.hdp_shardid = s.hdp_shardid and u.skclientkey = s.skclientkey and u.medid = s.medid
 and u.device_naturalkey = s.device_naturalkey and u.month = s.month
where s.month = {T} and not exists (select 1 from removal_panel r where r.month = {T}
 and r.hdp_shardid = s.hdp_shardid and r.skclientkey = s.skclientkey and r.medid = s.medid
 and r.device_naturalkey = s.device_naturalkey)""",
        f"test_scaled{suffix}": scaled("test_feat"),
    }


# Oracle views of the model stage (window 1996-03 .. 1997-02, test 1997-03).
MV = {
    "pairs_w": f"""
select hdp_shardid, skclientkey, medid, device_naturalkey, count(*) as count from removal_panel
where month between {S} and {E} group by all having count(*) > 1""",
    "assign": f"""
select *, concat_ws('|', {S}, case when count > 5 then concat_ws('|', 'pair', skclientkey, medid, device_naturalkey)
                                   else concat_ws('|', 'pool', skclientkey, count) end) as model_key,
       case when count > 5 then 'own' else 'pool' end as tier, count as months_w_removals
from pairs_w where count >= 2""",
    **feature_views(FEATS),
    "scored_si": """
select *, cast((device_naturalkey * 3 + cast(substr(medid, 7) as integer) * 7 + month) % 40 - 5 as double)
          as y_predict from test_scaled""",
    "profile_v": f"""
select skclientkey, medid, device_naturalkey, lst - {S // 12 * 12} + 1 as Last_Removal_month,
       fst - {S // 12 * 12} + 1 as First_Removal_month, n as Month_w_Removal_count,
       cast(trunc(avg_inv) as bigint) as Avg_Inventory_Qty_training_peroid, mn as Min_Removal_Qty,
       mx as Max_Removal_Qty, cast(trunc(avg_y) as bigint) as Avg_Removal_Qty,
       case when n = 1 then 1.0 else (lst - fst) / (n - 1) end as Frequency_of_Removals
from (select skclientkey, medid, device_naturalkey, max(month) as lst, min(month) as fst, count(y) as n,
             avg(inventoryquantity) as avg_inv, min(y) as mn, max(y) as mx, avg(y) as avg_y
      from train_rows group by skclientkey, medid, device_naturalkey)""",
}

TRAIN_SPEC = "model_key:s " + PAIR4_SPEC + " month:l months_w_removals:l " + \
    " ".join(f"{f}:d" for f in FEATS) + " y:d"
SCALED_SPEC = TRAIN_SPEC + " " + " ".join(f"{f}_norm:d" for f in FEATS)
TEST_SPEC = TRAIN_SPEC + " source:s"


def bt(t, **kw):
    return BackTest(t, P, **kw)


@register("training_months", "skclientkey:l test_month:l train_start:l test_yyyymm:l train_start_yyyymm:l", """
select clientkey as skclientkey, mi as test_month, mi - 12 as train_start,
       cast(floor(mi / 12) * 100 + mi % 12 + 1 as bigint) as test_yyyymm,
       cast(floor((mi - 12) / 12) * 100 + (mi - 12) % 12 + 1 as bigint) as train_start_yyyymm
from (select clientkey, mi, count(*) over (partition by clientkey) - 13 as n,
             row_number() over (partition by clientkey order by mi desc) as rk
      from (select distinct clientkey, cast(floor(year_month / 100) * 12 + year_month % 100 - 1 as integer) as mi
            from monthly_usage))
where rk <= n""")
def q_training_months(t):
    """T3 per client."""
    return wn.training_months(ex.monthly_usage(t), P.window_months)


@register("month_except", "skclientkey:l mi:l", """
select distinct clientkey as skclientkey, cast(floor(year_month / 100) * 12 + year_month % 100 - 1 as bigint) as mi
from monthly_usage
except
select clientkey, mi from (select clientkey, mi, count(*) over (partition by clientkey) - 13 as n,
       row_number() over (partition by clientkey order by mi desc) as rk
  from (select distinct clientkey, cast(floor(year_month / 100) * 12 + year_month % 100 - 1 as integer) as mi
        from monthly_usage)) where rk <= n""")
def q_month_except(t):
    """Set difference of month lists (non-test months)."""
    u = ex.monthly_usage(t)
    return wn.month_except(u, wn.training_months(u, P.window_months))


@register("training_window", "hdp_shardid:l skclientkey:l medid:s device_naturalkey:l month:l transactionquantity:d "
          "inventoryquantity:d", f"""
select hdp_shardid, skclientkey, medid, device_naturalkey, month, transactionquantity, inventoryquantity
from removal_panel where month between {S} and {E}""")
def q_training_window(t):
    """the 12-month window crossing a year end."""
    return pn.in_window(bt(t).removal_rows, S, P.window_months)


@register("training_pairs", PAIR4_SPEC + " count:l", "select * from pairs_w", MV)
def q_training_pairs(t):
    """A5 (count > 1)."""
    return bt(t).pairs


@register("pair_counts", PAIR4_SPEC + " count:l", f"""
select hdp_shardid, skclientkey, medid, device_naturalkey, count(*) as count from removal_panel
where month = {T} group by all having count(*) > 0""")
def q_pair_counts(t):
    """A5, pair-count form with one month: the month a year on, count > 0."""
    return wn.pair_counts(bt(t).removal_rows, S, 1)


@register("pair_count_by_client", "skclientkey:l pairs:l",
          "select skclientkey, count(*) as pairs from pairs_w group by skclientkey", MV)
def q_pair_count_by_client(t):
    """A6."""
    return wn.pair_count_by_client(bt(t).pairs)


@register("prediction_cutoff", "skclientkey:l medid:s device_naturalkey:l max_removal:d prediction_cutoff:d", f"""
select skclientkey, medid, device_naturalkey, max(transactionquantity) as max_removal,
       round_even(max(transactionquantity) * (1 + 0.0), 0) as prediction_cutoff
from monthly_removals where month between {S} and {E} group by skclientkey, medid, device_naturalkey""")
def q_prediction_cutoff(t):
    """A7."""
    return bt(t).cutoff


PROFILE_SPEC = """skclientkey:l medid:s device_naturalkey:l Last_Removal_month:l First_Removal_month:l
Month_w_Removal_count:l Avg_Inventory_Qty_training_peroid:l Min_Removal_Qty:d Max_Removal_Qty:d Avg_Removal_Qty:l
Frequency_of_Removals:d"""


@register("training_profile", PROFILE_SPEC, "select * from profile_v", MV)
def q_training_profile(t):
    """A9 (script form: a single removal month has frequency 1)."""
    return bt(t).profile


@register("two_or_more_flag", "skclientkey:l medid:s device_naturalkey:l month:l two_or_more:b", f"""
select e.skclientkey, e.medid, e.device_naturalkey, e.month, coalesce(c.n >= 2, false) as two_or_more
from eligible e left join (select skclientkey, medid, device_naturalkey, count(*) as n from eligible
  where any_expiry_removal and month between {S} and {E} group by all) c
 on c.skclientkey = e.skclientkey and c.medid = e.medid and c.device_naturalkey = e.device_naturalkey""")
def q_two_or_more(t):
    """A10 (intended meaning: flag per pair and window)."""
    return wn.two_or_more_flag(bt(t).eligible, S, P.window_months)


@register("removal_histogram", "skclientkey:l bin:l pairs:l", f"""
select skclientkey, cast(ceil(count) as bigint) as bin, count(*) as pairs
from (select skclientkey, medid, device_naturalkey, hdp_shardid, count(*) as count from removal_panel
      where month between {S} and {E} group by all)
where count > 0 and count <= 12 group by all""")
def q_removal_histogram(t):
    """Right-closed bins (k-1, k], k = 1..12."""
    return wn.removal_histogram(wn.training_pairs(bt(t).removal_rows, S, P.window_months, 0))


@register("model_assignment", PAIR4_SPEC + " months_w_removals:l model_key:s tier:s",
          "select * exclude (count) from assign", MV)
def q_model_assignment(t):
    """M1: own model (> 5 removal months) or pool per client and k (2..5)."""
    return bt(t).assignment


@register("training_rows", TRAIN_SPEC, "select * from train_rows", MV)
def q_training_rows(t):
    """M2 + J9."""
    return bt(t).train


@register("scaled_features", SCALED_SPEC, "select * from train_scaled", MV)
def q_scaled(t):
    """M3 fit + apply on the training rows."""
    return bt(t).train_scaled


@register("test_features", TEST_SPEC, "select * from test_feat", MV)
def q_test_features(t):
    """P9."""
    return bt(t).test


@register("unscored_pairs", PAIR4_SPEC + " months_w_removals:l model_key:s", """
select hdp_shardid, skclientkey, medid, device_naturalkey, months_w_removals, model_key from assign a
where not exists (select 1 from test_feat f where f.hdp_shardid = a.hdp_shardid and f.skclientkey = a.skclientkey
  and f.medid = a.medid and f.device_naturalkey = a.device_naturalkey)""", MV)
def q_unscored(t):
    """Trained pairs that get no estimate, as a real output table."""
    b = bt(t)
    return wn_unscored(b)


def wn_unscored(b):
    from dosecast.operators.rules import unscored_pairs
    return unscored_pairs(b.assignment, b.test)


@register("modeled_pair_count", "skclientkey:l train_start:l modeled_pairs:l",
          f"select skclientkey, {S} as train_start, count(*) as modeled_pairs from assign group by skclientkey", MV)
def q_modeled_pair_count(t):
    """A21 (the true count; the reference logs one fewer)."""
    return (bt(t).assignment.groupBy("skclientkey")
            .agg(F.lit(S).alias("train_start"), F.count(F.lit(1)).alias("modeled_pairs")))


@register("all_windows", "train_start:l " + PAIR4_SPEC + " count:l", """
select w.train_start, r.hdp_shardid, r.skclientkey, r.medid, r.device_naturalkey, count(*) as count
from removal_panel r join (
  select clientkey as skclientkey, mi - 12 as train_start
  from (select clientkey, mi, count(*) over (partition by clientkey) - 13 as n,
               row_number() over (partition by clientkey order by mi desc) as rk
        from (select distinct clientkey, cast(floor(year_month / 100) * 12 + year_month % 100 - 1 as integer) as mi
              from monthly_usage)) where rk <= n) w
  on w.skclientkey = r.skclientkey and r.month between w.train_start and w.train_start + 11
group by all having count(*) > 1""")
def q_all_windows(t):
    """Training pairs of every client and window in one job."""
    b = bt(t)
    return wn.all_window_pairs(b.removal_rows, b.inputs.windows, P.window_months, P.min_pair_count)


@register("model_r2", "model_key:s n:l r2:d", f"""
select model_key, count(*) as n,
       case when abs(sum(y * y) - sum(y) * sum(y) / count(*)) <= 1e-9
            then case when sum((y - p) * (y - p)) <= 1e-9 then 1.0 else 0.0 end
            else 1 - sum((y - p) * (y - p)) / (sum(y * y) - sum(y) * sum(y) / count(*)) end as r2
from (select *, cast((device_naturalkey * 3 + cast(substr(medid, 7) as integer) * 7 + month) % 40 - 5 as double) as p
      from train_rows) group by model_key""", MV)
def q_model_r2(t):
    """M7 given (stand-in) predictions."""
    from dosecast.functions.months import brand_no
    from dosecast.sources import fixtures as fx
    tr = bt(t).train.withColumn("y_predict", fx.stand_in_prediction(F.col("device_naturalkey"), brand_no("medid"),
                                                                    F.col("month")))
    return md.model_r2(tr)


MODEL_SPEC = "model_key:s intercept:d scale:d n_rows:l r2:d n_iter:l objective:d n_coef:l"
K = len(FEATS)


def ridge_views(train: str, feats: list[str] = FEATS) -> dict[str, str]:
    """Ridge models of the table ``train`` (scaled rows): the LDL^T steps of the library, one view for each step."""
    x, K = [f"{f}_norm" for f in feats], len(feats)
    sums = ", ".join([f"sum({x[i]}) as sx{i}, sum({x[i]} * y) as sxy{i}" for i in range(K)]
                     + [f"sum({x[j]} * {x[i]}) as sxx{j}_{i}" for i in range(K) for j in range(i + 1)])
    centred = ", ".join([f"sxx{j}_{i} - sx{i} * sx{j} / n{f' + {P.ridge_alpha}' if i == j else ''} as m{i}_{j}"
                         for i in range(K) for j in range(i + 1)] + [f"sxy{i} - sx{i} * sy / n as c{i}" for i in range(K)])
    views = {"ridge_sums": f"select model_key, count(*) as n, sum(y) as sy, sum(y * y) as syy, {sums} from {train} group by model_key",
             "ridge_0": f"select *, {centred} from ridge_sums"}
    for n, step in enumerate(md.ldl_steps(K, lambda i, j: f"m{i}_{j}", lambda i: f"c{i}")):
        views[f"ridge_{n + 1}"] = f"select *, {', '.join(f'{e} as {name}' for name, e in step.items())} from ridge_{n}"
    dot = lambda a, b: " + ".join(f"{a}{i} * {b}{i}" for i in range(K))
    views["ridge_parts"] = f"""
select *, (sy - ({dot('w', 'sx')})) / n as intercept, syy - sy * sy / n as total,
       syy - sy * sy / n - ({dot('w', 'c')}) - {P.ridge_alpha} * ({dot('w', 'w')}) as residual from ridge_{len(views) - 2}"""
    views["ridge_m"] = f"""
select model_key, intercept, {', '.join(f'w{i}' for i in range(K))}, n as n_rows,
       case when abs(total) < 1e-9 then case when abs(residual) < 1e-9 then 1.0 else 0.0 end else 1 - residual / total end as r2
from ridge_parts"""
    return views


RV = MV | ridge_views("train_scaled") | {
    "ridge_scored": f"""
select x.*, m.intercept + {' + '.join(f'm.w{i} * x.{f}_norm' for i, f in enumerate(FEATS))} as y_predict
from test_scaled x join ridge_m m using (model_key)"""}

# Training rows of every window.
AV = {
    "every_window": """
select clientkey as skclientkey, mi - 12 as train_start
from (select clientkey, mi, count(*) over (partition by clientkey) - 13 as n,
             row_number() over (partition by clientkey order by mi desc) as rk
      from (select distinct clientkey, cast(floor(year_month / 100) * 12 + year_month % 100 - 1 as integer) as mi
            from monthly_usage)) where rk <= n""",
    "every_row": """
select w.train_start, r.* from removal_panel r join every_window w
  on w.skclientkey = r.skclientkey and r.month between w.train_start and w.train_start + 11""",
    "every_train": """
select concat_ws('|', train_start, case when c.count > 5 then concat_ws('|', 'pair', skclientkey, medid, device_naturalkey)
                                        else concat_ws('|', 'pool', skclientkey, c.count) end) as model_key, e.*
from every_row e join (
  select train_start, hdp_shardid, skclientkey, medid, device_naturalkey, count(*) as count from every_row
  group by all having count(*) > 1) c using (train_start, hdp_shardid, skclientkey, medid, device_naturalkey)""",
}
# The gap that a model may have to the bound on its objective, relative to 1 plus the objective.
CERTIFIED = 1e-4


@register("huber_models", MODEL_SPEC)
def q_huber(t):
    """M4: Huber models (the coefficients are checked by ``huber_certificate``)."""
    return bt(t).models.withColumn("n_coef", F.size("coef"))


def certified(train, models, p=P):
    c = md.certificate(train, models, p)
    return c.withColumn("certified", (F.col("gap") <= CERTIFIED * (1 + F.col("objective"))) & (F.col("gap") >= -1e-8 * (1 + F.col("objective"))))


@register("huber_certificate", "model_key:s n_rows:l certified:b converged:b", """
select model_key, count(*) as n_rows, true as certified, true as converged from train_rows group by model_key""", MV)
def q_huber_certificate(t):
    """M4: every model's objective is within the certified gap of the optimum."""
    b = bt(t)
    return certified(b.train_scaled, b.models).join(b.models.select("model_key", "converged"), "model_key")


@register("huber_objectives", "model_key:s n_rows:l objective:d gap:d grad_coef:d grad_intercept:d grad_scale:d")
def q_huber_objectives(t):
    """M4: objective, duality gap and what the optimality conditions leave, for each model (rows-only check)."""
    b = bt(t)
    return md.certificate(b.train_scaled, b.models, P)


@register("ridge_models", "model_key:s intercept:d " + " ".join(f"w{i}:d" for i in range(K)) + " n_rows:l r2:d", "select * from ridge_m", RV)
def q_ridge(t):
    """M5: ridge from sums of products, LDL^T in column expressions; M8's other choice."""
    m = bt(t, model="Ridge").models
    return m.select("model_key", "intercept", *[F.col("coef")[i].alias(f"w{i}") for i in range(K)], "n_rows", "r2")


@register("ridge_scored_rows", TEST_SPEC + " y_predict:d", "select * from ridge_scored", RV)
def q_ridge_scored(t):
    """M6 + J11: test rows scored by a fitted model."""
    return bt(t, model="Ridge").scored


@register("ridge_training_r2", "model_key:s n:l r2:d", "select model_key, n_rows as n, r2 from ridge_m", RV)
def q_ridge_r2(t):
    """M7 from a fitted model's predictions of its training rows; equals the models' own."""
    b = bt(t, model="Ridge")
    return md.model_r2(md.score(b.train_scaled, b.models, P))


@register("scored_rows", TEST_SPEC + " y_predict:d")
def q_scored(t):
    """M6: test rows scored by their model."""
    return bt(t).scored


@register("grouped_rows", "skclientkey:l medid:s device_naturalkey:l month:l transactionquantity:d count:l", f"""
select r.skclientkey, r.medid, r.device_naturalkey, r.month, r.transactionquantity, p.count
from removal_panel r join pairs_w p using (skclientkey, medid, device_naturalkey)
where r.month between {S} and {E}""", MV)
def q_grouped_rows(t):
    """J9."""
    b = bt(t)
    return wn.grouped_rows(b.removal_rows, b.pairs, S, P.window_months)


def by_category(f: str, r: str) -> str:
    """A feature of ``BY_CATEGORY`` in SQL, on the row named r."""
    if f in BY_CATEGORY.numeric:
        return "u.usage100" if (f, r) == ("usage100", "s") else f"{r}.{f}"
    name, level = f.rsplit("_", 1)
    return f"coalesce({r}.{name} = {level}, false)"


CATS = list(BY_CATEGORY.columns)
CV = MV | feature_views(CATS, by_category, " ".join(BY_CATEGORY.names), "_cat") | ridge_views("train_scaled_cat", CATS)
CAT_SPEC = "model_key:s " + PAIR4_SPEC + " month:l months_w_removals:l " + " ".join(f"{f}:d" for f in CATS) + " y:d"


def bt_cat(t, **kw):
    return bt(t, features=BY_CATEGORY, **kw)


@register("training_rows_onehot", CAT_SPEC, "select * from train_rows_cat", CV)
def q_training_onehot(t):
    """M2 + X17: training rows with the EED category and the stock flag as 0/1 columns."""
    return bt_cat(t).train


@register("test_features_onehot", CAT_SPEC + " dist_eed_120:l standardstockwithindispensingdeviceflag:l source:s",
          "select * from test_feat_cat", CV)
def q_test_onehot(t):
    """P9 + X17."""
    return bt_cat(t).test


@register("ridge_models_onehot", "model_key:s intercept:d " + " ".join(f"w{i}:d" for i in range(len(CATS))) + " n_rows:l r2:d",
          "select * from ridge_m", CV)
def q_ridge_onehot(t):
    """M3 + M5 + X17: models on categorical features."""
    m = bt_cat(t, model="Ridge").models
    return m.select("model_key", "intercept", *[F.col("coef")[i].alias(f"w{i}") for i in range(len(CATS))], "n_rows", "r2")


@register("huber_certificate_onehot", "model_key:s n_rows:l certified:b converged:b", """
select model_key, count(*) as n_rows, true as certified, true as converged from train_rows_cat group by model_key""", CV)
def q_huber_certificate_onehot(t):
    """M4 + X17."""
    b = bt_cat(t)
    return certified(b.train_scaled, b.models, b.p).join(b.models.select("model_key", "converged"), "model_key")


@register("dashboard_estimate_120", "skclientkey:l medid:s device_naturalkey:l dist_eed_120:l inventoryquantity:d y_predict:d "
          "dashboard_estimate:d modified_y_predict_120:d MSE_Dashboard:d MAE_Dashboard:d", """
select skclientkey, medid, device_naturalkey, dist_eed_120, inventoryquantity, y_predict, dash as dashboard_estimate,
       case when dist_eed_120 in (1, 2) then least(greatest(0.0, floor(y_predict)), inventoryquantity) else 0.0 end as modified_y_predict_120,
       (dash - y) ** 2 as MSE_Dashboard, abs(dash - y) as MAE_Dashboard
from (select *, case when dist_eed_120 = 1 then floor(0.45 * inventoryquantity) else 0.0 end as dash,
             cast((device_naturalkey * 3 + cast(substr(medid, 7) as integer) * 7 + month) % 40 - 5 as double) as y_predict
      from test_feat_cat)""", CV)
def q_dashboard_120(t):
    """P7, second form: results that hold the EED category instead of the distance (stand-in scores)."""
    return bt_cat(t, predictions="stand_in").result(pair_cap=False)


def every_window(t, model="LR"):
    from dosecast.operators.backtest import WindowedBackTest
    b = bt(t)
    return WindowedBackTest(b.inputs, None, P, model)


@register("all_window_models", "train_start:l " + MODEL_SPEC)
def q_all_window_models(t):
    """Huber models of every client and training window in one job (rows-only check)."""
    return (every_window(t).models.withColumn("n_coef", F.size("coef"))
            .withColumn("train_start", F.split("model_key", r"\|").getItem(0).cast("long")))


@register("all_window_certificate", "model_key:s n_rows:l certified:b converged:b", """
select model_key, count(*) as n_rows, true as certified, true as converged from every_train group by model_key""", AV)
def q_all_window_certificate(t):
    """M10 + M4: the certificate of every model of every window."""
    w = every_window(t)
    return (certified(wn.apply_scaler(w.train, w.scaler, P), w.models)
            .join(large(w.models.select("model_key", "converged")), "model_key"))
