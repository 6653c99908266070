"""Audit and scalar-function queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from dosecast.functions.months import datekey_of, mi_of, yyyymm_of_mi
from dosecast.operators import audit as au
from dosecast.operators import extract as ex
from dosecast.operators import panel as pn
from dosecast.operators.panel import KEY5
from dosecast.params import DEFAULT
from dosecast.plans.catalog import register
from dosecast.sources import fixtures as fx

P = DEFAULT


@register("join_audit", """both_sides:l left_only:l right_only:l left_rows:l right_rows:l left_join_rows:l right_join_rows:l
outer_join_rows:l cross_join_rows:l how:s row_rule_ok:b""", """
select both_sides, left_only, right_only, left_rows, right_rows, both_sides + left_only as left_join_rows,
       both_sides + right_only as right_join_rows, both_sides + left_only + right_only as outer_join_rows, left_rows * right_rows as cross_join_rows, 'left' as how,
       both_sides + left_only = left_rows as row_rule_ok
from (select count_if(l.m is not null and r.m is not null) as both_sides, count_if(r.m is null) as left_only,
             count_if(l.m is null) as right_only,
             (select count(*) from snap_feat) as left_rows, (select count(*) from usage_feat) as right_rows
      from (select hdp_shardid, skclientkey, medid, device_naturalkey, month, 1 as m from snap_feat) l
      full join (select hdp_shardid, skclientkey, medid, device_naturalkey, month, 1 as m from usage_feat) r
      using (hdp_shardid, skclientkey, medid, device_naturalkey, month))""")
def q_join_audit(t):
    """J16 on the panel's snapshot-usage join."""
    i = pn.Inputs.shared(t, P)
    return au.join_audit(i.snap.select(*KEY5), i.usage.select(*KEY5), KEY5, "left")


@register("m1_violations", "hdp_shardid:l skclientkey:l medid:s count:l", """
select hdp_shardid, skclientkey, medid, count(*) as count from (
  select c.*, k.medkey from latest_cost c
  join (select distinct clientkey, hdp_shardid, sourcesystemkey, medid, medkey from cost_src) k
    on k.hdp_shardid = c.hdp_shardid and k.clientkey = c.skclientkey and k.sourcesystemkey = c.sourcesystemkey
   and k.medid = c.medid)
group by hdp_shardid, skclientkey, medid having count(*) > 1""")
def q_m1(t):
    """The medkey form of the cost table breaks the panel's many-to-one cost join."""
    return au.m1_violations(ex.cost_with_medkeys(t), ["hdp_shardid", "skclientkey", "medid"])


@register("duplicate_keys", "clientkey:l medkey:l devicekey:l datekey:l count:l", """
select clientkey, medkey, devicekey, datekey, count(*) as count from usage_src
group by all having count(*) > 1""")
def q_dups(t):
    """Duplicated daily usage keys."""
    from dosecast.operators.report import duplicate_keys
    return duplicate_keys(fx.usage_src(t), ["clientkey", "medkey", "devicekey", "datekey"])


@register("dedupe", "skclientkey:l medid:s medfullname:s transactionlocaldatetime:ts itemtransactionkey:l", """
select skclientkey, medid, medfullname, transactionlocaldatetime, itemtransactionkey from (
  select *, row_number() over (partition by skclientkey, medid
                               order by transactionlocaldatetime desc, itemtransactionkey desc) as rn
  from removal_tx) where rn = 1""")
def q_dedupe(t):
    """Keep the last transaction row per client and medicine."""
    r = ex.removal_tx(t).select("skclientkey", "medid", "medfullname", "transactionlocaldatetime",
                                "itemtransactionkey")
    return au.keep_last(r, ["skclientkey", "medid"], ["transactionlocaldatetime", "itemtransactionkey"])


SCALAR_SPEC = """l_orderkey:l l_linenumber:l f_floor:l f_bround:d f_month_of_key:l f_rint:d f_trunc:l f_abs:d f_sq:d
f_sqrt:d f_least:d f_clip:d f_case:l f_mod:l f_div:l f_next_month:l f_year:l f_month:l f_next_day:dt f_days:l
f_after:b f_contains:b f_prefix:l f_keys:s f_fill:d f_isnull:b"""


@register("scalar_suite", SCALAR_SPEC, """
select l_orderkey, l_linenumber,
       floor(l_extendedprice / 7) as f_floor,
       round_even(l_quantity / 2, 0) as f_bround,
       floor((year(l_shipdate) * 10000 + month(l_shipdate) * 100 + day(l_shipdate)) / 100) as f_month_of_key,
       round_even(l_quantity / 4, 0) as f_rint,
       trunc(l_extendedprice / 3) as f_trunc,
       abs(l_discount - 0.05) as f_abs, pow(l_tax, 2) as f_sq, sqrt(l_quantity) as f_sqrt,
       least(l_discount, l_tax) as f_least, greatest(least(l_quantity - 10, 30), 0) as f_clip,
       case when l_returnflag = 'A' then 1 when l_returnflag = 'R' then 2 else 0 end as f_case,
       l_orderkey % 7 as f_mod, floor(l_orderkey / 7) as f_div,
       cast(floor((year(l_shipdate) * 12 + month(l_shipdate)) / 12) * 100
            + (year(l_shipdate) * 12 + month(l_shipdate)) % 12 + 1 as bigint) as f_next_month,
       year(l_shipdate) as f_year, month(l_shipdate) as f_month,
       cast(l_shipdate as date) + 1 as f_next_day,
       date_diff('day', cast(l_shipdate as date), date '1998-12-01') as f_days,
       l_shipdate >= timestamp '1996-01-01 00:00:00' as f_after,
       contains(lower(l_returnflag), 'a') as f_contains,
       cast(substr(cast(l_orderkey as varchar), 1, 2) as integer) as f_prefix,
       concat_ws('|', l_orderkey, l_linenumber) as f_keys,
       coalesce(case when l_orderkey % 7 = 0 then null else l_tax end, 0) as f_fill,
       case when l_orderkey % 7 = 0 then null else l_tax end is null as f_isnull
from lineitem""")
def q_scalars(t):
    """X1-X16 side by side on lineitem."""
    li = t.lineitem
    mi = mi_of("l_shipdate")
    tax_or_null = F.when(F.col("l_orderkey") % 7 == 0, F.lit(None)).otherwise(F.col("l_tax"))
    return li.select(
        "l_orderkey", "l_linenumber",
        F.floor(F.col("l_extendedprice") / 7).alias("f_floor"),
        F.bround(F.col("l_quantity") / 2, 0).alias("f_bround"),
        F.floor(datekey_of("l_shipdate") / 100).alias("f_month_of_key"),
        F.rint(F.col("l_quantity") / 4).alias("f_rint"),
        (F.col("l_extendedprice") / 3).cast("int").alias("f_trunc"),
        F.abs(F.col("l_discount") - 0.05).alias("f_abs"), F.pow("l_tax", 2).alias("f_sq"),
        F.sqrt("l_quantity").alias("f_sqrt"),
        F.least("l_discount", "l_tax").alias("f_least"),
        F.greatest(F.least(F.col("l_quantity") - 10, F.lit(30.0)), F.lit(0.0)).alias("f_clip"),
        F.when(F.col("l_returnflag") == "A", 1).when(F.col("l_returnflag") == "R", 2).otherwise(0).alias("f_case"),
        (F.col("l_orderkey") % 7).alias("f_mod"), F.floor(F.col("l_orderkey") / 7).alias("f_div"),
        yyyymm_of_mi(mi + 1).alias("f_next_month"),
        F.year("l_shipdate").alias("f_year"), F.month("l_shipdate").alias("f_month"),
        F.date_add(F.col("l_shipdate").cast("date"), 1).alias("f_next_day"),
        F.datediff(F.lit("1998-12-01").cast("date"), F.col("l_shipdate").cast("date")).alias("f_days"),
        (F.col("l_shipdate") >= F.lit("1996-01-01 00:00:00").cast("timestamp_ntz")).alias("f_after"),
        F.lower("l_returnflag").contains("a").alias("f_contains"),
        F.substring(F.col("l_orderkey").cast("string"), 1, 2).cast("int").alias("f_prefix"),
        F.concat_ws("|", "l_orderkey", "l_linenumber").alias("f_keys"),
        F.coalesce(tax_or_null, F.lit(0.0)).alias("f_fill"),
        tax_or_null.isNull().alias("f_isnull"))
