"""Extraction queries: scans, filters, dimension joins, monthly roll-ups."""

from __future__ import annotations

from pyspark.sql import functions as F

from dosecast.functions.months import datekey_of, lenient_date
from dosecast.operators import extract as ex
from dosecast.plans.catalog import register
from dosecast.sources import fixtures as fx

TX_SPEC = """itemtransactionkey:l itemrootkey:l dispensingdevicerootkey:l skclientkey:l hdp_shardid:l
transactionlocaldatetime:ts legacytransactiontypekey:l transactionquantity:d
startstoragespaceinventoryquantity:d endstoragespaceinventoryquantity:d cancelflag:l actualbegincount:d"""


@register("scan_tx", TX_SPEC, "select * from tx")
def scan_tx(t):
    """The transaction extract with its fixed schema."""
    return fx.tx(t)


@register("lenient_date", "l_orderkey:l l_linenumber:l datekey:l parsed:dt", """
select l_orderkey, l_linenumber, datekey, try_strptime(cast(datekey as varchar), '%Y%m%d')::date as parsed
from (select l_orderkey, l_linenumber,
             year(l_shipdate) * 10000 + month(l_shipdate) * 100 + day(l_shipdate)
             + case when l_orderkey % 13 = 0 then 40 else 0 end as datekey from lineitem)""")
def q_lenient_date(t):
    """Yyyymmdd -> date, impossible days -> null."""
    li = t.lineitem
    k = datekey_of("l_shipdate") + F.when(F.col("l_orderkey") % 13 == 0, 40).otherwise(0)
    return li.select("l_orderkey", "l_linenumber", k.alias("datekey")) \
             .withColumn("parsed", lenient_date("datekey"))


RTX_SPEC = """itemtransactionkey:l skclientkey:l hdp_shardid:l itemrootkey:l medid:s medfullname:s
device_naturalkey:l dispensingdevicename:s transactionlocaldatetime:ts cancelflag:l
startstoragespaceinventoryquantity:d endstoragespaceinventoryquantity:d legacytransactiontypekey:l
transactionquantity:d actualbegincount:d"""


@register("removal_tx", RTX_SPEC, "select * from removal_tx")
def q_removal_tx(t):
    """F1 + F2 + J1 + F6 (minimum slice, part 1)."""
    return ex.removal_tx(t)


MR_SPEC = """hdp_shardid:l skclientkey:l medid:s device_naturalkey:l month:l transactionquantity:d
actualbegincount:d"""


@register("monthly_removals", MR_SPEC, "select * from monthly_removals")
def q_monthly_removals(t):
    """A4 over removal_tx (minimum slice, part 2; the entry() query)."""
    return ex.monthly_removals(ex.removal_tx(t))


@register("client_slice", MR_SPEC, "select * from monthly_removals where skclientkey in (3, 8, 17)")
def q_client_slice(t):
    """Read-back of one extract for a client list."""
    return ex.client_slice(ex.monthly_removals(ex.removal_tx(t)), "skclientkey", [3, 8, 17])


US_SPEC = "hdp_shardid:l clientkey:l medkey:l devicekey:l datekey:l usagedoses:d usage:l sourcesystemkey:l"


@register("usage_filter", US_SPEC, """
select * from usage_src where sourcesystemkey = 2 and floor(datekey / 100) between 199601 and 199706""")
def q_usage_filter(t):
    """source system and month range, written as a bare datekey range."""
    u = fx.usage_src(t)
    return u.where((F.col("sourcesystemkey") == 2) & (F.col("datekey") >= 19960100)
                   & (F.col("datekey") < 19970700))


POCKET_SPEC = """skclientkey:l hdp_shardid:l sktimekeyeffmonth:l itemrootkey:l dispensingdevicerootkey:l
isinactive:l cur:d expireitemtimekey:d standardstockwithindispensingdeviceflag:l max:d min:d"""


@register("snapshot_filter", POCKET_SPEC, """
select * from pocket_snapshot where sktimekeyeffmonth > 19960228 and sktimekeyeffmonth < 19970531""")
def q_snapshot_filter(t):
    """strict day-key range (the last month end is excluded)."""
    return fx.pocket_snapshot(t).where((F.col("sktimekeyeffmonth") > 19960228)
                                       & (F.col("sktimekeyeffmonth") < 19970531))


@register("active_facilities", "skclientkey:l hdp_shardid:l idn_name:s ismaenabled:l",
          "select * from active_facilities")
def q_active(t):
    """F5."""
    return fx.active_facilities(t)


@register("scd2_current", "itemrootkey:l skclientkey:l hdp_shardid:l itemid:s meditemflag:l",
          "select * from item where endlocaldatetime is null")
def q_scd2(t):
    """current version of the SCD2 item dimension."""
    return fx.current(fx.item(t))


UE_SPEC = US_SPEC + """ medid:s iscontrolledmed:l isactive:l ismedexcluded:l isshortageexcluded:l
devicename:s naturalkey:l"""


@register("usage_enriched", UE_SPEC, "select * from usage_enriched")
def q_usage_enriched(t):
    """Usage joined to med and device."""
    return ex.usage_enriched(t)


@register("snapshot_left_device",
          "skclientkey:l hdp_shardid:l dispensingdevicerootkey:l sktimekeyeffmonth:l cur:d dispensingdevicename:s",
          """
select a.skclientkey, a.hdp_shardid, a.dispensingdevicerootkey, a.sktimekeyeffmonth, a.cur, d.dispensingdevicename
from pocket_snapshot a left join device d on d.dispensingdevicerootkey = a.dispensingdevicerootkey
  and d.skclientkey = a.skclientkey and d.hdp_shardid = a.hdp_shardid and d.endlocaldatetime is null
  and d.devicetypekey <> 4""")
def q_snapshot_left_device(t):
    """Left join to an optional dimension; its filter stays on the right side."""
    return ex.snapshot_left_device(t)


MU_SPEC = """hdp_shardid:l clientkey:l medkey:l medid:s devicename:s device_naturalkey:l year_month:l
iscontrolledmed:l isactive:l ismedexcluded:l isshortageexcluded:l avgdailyusage30:d usage_count30:l
MinUsagedateKey:l MaxUsagedateKey:l number_of_activedays:l"""


@register("monthly_usage", MU_SPEC, "select * from monthly_usage")
def q_monthly_usage(t):
    """A1."""
    return ex.monthly_usage(t)


MS_SPEC = """skclientkey:l hdp_shardid:l lastday_of_month:l medid:s meditemflag:l dispensingdevicename:s
devicetypekey:l device_naturalkey:l isinactive:l inventoryquantity:d earliestnextexpirationdate:d
standardstockwithindispensingdeviceflag:l max_par_level:d min_par_level:d"""


@register("monthly_snapshot", MS_SPEC, """
with live_item as (select * exclude (endlocaldatetime) from item where endlocaldatetime is null),
live_device as (
  select dispensingdevicerootkey, skclientkey, hdp_shardid, dispensingdevicename, devicetypekey
  from device where endlocaldatetime is null),
pocket as (
  select * from pocket_snapshot
  where sktimekeyeffmonth between 19950229 and 19970530
    and skclientkey in (select skclientkey from active_facilities)),
named as (
  select pocket.*, itemid, meditemflag, dispensingdevicename, devicetypekey
  from pocket join live_item using (itemrootkey, skclientkey, hdp_shardid)
  left join live_device using (dispensingdevicerootkey, skclientkey, hdp_shardid))
select skclientkey, hdp_shardid, sktimekeyeffmonth as lastday_of_month, itemid as medid, meditemflag, dispensingdevicename,
       devicetypekey, dispensingdevicerootkey as device_naturalkey,
       case sum(isinactive) when 0 then 0 when count(isinactive) then 1 else 2 end as isinactive,
       sum(cur) as inventoryquantity, min(expireitemtimekey) as earliestnextexpirationdate,
       max(standardstockwithindispensingdeviceflag) as standardstockwithindispensingdeviceflag,
       sum("max") as max_par_level, sum("min") as min_par_level
from named group by all""")
def q_monthly_snapshot(t):
    """A2 + A3 + F4 + F5 + J1 + J2."""
    return ex.monthly_snapshot(t, 19950228, 19970531)


@register("unload_state", "skclientkey:l dispensingdevicerootkey:l sktimekeyeffmonth:l isinactive:l n:l", """
select skclientkey, dispensingdevicerootkey, sktimekeyeffmonth,
       case when sum(isinactive) = 0 then 0 when sum(isinactive) = count(isinactive) then 1 else 2 end as isinactive,
       count(*) as n
from pocket_snapshot group by all""")
def q_unload_state(t):
    """A3: three-state unload flag per device and month end."""
    return (fx.pocket_snapshot(t).groupBy("skclientkey", "dispensingdevicerootkey", "sktimekeyeffmonth")
            .agg(ex.unload_state("isinactive").alias("isinactive"), F.count(F.lit(1)).alias("n")))


LC_SPEC = "skclientkey:l medid:s lastmodifieddatetime:ts unitcost:d hdp_shardid:l sourcesystemkey:l"


@register("latest_cost", LC_SPEC, "select * from latest_cost")
def q_latest_cost(t):
    """W1 + F7 + F5 (+ T1: the CTAS sort has no lasting effect and is dropped)."""
    return ex.latest_cost(t)


@register("cost_medkeys", LC_SPEC + " medkey:l", """
select c.*, k.medkey from latest_cost c
join (select distinct clientkey, hdp_shardid, sourcesystemkey, medid, medkey from cost_src) k
  on k.hdp_shardid = c.hdp_shardid and k.clientkey = c.skclientkey and k.sourcesystemkey = c.sourcesystemkey
 and k.medid = c.medid""")
def q_cost_medkeys(t):
    """Second cost CTAS (medkey fan-out form)."""
    return ex.cost_with_medkeys(t)
