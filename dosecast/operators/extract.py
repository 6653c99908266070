"""Warehouse extraction jobs (the reference's SQL scripts), as DataFrames.

Each reference CTAS becomes a function; writing it is left to the caller
(``dosecast.sources.io.save_table``).  Filters are written on bare columns so
that they reach the parquet scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dosecast.functions.months import mi_of
from dosecast.params import DEFAULT, Params
from dosecast.session import small_or_large
from dosecast.sources import fixtures as fx
from dosecast.sources.tables import Tables

# The device first: it has the most values, so a sort by these keys mostly compares that number only.
PAIR = ["device_naturalkey", "medid", "skclientkey"]
PAIR4 = [*PAIR, "hdp_shardid"]

ITEM = ["itemrootkey", "skclientkey", "hdp_shardid"]   # clients share item keys

REMOVAL_TYPES = (13, 502)   # outdate, destock


def removal_filter(tx: DataFrame, clients=None, ts_from=None, ts_to=None) -> DataFrame:
    """outdate/destock, positive quantity, consistent counts, not cancelled.

    ``ts_to`` is inclusive at midnight like the reference's ``<= 'yyyy-mm-dd'``.
    """
    c = (F.col("legacytransactiontypekey").isin(*REMOVAL_TYPES)
         & (F.col("transactionquantity") > 0)
         & ((F.col("startstoragespaceinventoryquantity") - F.col("endstoragespaceinventoryquantity"))
            == F.col("transactionquantity"))
         & (F.col("cancelflag") == 0))
    if clients is not None:
        c = c & F.col("skclientkey").isin(*clients)
    if ts_from is not None:
        c = c & (F.col("transactionlocaldatetime") >= F.lit(ts_from).cast("timestamp_ntz"))
    if ts_to is not None:
        c = c & (F.col("transactionlocaldatetime") <= F.lit(ts_to).cast("timestamp_ntz"))
    return tx.where(c)


def removal_tx(t: Tables, clients=None, ts_from=None, ts_to=None) -> DataFrame:
    """F1 + F2 + J1 + F6: removal transactions of current drug items on current devices.

    The devices are counted, as their join would shuffle every transaction once more.
    """
    x = removal_filter(fx.tx(t), clients, ts_from, ts_to)
    it = (fx.current(fx.item(t)).where(F.col("meditemflag") == 1)
          .select(*ITEM, F.col("itemid").alias("medid")))
    dv = (fx.current(fx.device(t))
          .select(F.col("dispensingdevicerootkey"), "skclientkey", "hdp_shardid", "dispensingdevicename"))
    j = (x.join(it, ITEM)
          .join(small_or_large(dv, "devices"), ["dispensingdevicerootkey", "skclientkey", "hdp_shardid"]))
    return j.select(
        "itemtransactionkey", "skclientkey", "hdp_shardid", "itemrootkey", "medid",
        fx.med_name("medid").alias("medfullname"),
        F.col("dispensingdevicerootkey").alias("device_naturalkey"), "dispensingdevicename",
        "transactionlocaldatetime", "cancelflag", "startstoragespaceinventoryquantity",
        "endstoragespaceinventoryquantity", "legacytransactiontypekey", "transactionquantity",
        "actualbegincount")


def monthly_removals(rtx: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """F14 + A4: removals per pair and month.

    ``actualbegincount`` sums to 0 (not null) over all-null months, as in
    pandas, so every month with a transaction stays a removal month.
    """
    return (rtx.where(F.col("transactionquantity") <= p.rmvl_cutoff)
            .withColumn("month", mi_of("transactionlocaldatetime"))
            .groupBy(*PAIR4, "month")
            .agg(F.sum("transactionquantity").alias("transactionquantity"),
                 F.coalesce(F.sum("actualbegincount"), F.lit(0.0)).alias("actualbegincount")))


def usage_enriched(t: Tables, source_system: int = 2, clients=None,
                   ym_from: int | None = None, ym_to: int | None = None) -> DataFrame:
    """F3 + J1: usage rows joined to the med and device dimensions.

    The month range ``floor(datekey/100) between a and b`` is written as a
    bare ``datekey`` range so it reaches the scan.  Both dimensions are counted, as a
    join with a large one shuffles every usage row.
    """
    u = fx.usage_src(t).where(F.col("sourcesystemkey") == source_system)
    if clients is not None:
        u = u.where(F.col("clientkey").isin(*clients))
    if ym_from is not None:
        u = u.where(F.col("datekey") >= ym_from * 100)
    if ym_to is not None:
        u = u.where(F.col("datekey") < (ym_to + 1) * 100)
    m = small_or_large(fx.med(t), "meds")
    d = small_or_large(fx.usage_device(t), "usage_devices")
    return (u.join(m, ["hdp_shardid", "clientkey", "medkey"])
             .join(d, ["hdp_shardid", "devicekey"]))


def monthly_usage(t: Tables, **kw) -> DataFrame:
    """A1: monthly usage per medicine and device."""
    e = usage_enriched(t, **kw)
    return (e.groupBy("hdp_shardid", "clientkey", "medkey", "medid", "devicename",
                      F.col("naturalkey").alias("device_naturalkey"),
                      F.floor(F.col("datekey") / 100).cast("int").alias("year_month"))
            .agg(F.max("iscontrolledmed").alias("iscontrolledmed"),
                 F.min("isactive").alias("isactive"),
                 F.max("ismedexcluded").alias("ismedexcluded"),
                 F.max("isshortageexcluded").alias("isshortageexcluded"),
                 (F.sum("usagedoses") / 30).alias("avgdailyusage30"),
                 F.sum("usage").alias("usage_count30"),
                 F.min("datekey").alias("MinUsagedateKey"),
                 F.max("datekey").alias("MaxUsagedateKey"),
                 F.count(F.lit(1)).alias("number_of_activedays")))


def unload_state(flag: str = "isinactive") -> F.Column:
    """A3: 0 when no row is inactive, 1 when all are, 2 when some are."""
    s, n = F.sum(flag), F.count(flag)
    return F.when(s == 0, 0).when(s == n, 1).otherwise(2)


def monthly_snapshot(t: Tables, day_from: int | None = None, day_to: int | None = None) -> DataFrame:
    """A2 (+ A3, F4, F5, J1, J2, F6): month-end snapshot per item and device.

    F4 is strict on both ends (``> day_from and < day_to``).
    """
    a = fx.pocket_snapshot(t)
    if day_from is not None:
        a = a.where(F.col("sktimekeyeffmonth") > day_from)
    if day_to is not None:
        a = a.where(F.col("sktimekeyeffmonth") < day_to)
    iaf = fx.active_facilities(t).select("skclientkey")
    it = fx.current(fx.item(t)).select(*ITEM, F.col("itemid").alias("medid"), "meditemflag")
    dv = fx.current(fx.device(t)).select("dispensingdevicerootkey", "skclientkey", "hdp_shardid",
                                         "dispensingdevicename", "devicetypekey")
    j = (a.join(iaf, "skclientkey")
          .join(it, ITEM)
          .join(dv, ["dispensingdevicerootkey", "skclientkey", "hdp_shardid"], "left"))
    return (j.groupBy("skclientkey", "hdp_shardid", F.col("sktimekeyeffmonth").alias("lastday_of_month"),
                      "medid", "meditemflag", "dispensingdevicename", "devicetypekey",
                      F.col("dispensingdevicerootkey").alias("device_naturalkey"))
            .agg(unload_state("isinactive").alias("isinactive"),
                 F.sum("cur").alias("inventoryquantity"),
                 F.min("expireitemtimekey").alias("earliestnextexpirationdate"),
                 F.max("standardstockwithindispensingdeviceflag")
                  .alias("standardstockwithindispensingdeviceflag"),
                 F.sum("max").alias("max_par_level"),
                 F.sum("min").alias("min_par_level")))


def snapshot_left_device(t: Tables) -> DataFrame:
    """Pocket rows with the optional device (all rows kept)."""
    a = fx.pocket_snapshot(t).select("skclientkey", "hdp_shardid", "dispensingdevicerootkey",
                                     "sktimekeyeffmonth", "cur")
    dv = (fx.current(fx.device(t)).where(F.col("devicetypekey") != 4)
          .select("dispensingdevicerootkey", "skclientkey", "hdp_shardid", "dispensingdevicename"))
    return a.join(dv, ["dispensingdevicerootkey", "skclientkey", "hdp_shardid"], "left")


def latest_cost(t: Tables, source_system: int = 2) -> DataFrame:
    """W1 + F7 (+ F5): latest non-null unit cost per client, system, shard, med.

    ``medkey`` breaks ties so the pick is deterministic; Catalyst turns the
    ``row_number() = 1`` filter into a per-partition group limit.
    """
    c = fx.cost_src(t).where(F.col("unitcost").isNotNull())
    w = Window.partitionBy("clientkey", "sourcesystemkey", "hdp_shardid", "medid") \
              .orderBy(F.col("lastmodifieddatetime").desc(), F.col("medkey").desc())
    r = c.withColumn("med_rank", F.row_number().over(w)).where(F.col("med_rank") <= 1)
    iaf = fx.active_facilities(t).select(F.col("skclientkey").alias("clientkey"))
    return (r.join(iaf, "clientkey")
             .where(F.col("sourcesystemkey") == source_system)
             .select(F.col("clientkey").alias("skclientkey"), "medid", "lastmodifieddatetime",
                     "unitcost", "hdp_shardid", "sourcesystemkey"))


def cost_with_medkeys(t: Tables) -> DataFrame:
    """The second cost CTAS: latest cost joined to every medkey of the med.

    This is the fan-out form (several rows per shard, client, med).
    """
    lc = latest_cost(t)
    keys = fx.cost_src(t).select(F.col("clientkey").alias("skclientkey"), "hdp_shardid", "sourcesystemkey",
                                 "medid", "medkey").distinct()
    return lc.join(keys, ["hdp_shardid", "skclientkey", "sourcesystemkey", "medid"])


def client_slice(df: DataFrame, client_col: str, clients) -> DataFrame:
    """Read-back of an extract for some clients."""
    return df.where(F.col(client_col).isin(*clients))
