"""Pair x month panel: derived columns, the panel join and the exclusions."""

from __future__ import annotations

from functools import cache, cached_property

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dosecast.functions.months import mi_of, mi_of_yyyymm
from dosecast.operators import extract as ex
from dosecast.operators import windows as wn
from dosecast.operators.extract import PAIR, PAIR4
from dosecast.params import DEFAULT, Params
from dosecast.session import SHARED, large, materialize, materialize_all, materialize_by, partitions_for, small_or_large
from dosecast.sources import fixtures as fx
from dosecast.sources.tables import Tables

KEY5 = PAIR4 + ["month"]


def eed_category(dist: str, days: int) -> F.Column:
    """> days -> 0, < 0 -> 2, else 1."""
    d = F.col(dist)
    return F.when(d > days, 0).when(d < 0, 2).otherwise(1)


def add_dist_eed(s: DataFrame) -> DataFrame:
    """Days from the month's first day to the EED.

    A null EED takes the floor of the pair's mean distance; a pair without
    any EED gets 0.  The pair window holds one row per month, so it is small.
    """
    raw = F.datediff(F.col("earliestnextexpirationdate"), F.col("monthfirstday"))
    w = Window.partitionBy(*PAIR)
    return (s.withColumn("_d", raw)
             .withColumn("dist_eed", F.coalesce(F.col("_d"), F.floor(F.avg("_d").over(w)), F.lit(0))
                         .cast("int"))
             .drop("_d"))


def snap_features(snap: DataFrame) -> DataFrame:
    """P1 + P2 + P3 on the month-end snapshot: the row describes the next month."""
    s = (snap.withColumn("monthfirstday", F.date_add("lastday_of_month", 1))
             .withColumn("month", mi_of("monthfirstday")))
    s = add_dist_eed(s)
    return (s.withColumn("dist_eed_120", eed_category("dist_eed", 120))
             .withColumn("dist_eed_90", eed_category("dist_eed", 90)))


def usage_features(usage: DataFrame) -> DataFrame:
    """P1 on monthly usage: usage of month m is a feature of m + 1."""
    return usage.withColumnsRenamed({"clientkey": "skclientkey", "devicename": "dispensingdevicename"}).select(
        "hdp_shardid", "skclientkey", "medid", "device_naturalkey", "dispensingdevicename",
        (mi_of_yyyymm("year_month") + 1).alias("month"),
        "avgdailyusage30",
        (F.col("avgdailyusage30") * 100).cast("long").alias("usage100"))


def _latest_values(rtx: DataFrame, keys: list[str], value: str) -> DataFrame:
    """value(s) at the latest transaction per key; ties kept, then distinct.

    A partial ``max`` per key and an equi-join back on (key, timestamp): no
    window holds a whole (possibly hot) key in one task.
    """
    ts = "transactionlocaldatetime"
    last = rtx.groupBy(*keys).agg(F.max(ts).alias(ts))
    return rtx.select(*keys, value, ts).join(last, [*keys, ts]).select(*keys, value).distinct()


def latest_med_name(rtx: DataFrame) -> DataFrame:
    """name(s) at the latest transaction per client and med; ties kept."""
    return _latest_values(rtx, ["skclientkey", "medid"], "medfullname")


def latest_device_name(rtx: DataFrame) -> DataFrame:
    """Device name(s) at the latest transaction per client and device."""
    return _latest_values(rtx, ["skclientkey", "device_naturalkey"], "dispensingdevicename")


SNAP_COLS = KEY5 + ["inventoryquantity", "standardstockwithindispensingdeviceflag", "dist_eed",
                    "dist_eed_120", "dist_eed_90", "max_par_level", "min_par_level", "devicetypekey",
                    "meditemflag", "isinactive"]


COST_COLS = ["hdp_shardid", "skclientkey", "medid", "unitcost"]


class Inputs:
    """The extracts and the names of one run, each built when first read, once, and shared.

    Like the reference's extraction CTAS tables, the removal transactions,
    monthly usage, snapshot features and latest costs are materialized
    in the shared checkpoint folder: each feeds several branches (removals
    and both name tables; the panel and the test-month features).  Usage,
    snapshots and removals have one row for each pair and month and are bucketed by
    pair, so joining them, and everything by pair on the panel, needs no shuffle.
    ``materialize=False`` keeps everything lazy.
    """

    def __init__(self, t: Tables, p: Params = DEFAULT, materialize: bool = True):
        """From the fixture views of the driver tables."""
        grid = cache(lambda: fx.snap_grid(t))
        self._load({"rtx": lambda: ex.removal_tx(t),
                    "usage": lambda: usage_features(ex.monthly_usage(t)),
                    "snap": lambda: snap_features(fx.snap(t, grid())),
                    "cost": lambda: ex.latest_cost(t).select(*COST_COLS)}, p, materialize,
                   lambda: partitions_for(t.spark, grid()[-1]))

    @classmethod
    def shared(cls, t: Tables, p: Params = DEFAULT) -> Inputs:
        """One instance for all queries of an application over one folder, until ``session.release``."""
        key = (t.spark.sparkContext.applicationId, t.sf_dir, p)
        if key not in SHARED:
            SHARED[key] = cls(t, p)
        return SHARED[key]

    @classmethod
    def from_frames(cls, tx: DataFrame, usage: DataFrame, snap: DataFrame, cost: DataFrame, p: Params = DEFAULT,
                    materialize: bool = True, med_names: DataFrame | None = None,
                    device_names: DataFrame | None = None) -> Inputs:
        """From the four extracts (removal transactions, monthly usage, month-end snapshots, latest costs).

        ``med_names`` and ``device_names`` (S6: one name for each med or device of a client) replace the
        names at the latest transaction where they are given.  Rows repeated in the cost extract are read once.
        """
        i = cls.__new__(cls)
        i._load({"rtx": lambda: tx,
                 "usage": lambda: usage_features(usage),
                 "snap": lambda: snap_features(snap),
                 "cost": lambda: cost.select(*COST_COLS).distinct()}, p, materialize,
                lambda: partitions_for(snap.sparkSession, snap.count()))
        if med_names is not None:
            i.med_names = med_names.select("skclientkey", "medid", "medfullname").distinct()
        if device_names is not None:
            i.device_names = device_names.select("skclientkey", "device_naturalkey", "dispensingdevicename").distinct()
        return i

    def _load(self, parts: dict, p: Params, materialize: bool, partitions) -> None:
        self.p, self._parts, self.materialized, self._built, self._partitions = p, parts, materialize, {}, partitions

    @cached_property
    def partitions(self) -> int:
        """Buckets of all tables by pair, from the rows of the largest, the snapshots."""
        return self._partitions()

    def build(self, *names: str) -> list[DataFrame]:
        """The named extracts; those not there yet are built as concurrent jobs."""
        new = {n: self._parts[n] for n in names if n not in self._built}
        if self.materialized:
            by = {n: PAIR for n in ("usage", "snap")}
            self._built |= materialize_all(new, by, self.partitions if new.keys() & by.keys() else None)
        else:
            self._built |= {n: f() for n, f in new.items()}
        return [self._built[n] for n in names]

    @property
    def rtx(self) -> DataFrame:
        return self.build("rtx")[0]

    @property
    def usage(self) -> DataFrame:
        return self.build("usage")[0]

    @property
    def snap(self) -> DataFrame:
        return self.build("snap")[0]

    @property
    def cost(self) -> DataFrame:
        return self.build("cost")[0]

    @cached_property
    def removals(self) -> DataFrame:
        r = ex.monthly_removals(self.rtx, self.p)
        return materialize_by(r, PAIR, "removals", self.partitions) if self.materialized else r

    @cached_property
    def windows(self) -> DataFrame:
        """T3 of every client, from the usage extract: clients x months, read by every step over all windows."""
        w = wn.test_months(self.usage.select("skclientkey", (F.col("month") - 1).alias("mi")), self.p.window_months)
        return materialize(w, "windows") if self.materialized else w

    @cached_property
    def med_names(self) -> DataFrame:
        return latest_med_name(self.rtx)

    @cached_property
    def device_names(self) -> DataFrame:
        return latest_device_name(self.rtx)

    @cached_property
    def eligible(self) -> DataFrame:
        """F12 on the panel: read by pairs, training rows, test rows, profiles and the all-pair rule."""
        e = eligible(build_panel(self), self.p)
        return materialize_by(e, PAIR, "eligible", self.partitions) if self.materialized else e


def pair_months(i: Inputs) -> DataFrame:
    """Snapshots with the usage and removals of their pair and month: all three are bucketed by pair."""
    u = i.usage.select(*KEY5, "avgdailyusage30", "usage100")
    r = i.removals.select(*KEY5, "transactionquantity", "actualbegincount")
    return i.snap.select(*SNAP_COLS).join(large(u), KEY5, "left").join(large(r), KEY5, "left")


def build_panel(i: Inputs) -> DataFrame:
    """Snapshot-driven panel with usage, cost, removals and names.

    All joins are left joins on keys that are unique on the right, so the
    panel keeps the snapshot's grain; 4 numeric columns are filled with 0.
    """
    i.build("rtx", "usage", "snap", "cost")
    # Counted, as a shuffle of the panel for a table of a few names or costs costs more than all else.
    by_count = small_or_large if i.materialized else lambda df, name: df
    j = (pair_months(i)
         .join(by_count(i.cost, "costs"), ["hdp_shardid", "skclientkey", "medid"], "left")
         .join(by_count(i.med_names, "med_names"), ["skclientkey", "medid"], "left")
         .join(by_count(i.device_names, "device_names"), ["skclientkey", "device_naturalkey"], "left"))
    return (j.fillna(0, subset=["avgdailyusage30", "usage100", "unitcost", "transactionquantity"])
             .withColumn("any_expiry_removal", F.col("actualbegincount").isNotNull()))


def exclusion_marks(df: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """F8-F11 as four boolean columns with the reference's null handling.

    null meditemflag -> kept, null name -> kept, null device type -> excluded,
    null inventory -> kept.
    """
    name = F.lower(F.coalesce(F.col("medfullname"), F.lit("No med full name")))
    hit = F.lit(False)
    for k in p.name_keys:
        hit = hit | name.contains(k)
    return df.withColumns({
        "non_drug": F.coalesce(F.col("meditemflag") == 0, F.lit(False)),
        "insuli_patient": hit,
        "anesth_minitry": F.coalesce(~F.col("devicetypekey").isin(*p.device_types), F.lit(True)),
        "outrng_inv": F.coalesce(F.col("inventoryquantity") > p.inv_cutoff, F.lit(False)),
    })


MARKS = ["non_drug", "insuli_patient", "anesth_minitry", "outrng_inv"]


def eligible(df: DataFrame, p: Params = DEFAULT, nulls: str = "keep") -> DataFrame:
    """F12 (``nulls='keep'``) or F13 (``nulls='drop'``): rows with no mark set."""
    m = exclusion_marks(df, p)
    cond = ~(F.col("non_drug") | F.col("insuli_patient") | F.col("anesth_minitry") | F.col("outrng_inv"))
    if nulls == "drop":
        cond = cond & F.col("meditemflag").isNotNull() & F.col("medfullname").isNotNull() \
                    & F.col("devicetypekey").isNotNull() & F.col("inventoryquantity").isNotNull()
    return m.where(cond).drop(*MARKS)


def excluded_rows(df: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """The audit complement of F12, with the marks that removed each row."""
    m = exclusion_marks(df, p)
    return m.where(F.col("non_drug") | F.col("insuli_patient") | F.col("anesth_minitry") | F.col("outrng_inv"))


def removal_panel(elig: DataFrame) -> DataFrame:
    """Eligible rows with a removal."""
    return elig.where(F.col("any_expiry_removal"))


def tx_panel(i: Inputs) -> DataFrame:
    """Transaction-driven panel (notebook form)."""
    r = i.removals
    u = i.usage.select(*KEY5, "avgdailyusage30", "usage100")
    s = i.snap.select(*SNAP_COLS)
    j = (r.join(i.cost, ["hdp_shardid", "skclientkey", "medid"], "left")
          .join(large(u), KEY5, "left")
          .join(large(s), KEY5, "left"))
    return j.fillna(0, subset=["unitcost", "usage100"])


NULL_CHECK = ["hdp_shardid", "skclientkey", "medid", "device_naturalkey", "month", "usage100",
              "inventoryquantity", "dist_eed", "standardstockwithindispensingdeviceflag",
              "transactionquantity", "actualbegincount", "dist_eed_120", "unitcost", "max_par_level",
              "min_par_level", "devicetypekey", "meditemflag"]


def drop_null_inv(txp: DataFrame) -> tuple[DataFrame, DataFrame]:
    """F16: rows without nulls in the model columns, and the null-inventory report."""
    kept = txp.dropna(subset=NULL_CHECK)
    report = txp.where(F.col("inventoryquantity").isNull()) \
                .select("skclientkey", "medid", "device_naturalkey", "month", "transactionquantity",
                        "inventoryquantity")
    return kept, report


def in_window(df: DataFrame, start: int, months: int = 12, col: str = "month") -> DataFrame:
    """rows of a 12-month window (month index, wraps the year naturally)."""
    return df.where(F.col(col).between(start, start + months - 1))


def last_month_status(snap: DataFrame, start: int, months: int = 12) -> DataFrame:
    """Each pair's snapshot status in its last month of the window."""
    w = in_window(snap, start, months)
    return (w.groupBy(*PAIR4)
             .agg(F.max("month").alias("last_month"),
                  F.max_by("isinactive", "month").alias("isinactive")))


def not_unloaded(rows: DataFrame, snap: DataFrame, start: int, months: int = 12) -> DataFrame:
    """Rows of pairs not fully unloaded (isinactive != 1) in that last month."""
    st = last_month_status(snap, start, months).where(F.col("isinactive") != 1) \
        .select(*PAIR4, F.col("isinactive").alias("last_isinactive"))
    return rows.join(large(st), PAIR4, "inner")


def unloaded_pairs(snap: DataFrame, start: int, months: int = 12) -> DataFrame:
    """The audit complement of J8, pairs fully unloaded in their last month of the window."""
    return last_month_status(snap, start, months).where(F.col("isinactive") == 1)
