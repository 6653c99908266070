"""Reference-shaped input views derived from the driver tables.

The reference reads warehouse extracts (transactions, usage, month-end
snapshots, unit costs, names) and segment / pixel tables.  These functions
derive the same shapes from the TPC-H-like tables so that every operator
has an input whose size grows with the scale factor.  The rules are the
ones written down in FIXTURES.md section 2; the DuckDB oracle defines the
same views in SQL (``dosecast.plans.oracle_views``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from dosecast.functions.months import brand_no, datekey_of, mi_first_day, mi_last_day, mi_of
from dosecast.session import materialize, partitions_for
from dosecast.sources.tables import Tables


def facility(t: Tables) -> DataFrame:
    """Clients with their shard and IDN; ismaenabled marks active ones."""
    n, r = t.nation, t.region
    return (n.join(F.broadcast(r), n.n_regionkey == r.r_regionkey)
            .select(F.col("n_nationkey").cast("long").alias("skclientkey"),
                    F.col("n_regionkey").cast("long").alias("hdp_shardid"),
                    F.col("r_name").alias("idn_name"),
                    F.when(F.col("n_nationkey") % 5 != 0, 1).otherwise(0).alias("ismaenabled")))


def active_facilities(t: Tables) -> DataFrame:
    """active facilities only."""
    return facility(t).where(F.col("ismaenabled") == 1)


def item(t: Tables) -> DataFrame:
    """SCD2 item dimension: an item key belongs to a client of a shard, and other clients use the same
    keys; one current version of each (part, client, shard) with transactions, plus closed ones."""
    s, n = t.supplier.select("s_suppkey", "s_nationkey"), t.nation.select("n_nationkey", "n_regionkey")
    li = t.lineitem.select("l_partkey", "l_suppkey")
    # Supplier first: its own size decides how it is joined, not the product of the sizes of a join.
    owner = (li.join(s, li.l_suppkey == s.s_suppkey).join(F.broadcast(n), F.col("s_nationkey") == n.n_nationkey)
             .select("l_partkey", F.col("s_nationkey").cast("long").alias("skclientkey"),
                     F.col("n_regionkey").cast("long").alias("hdp_shardid")).distinct())
    p = t.part.select("p_partkey", "p_brand")
    cur = owner.join(p, owner.l_partkey == p.p_partkey).select(
        F.col("p_partkey").alias("itemrootkey"), "skclientkey", "hdp_shardid", F.col("p_brand").alias("itemid"),
        F.when(brand_no("p_brand") % 10 != 0, 1).otherwise(0).alias("meditemflag"),
        F.lit(None).cast("timestamp_ntz").alias("endlocaldatetime"))
    old = cur.where(F.col("itemrootkey") % 3 == 0).withColumns({
        "itemid": F.lit("old"), "endlocaldatetime": F.lit("1996-01-01 00:00:00").cast("timestamp_ntz")})
    return cur.unionByName(old)


def current(dim: DataFrame) -> DataFrame:
    """SCD2 current version, applied to the dimension before a join."""
    return dim.where(F.col("endlocaldatetime").isNull())


def device(t: Tables) -> DataFrame:
    s, n = t.supplier, t.nation
    return (s.join(F.broadcast(n.select("n_nationkey", "n_regionkey")), s.s_nationkey == n.n_nationkey)
            .select(F.col("s_suppkey").alias("dispensingdevicerootkey"),
                    F.col("s_name").alias("dispensingdevicename"),
                    F.col("s_nationkey").cast("long").alias("skclientkey"),
                    F.col("n_regionkey").cast("long").alias("hdp_shardid"),
                    F.when(F.col("s_suppkey") % 5 == 0, 4)
                     .otherwise(1 + F.col("s_suppkey") % 2).cast("int").alias("devicetypekey"),
                    F.lit(None).cast("timestamp_ntz").alias("endlocaldatetime")))


def med_name(medid) -> F.Column:
    """Full medicine name of a fixture medid (null for brand 7)."""
    m = F.col(medid) if isinstance(medid, str) else medid
    b = brand_no(m)
    return (F.when(b % 12 == 0, F.concat(F.lit("Insulin "), m))
             .when(b % 12 == 5, F.concat(F.lit("Patient supply "), m))
             .when(b == 7, F.lit(None).cast("string"))
             .otherwise(m))


def tx(t: Tables) -> DataFrame:
    """Item transactions (all types) at transaction grain."""
    li, s, n = t.lineitem, t.supplier.select("s_suppkey", "s_nationkey"), t.nation.select("n_nationkey", "n_regionkey")
    j = li.join(s, li.l_suppkey == s.s_suppkey).join(F.broadcast(n), F.col("s_nationkey") == n.n_nationkey)
    start = F.col("l_quantity") + F.col("l_linenumber")
    end = F.col("l_linenumber") + F.when(F.col("l_orderkey") % 50 == 0, 1).otherwise(0)
    return j.select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("itemtransactionkey"),
        F.col("l_partkey").alias("itemrootkey"),
        F.col("l_suppkey").alias("dispensingdevicerootkey"),
        F.col("s_nationkey").cast("long").alias("skclientkey"),
        F.col("n_regionkey").cast("long").alias("hdp_shardid"),
        F.col("l_shipdate").alias("transactionlocaldatetime"),
        F.when(F.col("l_returnflag") == "A", 13).when(F.col("l_returnflag") == "R", 502)
         .otherwise(1).alias("legacytransactiontypekey"),
        F.col("l_quantity").alias("transactionquantity"),
        start.cast("double").alias("startstoragespaceinventoryquantity"),
        end.cast("double").alias("endstoragespaceinventoryquantity"),
        F.when(F.col("l_orderkey") % 40 == 0, 1).otherwise(0).alias("cancelflag"),
        F.when(F.col("l_orderkey") % 7 == 0, F.lit(None)).otherwise(start).cast("double")
         .alias("actualbegincount"))


def usage_src(t: Tables) -> DataFrame:
    """Daily usage rows (type-1 transactions), before the A1 month roll-up."""
    x = tx(t).where(F.col("legacytransactiontypekey") == 1)
    p = t.part.select("p_partkey", "p_brand")
    j = x.join(p, x.itemrootkey == p.p_partkey)
    return j.select(
        F.col("hdp_shardid"), F.col("skclientkey").alias("clientkey"),
        brand_no("p_brand").cast("long").alias("medkey"),
        F.col("dispensingdevicerootkey").alias("devicekey"),
        datekey_of("transactionlocaldatetime").alias("datekey"),
        F.col("transactionquantity").alias("usagedoses"),
        F.lit(1).cast("long").alias("usage"),
        F.when(F.col("itemtransactionkey") % 8 == 7, 1).otherwise(2).alias("sourcesystemkey"))


def med(t: Tables) -> DataFrame:
    """Medicine dimension per (shard, client, medkey), from the usage rows."""
    x = tx(t).where(F.col("legacytransactiontypekey") == 1)
    p = t.part.select("p_partkey", "p_brand")
    j = x.join(p, x.itemrootkey == p.p_partkey).select("hdp_shardid", "skclientkey", "p_brand").distinct()
    b = brand_no("p_brand")
    ck = F.col("skclientkey")
    return j.select(
        F.col("hdp_shardid"), F.col("skclientkey").alias("clientkey"),
        b.cast("long").alias("medkey"), F.col("p_brand").alias("medid"),
        F.when(b % 4 == 0, 1).otherwise(0).alias("iscontrolledmed"),
        F.when((b + ck) % 13 == 0, 0).otherwise(1).alias("isactive"),
        F.when(b % 9 == 0, 1).otherwise(0).alias("ismedexcluded"),
        F.when((b + ck) % 17 == 0, 1).otherwise(0).alias("isshortageexcluded"))


def usage_device(t: Tables) -> DataFrame:
    """Device dimension of the usage extract (keyed by shard and device key)."""
    d = device(t)
    return d.select("hdp_shardid", F.col("dispensingdevicerootkey").alias("devicekey"),
                    F.col("dispensingdevicename").alias("devicename"),
                    F.col("dispensingdevicerootkey").alias("naturalkey"))


def pocket_snapshot(t: Tables) -> DataFrame:
    """Pocket-level month-end snapshot rows (input of A2), one per lineitem.

    The pocket of line (order, line) is observed at the end of its ship month.
    """
    li = t.lineitem
    s = t.supplier.select("s_suppkey", "s_nationkey")
    n = t.nation.select("n_nationkey", "n_regionkey")
    j = li.join(s, li.l_suppkey == s.s_suppkey).join(F.broadcast(n), F.col("s_nationkey") == n.n_nationkey)
    me = F.last_day(F.col("l_shipdate").cast("date"))
    ok = F.col("l_orderkey")
    return j.select(
        F.col("s_nationkey").cast("long").alias("skclientkey"),
        F.col("n_regionkey").cast("long").alias("hdp_shardid"),
        datekey_of(me).alias("sktimekeyeffmonth"),
        F.col("l_partkey").alias("itemrootkey"),
        F.col("l_suppkey").alias("dispensingdevicerootkey"),
        F.when(ok % 11 == 0, 1).otherwise(0).alias("isinactive"),
        F.col("l_quantity").alias("cur"),
        F.when(ok % 9 == 0, F.lit(None).cast("int"))
         .otherwise(datekey_of(F.date_add(me, (ok % 400).cast("int")))).alias("expireitemtimekey"),
        (F.col("l_linenumber") % 2).alias("standardstockwithindispensingdeviceflag"),
        (F.col("l_quantity") + 10).alias("max"),
        F.floor(F.col("l_quantity") / 4).cast("double").alias("min"))


def snap_grid(t: Tables) -> tuple[DataFrame, int | None, int | None, int]:
    """The snapshot's pairs (brand, device), written; its first and last month; the number of its rows.

    The month axis runs from the month before the first transaction to the month
    of the last one, so every month with transactions has its row; it is bounded
    by calendar time, whatever the number of rows.
    """
    ship = mi_of("l_shipdate")
    first, last = t.lineitem.select(F.min(ship) - 1, F.max(ship)).first()
    li = t.lineitem.select("l_partkey", "l_suppkey")
    p = t.part.select("p_partkey", "p_brand")
    pairs = (li.join(p, li.l_partkey == p.p_partkey)
             .select(F.col("p_brand").alias("medid"), F.col("l_suppkey").alias("s")).distinct())
    seen = Observation("pairs")
    pairs = materialize(pairs, "pairs", (seen, F.count(F.lit(1)).alias("n")))
    return pairs, first, last, seen.get["n"] * (0 if first is None else last - first + 1)


def snap(t: Tables, grid=None) -> DataFrame:
    """Month-end snapshot per (brand, device) and month, FIXTURES rules.

    ``mi`` is the month of the snapshot; the row describes month ``mi + 1``.
    ``grid``: the ``snap_grid`` where it is there already.
    """
    pairs, first, last, rows = grid or snap_grid(t)
    d = device(t).select(F.col("dispensingdevicerootkey").alias("s"), "skclientkey", "hdp_shardid",
                         "dispensingdevicename", "devicetypekey")
    # Dealt by pair before the months are put in: the pair's window and the table by pair then need no other shuffle.
    x = (pairs.join(d, "s").repartition(partitions_for(t.spark, rows), "s", "medid", "skclientkey")
         .withColumn("mi", F.explode(F.sequence(F.lit(first).cast("int"), F.lit(last).cast("int")))))
    s, b, mi = F.col("s"), brand_no("medid"), F.col("mi")
    inv = (s * 7 + b * 13 + mi * 5) % 60 + F.when((s + b + mi) % 23 == 0, 2000).otherwise(0)
    maxpar = 20 + (b * 3 + s) % 30
    first_next = mi_first_day(mi + 1)
    eed = F.when((s + b + mi) % 9 == 0, F.lit(None).cast("date")) \
           .otherwise(F.date_add(first_next, ((s * 31 + b * 17 + mi * 11) % 400 - 40).cast("int")))
    return x.select(
        "skclientkey", "hdp_shardid",
        mi_last_day(mi).alias("lastday_of_month"),
        "medid", "dispensingdevicename", "devicetypekey",
        F.when(b % 10 != 0, 1).otherwise(0).alias("meditemflag"),
        s.alias("device_naturalkey"),
        F.when(((s + b) % 11 == 0) & (mi % 12 > 9), 1).otherwise(0).alias("isinactive"),
        inv.cast("double").alias("inventoryquantity"),
        eed.alias("earliestnextexpirationdate"),
        ((b + s) % 2).cast("int").alias("standardstockwithindispensingdeviceflag"),
        maxpar.cast("double").alias("max_par_level"),
        F.floor(maxpar / 4).cast("double").alias("min_par_level"))


def cost_src(t: Tables) -> DataFrame:
    """Unit-cost history rows; each part is priced in five clients."""
    p, n = t.part, t.nation
    j = p.join(F.broadcast(n.select("n_nationkey", "n_regionkey")),
               (p.p_partkey % 5) == (n.n_nationkey % 5))
    return j.select(
        F.col("n_nationkey").cast("long").alias("clientkey"),
        F.col("p_brand").alias("medid"),
        F.timestamp_add("DAY", F.col("p_size"), F.lit("1995-01-01 00:00:00").cast("timestamp_ntz"))
         .alias("lastmodifieddatetime"),
        F.when(F.col("p_partkey") % 11 == 0, F.lit(None)).otherwise(F.col("p_retailprice"))
         .cast("double").alias("unitcost"),
        F.col("n_regionkey").cast("long").alias("hdp_shardid"),
        F.when(F.col("p_partkey") % 4 == 0, 1).otherwise(2).alias("sourcesystemkey"),
        F.col("p_partkey").alias("medkey"))


# ---------------------------------------------------------------- geometry

def _n_suppliers(t: Tables):
    return t.supplier.select(F.count(F.lit(1))).scalar()


def hseg(t: Tables) -> DataFrame:
    """Horizontal segments, one per distinct (order, line, part, supplier)."""
    g = (t.lineitem.groupBy("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
         .agg(F.max("l_quantity").alias("q")))
    x1 = (F.col("l_orderkey") % 1000).cast("double")
    return g.select(
        F.col("l_suppkey").alias("tile"),
        ((F.col("l_orderkey") * 8 + F.col("l_linenumber")) * 1000000 + F.col("l_partkey")).alias("id"),
        x1.alias("x1"), (x1 + F.col("q")).alias("x2"),
        (F.col("l_partkey") % 200).cast("double").alias("y"),
        F.col("l_linenumber").alias("ln"))


def vseg(t: Tables) -> DataFrame:
    """Vertical segments, one per order."""
    o = t.orders
    y1 = (F.col("o_custkey") % 200).cast("double")
    return o.select(
        (F.col("o_custkey") % _n_suppliers(t)).alias("tile"),
        F.col("o_orderkey").alias("id"),
        (F.col("o_orderkey") % 1000).cast("double").alias("x"),
        y1.alias("y1"), (y1 + 1 + F.col("o_orderkey") % 30).alias("y2"))


def seg_a(t: Tables) -> DataFrame:
    """Slanted form of ``vseg`` (x2 = x1 + orderkey % 3)."""
    v = vseg(t)
    o = t.orders.select(F.col("o_orderkey").alias("id"), (F.col("o_orderkey") % 3).alias("dx"))
    return v.join(o, "id").select("tile", "id", F.col("x").alias("x1"), F.col("y1"),
                                  (F.col("x") + F.col("dx")).alias("x2"), F.col("y2"))


def seg_b(t: Tables) -> DataFrame:
    """Slanted form of ``hseg`` (y2 = y1 + linenumber % 2)."""
    h = hseg(t)
    return h.select("tile", "id", "x1", F.col("y").alias("y1"), "x2",
                    (F.col("y") + F.col("ln") % 2).alias("y2"))


def via(t: Tables) -> DataFrame:
    e = t.events
    return e.select((F.col("user_id") % _n_suppliers(t)).alias("tile"),
                    F.col("event_id").alias("id"),
                    (F.col("event_id") % 1000).cast("double").alias("x"),
                    ((F.col("user_id") * 7) % 200).cast("double").alias("y"))


def pixel(t: Tables) -> DataFrame:
    """8x8 tiles of values from the embeddings."""
    e = t.embeddings.select("vec_id", F.posexplode("embedding").alias("pos", "e"))
    return e.select(F.col("vec_id").alias("tile"),
                    F.floor(F.col("pos") / 8).cast("int").alias("r"),
                    (F.col("pos") % 8).cast("int").alias("c"),
                    F.floor(F.col("e").cast("double") * 1000).cast("long").alias("v"))


def stand_in_prediction(s, b, mi) -> F.Column:
    """Deterministic stand-in model score for exact checks of the rules."""
    return ((s * 3 + b * 7 + mi) % 40 - 5).cast("double")
