"""Null rules, month arithmetic, EED fill, profile and overlay semantics (FIXTURES section 3)."""

import datetime as dt

from pyspark.sql import functions as F

from dosecast.functions.months import fold_month, lenient_date, mi_of, mi_of_yyyymm
from dosecast.operators import panel as pn
from dosecast.operators import rules as ru
from dosecast.operators import windows as wn


def test_exclusion_null_rules(spark):
    rows = [  # meditemflag, medfullname, devicetypekey, inventoryquantity
        (1, None, "x", 1, 5.0),       # null name -> kept
        (2, None, "x", 1, 5.0),
        (3, 1, "x", None, 5.0),       # null device type -> excluded
        (4, 1, "x", 1, None),         # null inventory -> kept
        (5, 1, "Insulin glargine", 1, 5.0),
        (6, 1, "PATIENT own", 2, 5.0),
        (7, 0, "x", 1, 5.0),
        (8, 1, "x", 4, 5.0),
        (9, 1, "x", 1, 1000.5),
        (10, 1, "x", 2, 1000.0),
    ]
    df = spark.createDataFrame(rows, "id int, meditemflag int, medfullname string, devicetypekey int, "
                                     "inventoryquantity double")
    df = df.withColumn("medfullname", F.when(F.col("id") == 2, None).otherwise(F.col("medfullname")))
    df = df.withColumn("meditemflag", F.when(F.col("id") == 1, None).otherwise(F.col("meditemflag")))
    kept = {r.id for r in pn.eligible(df).collect()}
    assert kept == {1, 2, 4, 10}
    strict = {r.id for r in pn.eligible(df, nulls="drop").collect()}
    assert strict == {10}


def test_december_rolls_to_january(spark):
    df = spark.createDataFrame([(202012, dt.date(2020, 12, 31))], "ym int, d date")
    r = df.select((mi_of_yyyymm("ym") + 1).alias("usage_month"),
                  mi_of(F.date_add("d", 1)).alias("snap_month")).first()
    jan = 2021 * 12 + 0
    assert r.usage_month == jan and r.snap_month == jan


def test_lenient_date(spark):
    df = spark.createDataFrame([(20200131,), (20200230,), (99999999,)], "k int")
    got = [r.d for r in df.select(lenient_date("k").alias("d")).collect()]
    assert got == [dt.date(2020, 1, 31), None, None]


def test_fold_month(spark):
    start = 2020 * 12 + 2   # 2020-03
    df = spark.createDataFrame([(2020 * 12 + 2,), (2021 * 12 + 1,), (2021 * 12 + 2,)], "m int")
    got = [r.f for r in df.select(fold_month("m", start).alias("f")).collect()]
    assert got == [3, 14, 15]


def test_dist_eed_fill(spark):
    rows = [("c", "m", 1, dt.date(2020, 1, 1), dt.date(2020, 1, 11)),
            ("c", "m", 1, dt.date(2020, 2, 1), dt.date(2020, 2, 4)),
            ("c", "m", 1, dt.date(2020, 3, 1), None),
            ("c", "z", 2, dt.date(2020, 3, 1), None)]
    df = spark.createDataFrame(rows, "skclientkey string, medid string, device_naturalkey int, "
                                     "monthfirstday date, earliestnextexpirationdate date")
    got = {(r.medid, str(r.monthfirstday)): r.dist_eed for r in pn.add_dist_eed(df).collect()}
    assert got[("m", "2020-03-01")] == 6        # floor(mean(10, 3)) = 6
    assert got[("z", "2020-03-01")] == 0


def test_profile_frequency(spark):
    start = 2020 * 12 + 2
    rows = [("c", "m", 1, 2020 * 12 + 13 - 12 + 13, 5.0, 10.0)]  # placeholder replaced below
    del rows
    m = lambda k: 2020 * 12 + k - 1   # noqa: E731  (k = month number counted from Jan of start year)
    rows = [("c", "a", 1, m(14), 5.0, 10.0), ("c", "a", 1, m(7), 3.0, 10.0),     # (14 - 7) / 1 = 7.0
            ("c", "b", 1, m(4), 2.0, 9.0)]                                         # one month -> 1
    df = spark.createDataFrame(rows, "skclientkey string, medid string, device_naturalkey int, month int, "
                                     "y double, inventoryquantity double")
    got = {r.medid: r for r in wn.training_profile(df, start).collect()}
    assert got["a"].Frequency_of_Removals == 7.0 and got["a"].Last_Removal_month == 14
    assert got["b"].Frequency_of_Removals == 1.0
    nb = {r.medid: r for r in wn.training_profile(df, start, single=0.0).collect()}
    assert nb["b"].Frequency_of_Removals == 0.0


def test_overlay_nulls_do_not_overwrite(spark):
    base = spark.createDataFrame([("c", "m", 1, 1.0, 2.0), ("c", "n", 1, 1.0, 2.0)],
                                 "skclientkey string, medid string, device_naturalkey int, a double, b double")
    upd = spark.createDataFrame([("c", "m", 1, None, 9.0)],
                                "skclientkey string, medid string, device_naturalkey int, a double, b double")
    got = {r.medid: (r.a, r.b) for r in ru.overlay(base, upd, cols=["a", "b"]).collect()}
    assert got == {"m": (1.0, 9.0), "n": (1.0, 2.0)}


def test_overlay_duplicate_keys_return_base(spark):
    base = spark.createDataFrame([("c", "m", 1, 1.0)], "skclientkey string, medid string, device_naturalkey int, a double")
    upd = spark.createDataFrame([("c", "m", 1, 5.0), ("c", "m", 1, 6.0)],
                                "skclientkey string, medid string, device_naturalkey int, a double")
    got = [r.a for r in ru.overlay(base, upd, cols=["a"]).collect()]
    assert got == [1.0]


def test_scaler_constant_column(spark):
    from dosecast.params import Params
    p = Params(features=("f",))
    df = spark.createDataFrame([("k", 3.0), ("k", 3.0)], "model_key string, f double")
    got = [r.f_norm for r in wn.apply_scaler(df, wn.scaler(df, p), p).collect()]
    assert got == [0.0, 0.0]
