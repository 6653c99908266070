"""Client folders through to the written final table; the sources' errors; the all-window back-test."""

import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import SF
from dosecast.operators import backtest as bk
from dosecast.operators import extract as ex
from dosecast.operators import panel as pn
from dosecast.operators import windows as wn
from dosecast.params import DEFAULT as P
from dosecast.runner import run_folders
from dosecast.sources import fixtures as fx
from dosecast.sources import io
from dosecast.sources.tables import Tables


def write_folders(t, root, clients):
    """The four extracts of each client as CSV, dates of the snapshot as yyyymmdd."""
    snap = fx.snap(t)
    for c in ("lastday_of_month", "earliestnextexpirationdate"):
        snap = snap.withColumn(c, F.date_format(c, "yyyyMMdd"))
    frames = {"df_tranx": (ex.removal_tx(t), "skclientkey"), "usage": (ex.monthly_usage(t), "clientkey"),
              "inv_eed_ssflag": (snap, "skclientkey"),
              "unitcost": (ex.latest_cost(t).withColumnRenamed("skclientkey", "clientkey"), "clientkey")}
    for c in clients:
        folder = os.path.join(root, f"{c:05d}_Site")
        os.makedirs(folder)
        for role, (df, key) in frames.items():
            df.where(F.col(key) == c).toPandas().to_csv(os.path.join(folder, f"{role}.csv"), index=False)
        with open(os.path.join(folder, io.MANIFEST_NAME), "w") as f:
            json.dump({role: f"{role}.csv" for role in frames}, f)


def rows_of(df, cols):
    return sorted(tuple(round(v, 6) if isinstance(v, float) else v for v in r)
                  for r in df.select(*[F.col(c).cast("double") if c != "medid" else c for c in cols]).collect())


def test_client_folders_give_the_results_of_the_fixture(spark):
    t = Tables(spark, SF)
    usage = ex.monthly_usage(t)
    clients = [r.skclientkey for r in wn.training_months(usage).groupBy("skclientkey").count()
               .orderBy(F.col("count").desc(), "skclientkey").limit(2).collect()]
    root, out = tempfile.mkdtemp(prefix="dosecast-in-"), tempfile.mkdtemp(prefix="dosecast-out-")
    write_folders(t, root, clients)
    rows = run_folders(spark, root, out, model="Ridge")
    # Every pair has a snapshot in the fixture.
    assert {k for k, n in rows.items() if not n} == {"null_inventory", "unscored"}
    assert set(rows) >= {"panel", "excluded", "final", "errors", "training_results", "models", "pair_counts", "unloaded"}
    b = bk.WindowedBackTest(pn.Inputs(t, P), wn.training_months(usage), P, "Ridge")
    cols = ["train_start", "skclientkey", "medid", "device_naturalkey", "y_df", "y_removal_group", "MAE_Group_Model"]
    want = rows_of(b.final.where(F.col("skclientkey").isin(clients)), cols)
    final = spark.read.parquet(f"{out}/final")
    assert "test_month" in final.columns and len(want) == rows["final"]
    assert rows_of(final, cols) == want


def test_sources_do_not_skip_silently(spark):
    root = tempfile.mkdtemp(prefix="dosecast-bad-")
    os.makedirs(os.path.join(root, "Site_without_key"))
    with pytest.raises(ValueError, match="Site_without_key"):
        io.client_folders(root)
    assert io.client_folders(root, skip=("Site_without_key",)) == []
    root = tempfile.mkdtemp(prefix="dosecast-bad-")
    os.makedirs(os.path.join(root, "10001_Site"))
    with pytest.raises(Exception, match="STEinputFiles"):
        io.read_role(spark, root, "usage")
    with open(os.path.join(root, "10001_Site", io.MANIFEST_NAME), "w") as f:
        json.dump({"df_tranx": "tx.csv"}, f)
    with pytest.raises(ValueError, match="usage"):
        io.read_role(spark, root, "usage")


def test_read_role_takes_columns_by_name_and_renames(spark):
    root = tempfile.mkdtemp(prefix="dosecast-role-")
    for c in (10001, 10002):
        os.makedirs(os.path.join(root, f"{c}_Site"))
        with open(os.path.join(root, f"{c}_Site", "cost.csv"), "w") as f:
            f.write(f"unitcost,medid,extra,clientkey,hdp_shardid\n1.5,00040,x,{c},3\nbad,00041,y,{c},3\n")
        with open(os.path.join(root, f"{c}_Site", io.MANIFEST_NAME), "w") as f:
            json.dump({"unitcost": "cost.csv"}, f)
    got = sorted(map(tuple, io.read_role(spark, root, "unitcost").collect()), key=str)
    assert got == [(3, c, m, v, c) for c in (10001, 10002) for m, v in (("00040", 1.5), ("00041", None))]


def test_a_client_s_run_keeps_the_other_clients_results(spark):
    out = tempfile.mkdtemp(prefix="dosecast-sink-") + "/res"
    df = spark.range(8).select(F.col("id"), (F.col("id") % 2).alias("skclientkey"), (F.col("id") % 4).alias("test_month"))
    io.write_results(df, out)
    io.write_results(df.where("skclientkey = 1").withColumn("id", F.col("id") + 100), out)
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == [0, 2, 4, 6, 101, 103, 105, 107]


def test_the_panel_holds_every_removal_of_its_keys(spark):
    """No month of the data lies outside the panel."""
    i = pn.Inputs(Tables(spark, SF), P)
    assert i.removals.count() > 0
    assert i.removals.join(pn.build_panel(i), [*pn.KEY5], "left_anti").count() == 0


def test_empty_extracts_give_empty_results(spark):
    t = Tables(spark, SF)
    none = F.lit(False)
    usage = ex.monthly_usage(t).where(none)
    i = pn.Inputs.from_frames(ex.removal_tx(t).where(none), usage, fx.snap(t).where(none),
                              ex.latest_cost(t).where(none), P)
    b = bk.WindowedBackTest(i, wn.training_months(usage), P, "Ridge")
    assert b.final.count() == 0 and b.errors.count() == 0 and b.training_results.count() == 0
