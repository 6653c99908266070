"""Co-partitioned extracts, shared by the queries over a folder; the audit in one pass."""

import re

import pytest
from pyspark.sql import functions as F

from dosecast import session
from dosecast.operators import audit as au
from dosecast.operators import backtest as bk
from dosecast.operators import extract as ex
from dosecast.operators import panel as pn
from dosecast.operators import windows as wn
from dosecast.params import DEFAULT as P
from dosecast.plans.q_model import every_window
from dosecast.plans.q_windows import stand_in
from dosecast.session import SHARED, release
from dosecast.sources.tables import Tables

from conftest import SF


def plan_of(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


@pytest.fixture
def no_broadcast(spark):
    """The tables of the tests are small enough for broadcasts, which would hide the shuffles."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_usage_snapshots_and_removals_join_without_a_shuffle(spark, no_broadcast):
    i = pn.Inputs(Tables(spark, SF), P)
    plan = plan_of(pn.pair_months(i))
    assert plan.count("Bucketed: true") == 3 and plan.count("SortMergeJoin") == 2 and "Exchange" not in plan


def test_tables_by_pair_have_partitions_by_their_rows(spark, no_broadcast, monkeypatch):
    """With a set number of partitions what a task sorts grew with the input, until it was spilled."""
    plain = pn.Inputs(Tables(spark, SF), P)
    want, rows = plain.eligible, plain.snap.count()
    assert plain.partitions == int(spark.conf.get("spark.sql.shuffle.partitions"))
    monkeypatch.setattr(session, "ROWS_PER_PARTITION", rows // 20)
    i = pn.Inputs(Tables(spark, SF), P)
    got = pn.pair_months(i)
    assert i.partitions >= 20 and plan_of(got).count(f"SelectedBucketsCount: {i.partitions} out of {i.partitions}") == 3 and "Exchange" not in plan_of(got)
    assert i.eligible.exceptAll(want).count() == 0 and want.exceptAll(i.eligible).count() == 0 and want.count() > 0
    for df in (i.eligible, bk.WindowedBackTest(i, predictions="stand_in").train):
        assert f"{i.partitions} out of {i.partitions}" in plan_of(df.groupBy(*ex.PAIR).count()) and not df.isEmpty()
    assert session.partitions_for(spark, 10**6) == -(-(10**6) // (rows // 20)) and session.partitions_for(spark, 0) == plain.partitions


def test_panel_is_the_same_as_without_buckets(spark):
    panel = pn.build_panel(pn.Inputs(Tables(spark, SF), P))
    lazy = pn.build_panel(pn.Inputs(Tables(spark, SF), P, materialize=False))
    assert lazy.exceptAll(panel).count() == 0 and panel.exceptAll(lazy).count() == 0


def test_what_follows_by_pair_needs_no_shuffle(spark, no_broadcast):
    i = pn.Inputs(Tables(spark, SF), P)
    rows = pn.removal_panel(i.eligible)
    pairs = wn.training_pairs(rows, P.train_start, P.window_months)
    train = wn.training_rows(rows, wn.model_assignment(pairs, P), P.train_start, P.window_months, P)
    for df in (pairs, pn.add_dist_eed(i.snap.drop("dist_eed")), i.eligible.groupBy(*pn.KEY5).agg(F.count(F.lit(1)).alias("n")), train,
               wn.training_profile(train, P.train_start)):
        assert "Exchange" not in plan_of(df)


def test_queries_over_a_folder_share_extracts_until_release(spark):
    a, b = (pn.Inputs.shared(Tables(spark, SF), P) for _ in range(2))
    assert a is b and not a._built
    assert a.usage is b.usage and list(a._built) == ["usage"]       # what is not read is not built
    table = re.search(r"dosecast_usage_\w+", a.usage._jdf.queryExecution().analyzed().toString()).group()
    assert spark.catalog.tableExists(table)
    release(spark)
    assert not SHARED and not spark.catalog.tableExists(table)
    assert pn.Inputs.shared(Tables(spark, SF), P) is not a
    release(spark)


def test_join_audit_counts_every_join(spark):
    left = spark.createDataFrame([(1, 1), (1, 2), (2, 1), (None, 1), (4, None)], "k int, m int").withColumn("x", F.lit(1))
    right = spark.createDataFrame([(1, 1), (1, 1), (3, 1), (None, 1)], "k int, m int").withColumn("y", F.lit(1))
    for keys in (["k"], ["k", "m"]):
        got = au.join_audit(left, right, keys).first()
        for how, name in (("inner", "both_sides"), ("left", "left_join_rows"), ("right", "right_join_rows"), ("outer", "outer_join_rows")):
            assert got[name] == left.select(*keys, "x").join(right.select(*keys, "y"), keys, how).count(), (keys, how)
        assert (got.left_rows, got.right_rows, got.cross_join_rows) == (5, 4, 20) and not got.row_rule_ok
    plan = au.join_audit(left, right, ["k"])._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "Join" not in plan
    assert au.join_audit(left, right, ["k"], "cross").first().row_rule_ok
    empty = au.join_audit(left.limit(0), right, ["k"]).first()
    assert (empty.both_sides, empty.right_only, empty.left_rows) == (0, 4, 0)


def test_removals_only_queries_build_no_other_extract(spark):
    release(spark)
    i = pn.Inputs.shared(Tables(spark, SF), P)
    assert i.removals.count() == ex.monthly_removals(ex.removal_tx(Tables(spark, SF)), P).count()
    assert list(i._built) == ["rtx"]
    release(spark)


def test_windows_are_read_from_the_usage_extract(spark):
    """They were derived from the transactions anew in every step over all windows, with the broadcasts of it."""
    release(spark)
    t = Tables(spark, SF)
    for b in (stand_in(t), every_window(t)):
        files = b.windows.inputFiles()
        assert files and all("/windows-" in f for f in files)
    want = wn.training_months(ex.monthly_usage(t), P.window_months)
    assert sorted(b.windows.collect()) == sorted(want.collect()) and b.windows.count() > 0
    usage = spark.createDataFrame([(1, m, "d") for m in (202001, 202002, 202002, None, *range(202101, 202113))] + [(None, 202101, "d")],
                                  "clientkey long, year_month int, devicename string")
    months = pn.usage_features(usage.selectExpr("*", "1L hdp_shardid", "'m' medid", "1L device_naturalkey", "1.0D avgdailyusage30"))
    got = wn.test_months(months.select("skclientkey", (F.col("month") - 1).alias("mi")), 12)
    assert sorted(got.collect()) == sorted(wn.training_months(usage, 12).collect()) and got.count() == 2
    release(spark)
