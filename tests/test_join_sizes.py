"""Plans: tables of many rows are not broadcast, whatever their files' size, and rows are not multiplied before a shuffle."""

from pyspark.sql import functions as F

from conftest import SF
from dosecast import session
from dosecast.operators import components as cc
from dosecast.operators import extract as ex
from dosecast.operators import geometry as ge
from dosecast.operators import panel as pn
from dosecast.operators import windows as wn
from dosecast.operators.extract import PAIR
from dosecast.plans import q_geometry as qg
from dosecast.session import materialize, materialize_by, small_or_large
from dosecast.sources import fixtures as fx
from dosecast.sources.tables import Tables


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _segments(spark):
    return spark.createDataFrame([(1, i, float(i), float(i + 5), float(i % 7), float(i % 7)) for i in range(40)],
                                 "tile long, id long, x1 double, x2 double, y1 double, y2 double")


def test_islands_and_components_are_not_broadcast(spark):
    seg = materialize(_segments(spark), "segments")
    px = materialize(spark.createDataFrame([(t, r, c) for t in range(3) for r in range(4) for c in range(4) if r != 2],
                                           "tile long, r int, c int"), "mask")
    comp = cc.pixel_components(px)
    assert {(r["tile"], r["label"]) for r in comp.collect()} == {(t, n) for t in range(3) for n in (0, 24)}
    for df in (ge.gap_islands(seg, "y1"), ge.overlap_islands(seg, "x1", "x2", ["tile"]), comp, cc.pixel_edges(px),
               cc.blob_centres(comp), cc.segment_groups(seg)):
        assert "BroadcastHashJoin" not in _plan(df)


def test_geometry_joins_are_not_broadcast_and_cells_come_after_the_shuffle(spark):
    h = _segments(spark).withColumn("y", F.col("y1"))
    v = spark.createDataFrame([(1, 100 + i, float(i), 0.0, 6.0) for i in range(20)], "tile long, id long, x double, y1 double, y2 double")
    pts = spark.createDataFrame([(1, i, float(i) + 0.25, float(i % 7)) for i in range(20)], "tile long, id long, x double, y double")
    lines = v.withColumns({"x1": F.col("x"), "x2": F.col("x")})
    h, v, pts, lines = (materialize(d, "geometry") for d in (h, v, pts, lines))
    for df in (ge.crossings(v, h), ge.snap_points(pts, v.select("tile", "x", F.col("y1").alias("y"))),
               ge.extend_to_perpendicular(h, lines, vertical=False), ge.split_at_points(h, pts, vertical=False),
               ge.split_at_points(lines, pts, vertical=True)):
        assert "BroadcastHashJoin" not in _plan(df)
    right = _plan(ge.crossings(v, h)).split("Exchange")
    assert any("Generate" in part and "cx" in part for part in right[:-1])      # h's cells, above its shuffle
    sent = [line for line in _plan(ge.crossings(v, h)).splitlines() if "Exchange hashpartitioning" in line]
    assert sent and all("cx" not in line for line in sent)


def test_cells_are_dealt_into_partitions_by_the_rows(spark, monkeypatch):
    """with a set number of partitions a task's sort of segments in their cells grew with the input, until it was spilled."""
    t = Tables(spark, SF)
    want = qg.q_crossings(t)
    rows = t.lineitem.count() + t.orders.count() + t.events.count()
    monkeypatch.setattr(session, "ROWS_PER_PARTITION", rows // 30)
    n = session.partitions_for(spark, rows)
    got = qg.q_crossings(t)
    assert n >= 30 and _plan(got).count(f", {n}), REPARTITION_BY_NUM") == 2
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0 and want.count() > 0
    assert f", {n}), REPARTITION_BY_NUM" in _plan(qg.q_snap(t))


def test_windows_are_broadcast_and_rows_are_counted_in_place(spark):
    rows = spark.createDataFrame([(1, 1, "m", d, 100 + m, *[1.0] * 9) for d in range(3) for m in range(6)],
                                 "hdp_shardid long, skclientkey long, medid string, device_naturalkey long, month int, transactionquantity double, "
                                 "usage100 double, inventoryquantity double, dist_eed double, standardstockwithindispensingdeviceflag double, "
                                 "max_par_level double, min_par_level double, dist_eed_120 double, dist_eed_90 double")
    rows = materialize_by(rows, PAIR, "rows")
    windows = materialize(spark.createDataFrame([(1, 95), (1, 102)], "skclientkey long, train_start int"), "windows")
    pairs = wn.all_window_pairs(rows, windows)
    train = wn.all_window_training(rows, windows)
    for df in (pairs, train):
        assert _plan(df).count("BroadcastHashJoin") == 1 and "SortMergeJoin" not in _plan(df)
        assert _plan(df).count("Exchange hashpartitioning") == 1        # of the windows only
    assert pairs.where("train_start = 102").count() == 3 and train.count() == 3 * 6 + 3 * 4


def test_snapshots_are_dealt_before_their_months(spark):
    snap = pn.snap_features(fx.snap(Tables(spark, SF)))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    lines = [x for x in _plan(snap.repartition(n, *PAIR)).splitlines() if "Generate" in x or "Exchange hashpartitioning" in x]
    assert "Generate" in lines[0]


def test_names_are_joined_by_their_count(spark):
    names = spark.createDataFrame([(i, str(i)) for i in range(5)], "id long, name string")
    rows = spark.range(100)
    assert "BroadcastHashJoin" in _plan(rows.join(small_or_large(names), "id", "left"))
    big = rows.join(small_or_large(names, most=4), "id", "left")
    assert "SortMergeJoin" in _plan(big) and big.where("name is not null").count() == 5


def test_transactions_are_not_shuffled_for_devices_and_meds(spark):
    """The dimensions are joined by their count, whatever the broadcast threshold."""
    t = Tables(spark, SF)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for df, keys in ((ex.removal_tx(t), ["dispensingdevicerootkey"]), (ex.usage_enriched(t), ["devicekey", "medkey"])):
            sent = [x for x in _plan(df).splitlines() if "Exchange hashpartitioning" in x]
            assert sent and not any(k in x.split("hashpartitioning", 1)[1] for x in sent for k in keys)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
