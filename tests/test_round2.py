"""Cases that the fixture tables do not hold."""

import os
import subprocess
import sys

from pyspark.sql import functions as F

from dosecast.operators import components as co
from dosecast.operators import geometry as ge
from dosecast.operators import rules as ru
from dosecast.operators.features import BY_CATEGORY
from dosecast.operators import windows as wn
from dosecast.params import Params
from dosecast.session import materialize, release

from conftest import SF

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_python_workers_find_the_package_from_another_folder(tmp_path):
    code = (f"import sys; sys.path.insert(0, {REPO!r})\n"
            "import __spark_entry__ as e\nfrom dosecast.session import build_session\n"
            "s = build_session('local[2]', 2, driver_memory='2g')\n"
            f"assert e.queries()['ridge_models'](s, {SF!r}).count() > 0\nprint('found')\n")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "found" in out.stdout, out.stderr[-2000:]


def test_a_long_path_is_one_component(spark):
    nodes = spark.range(1000).select(F.lit(1).alias("tile"), F.col("id").alias("node"))
    edges = spark.range(999).select(F.lit(1).alias("tile"), F.col("id").alias("src"), (F.col("id") + 1).alias("dst"))
    assert [r.label for r in co.connected_components(nodes, edges).select("label").distinct().collect()] == [0]


def test_reversed_segments_cross(spark):
    h = spark.createDataFrame([(1, 7, 0.0, 40.0, 10.0), (1, 8, 40.0, 0.0, 12.0)], "tile long, id long, x1 double, x2 double, y double")
    v = spark.createDataFrame([(1, 1, 20.0, 5.0, 30.0), (1, 2, 21.0, 30.0, 5.0)], "tile long, id long, x double, y1 double, y2 double")
    assert sorted((r.v_id, r.h_id) for r in ge.crossings(v, h).collect()) == [(1, 7), (1, 8), (2, 7), (2, 8)]


def test_a_duplicate_voids_its_own_client_only(spark):
    cols = "skclientkey long, medid string, device_naturalkey long, y double"
    base = spark.createDataFrame([(1, "a", 1, 0.0), (1, "b", 1, 0.0), (2, "a", 1, 0.0)], cols)
    upd = spark.createDataFrame([(1, "a", 1, 5.0), (1, "a", 1, 6.0), (1, "b", 1, 7.0), (2, "a", 1, 8.0)], cols)
    got = {(r.skclientkey, r.medid): r.y for r in ru.overlay(base, upd, cols=["y"]).collect()}
    assert got == {(1, "a"): 0.0, (1, "b"): 0.0, (2, "a"): 8.0}
    assert [(r.skclientkey, r.n) for r in ru.duplicated_keys(upd).collect()] == [(1, 2)]


def test_dollars_take_the_shards_own_cost(spark):
    res = spark.createDataFrame([(s, 1, "a", s, 2.0, 1.0, 3.0) for s in (1, 2)],
                                "hdp_shardid long, skclientkey long, medid string, device_naturalkey long, "
                                "modified_y_predict_less_cons double, dashboard_estimate double, y_df double")
    cost = spark.createDataFrame([(1, 1, "a", 10.0), (2, 1, "a", 20.0)], "hdp_shardid long, skclientkey long, medid string, unitcost double")
    assert {r.device_naturalkey: r.estimate_value for r in ru.dollar_values(res, cost).collect()} == {1: 20.0, 2: 40.0}


def test_one_hot_has_fixed_levels_and_debug_pairs_are_few(spark):
    df = spark.createDataFrame([(1, "a", 1, 1, 0), (1, "b", 1, 0, 1)],
                               "skclientkey long, medid string, device_naturalkey long, dist_eed_120 int, "
                               "standardstockwithindispensingdeviceflag int")
    r = BY_CATEGORY.add(df).orderBy("medid").collect()
    assert (r[0].dist_eed_120_1, r[0].dist_eed_120_2, r[1].standardstockwithindispensingdeviceflag_1) == (1.0, 0.0, 1.0)
    assert [x.medid for x in wn.debug_pairs(df, 1).collect()] == ["a"]


def test_one_model_for_each_pair(spark):
    pairs = spark.createDataFrame([(1, 1, "a", 1, 2), (1, 1, "b", 1, 9)],
                                  "hdp_shardid long, skclientkey long, medid string, device_naturalkey long, count long")
    keys = [r.model_key for r in wn.model_assignment(pairs, Params(), grouped=False).collect()]
    assert len(set(keys)) == 2


def test_release_deletes_what_was_materialized(spark):
    df = materialize(spark.range(3).toDF("x"), "gone")
    path = df.inputFiles()[0].removeprefix("file://")
    assert df.count() == 3 and os.path.exists(path)
    assert release(spark) >= 1 and not os.path.exists(path)
