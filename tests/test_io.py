"""Sources and sinks: manifest, client folders, partitioned sinks, row-count observation."""

import json
import os
import tempfile

from pyspark.sql import functions as F

from dosecast.operators.audit import with_row_count
from dosecast.sources import io


def test_manifest_and_client_folders(spark):
    root = tempfile.mkdtemp(prefix="dosecast-io-")
    for name in ("10001_Site_A", "10002_Site_B", "all_data"):
        os.makedirs(os.path.join(root, name))
    man = os.path.join(root, "10001_Site_A", io.MANIFEST_NAME)
    with open(man, "w") as f:
        json.dump({"df_tranx": "tx.csv", "usage": "u.csv"}, f)
    assert [k for k, _ in io.client_folders(root)] == [10001, 10002]
    paths = io.manifest_paths(man)
    assert paths["df_tranx"].endswith("10001_Site_A/tx.csv")
    assert io.read_manifest(spark, man).first().df_tranx == "tx.csv"


def test_partitioned_sink_and_observe(spark):
    out = tempfile.mkdtemp(prefix="dosecast-sink-")
    df = spark.range(10).withColumn("skclientkey", F.col("id") % 3)
    obs_df, obs = with_row_count(df, "rows_check")
    io.write_results(obs_df, os.path.join(out, "res"))
    assert obs.get["rows"] == 10
    back = spark.read.parquet(os.path.join(out, "res"))
    assert back.count() == 10 and "skclientkey" in back.columns


def test_save_table_overwrites_and_written_panels(spark):
    base = tempfile.mkdtemp(prefix="dosecast-ctas-")
    io.save_table(spark.range(5), "ctas_probe", os.path.join(base, "t"))
    io.save_table(spark.range(3), "ctas_probe", os.path.join(base, "t"))      # drop-if-exists semantics
    assert spark.table("ctas_probe").count() == 3
    for ck in (10001, 10002):
        d = os.path.join(base, "panels")
        os.makedirs(d, exist_ok=True)
        with open(os.path.join(d, f"df_all_{ck}_before_exclusion.csv"), "w") as f:
            f.write("medid,month\n00040,3\n00041,4\n")
    df = io.read_written_panels(spark, os.path.join(base, "panels", "*.csv"), "medid string, month int")
    got = sorted((r.file_client, r.medid) for r in df.collect())
    assert got[0] == (10001, "00040") and len(got) == 4      # leading zeros kept: fixed schema, no inference
