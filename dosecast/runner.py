"""The back-test on client folders: extracts in, result tables out.

All clients and windows run together.  Every step is written as a table
partitioned by client (and test month), and counts its rows while it is
written, so an empty step shows up by name without another job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dosecast.operators import panel as pn
from dosecast.operators import windows as wn
from dosecast.operators.audit import with_row_count
from dosecast.operators.backtest import WPAIR, WindowedBackTest, window_last_status
from dosecast.params import DEFAULT, Params
from dosecast.session import ship_package
from dosecast.sources import io


def read_inputs(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The roles of every client folder under ``root``; the name files where the manifests have them."""
    folders = io.client_folders(root)
    named = [set(io.manifest_paths(f"{f}/{io.MANIFEST_NAME}")) for _, f in folders]
    roles = list(io.PIPELINE_ROLES)
    roles += [r for r in ("all_mednames", "all_devicenames") if named and all(r in n for n in named)]
    return {r: io.read_role(spark, root, r, folders) for r in roles}


def run_folders(spark: SparkSession, root: str, out: str, p: Params = DEFAULT, model: str = "LR") -> dict[str, int]:
    """Run the back-test of every client folder and write its tables under ``out``; the rows of each step.

    A step with no rows (P18) is in the result with 0: the tables of the later steps are then empty too.
    """
    ship_package(spark)
    f = read_inputs(spark, root)
    inputs = pn.Inputs.from_frames(f["df_tranx"], f["usage"], f["inv_eed_ssflag"], f["unitcost"], p,
                                   med_names=f.get("all_mednames"), device_names=f.get("all_devicenames"))
    b = WindowedBackTest(inputs, wn.training_months(f["usage"], p.window_months), p, model)
    panel = pn.build_panel(inputs)
    month = (F.col("train_start") + p.window_months).alias("test_month")
    steps = {
        "panel": panel,
        "excluded": pn.excluded_rows(panel, p),
        "unloaded": window_last_status(inputs.snap, b.windows, p).where(F.col("isinactive") == 1),
        "null_inventory": pn.drop_null_inv(pn.tx_panel(inputs))[1],
        "eligible": b.eligible,
        "removals": b.removal_rows,
        "training_results": b.training_results.select("*", month),
        "training_profile": wn.training_profile(b.train, F.col("train_start"), p.single_month_frequency, WPAIR)
                              .select("*", month),
        "results": b.results(True).select("*", month),
        "group_results": b.group_result.select("*", month),
        "final": b.final.select("*", month),
        "errors": b.errors,
        "models": b.models.withColumn("skclientkey", F.split("model_key", r"\|")[2].cast("long")),
        "pair_counts": b.pair_counts,
        "unscored": b.unscored,
    }
    rows = {}
    for name, df in steps.items():
        counted, seen = with_row_count(df, f"rows_{name}")
        io.write_results(counted, f"{out}/{name}")
        rows[name] = seen.get["rows"]
    return rows
