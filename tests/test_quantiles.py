"""Exact quantiles by interval refinement."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from dosecast.operators import report as rp
from dosecast.operators.quantiles import quantiles

PROBS = {"p0": 0.0, "q1": 0.25, "q2": 0.5, "p9": 0.9, "p1": 1.0}


def check(df, pdf, bins=1024):
    got = {r.g: r for r in quantiles(df, ["g"], "value", PROBS, bins).collect()}
    want = {None if g != g else g: v.dropna() for g, v in pdf.groupby("g", dropna=False)["value"]}
    assert set(got) == {g for g, v in want.items() if len(v)}
    for g, v in want.items():
        if len(v):
            assert [got[g][c] for c in PROBS] == pytest.approx([np.quantile(v, p) for p in PROBS.values()], rel=1e-12, abs=1e-12)


@pytest.mark.parametrize("bins", [16, 1024])
def test_equals_numpy_on_hard_groups(spark, bins):
    rng = np.random.default_rng(1)
    groups = {"one": [3.0], "two": [1.0, 2.0], "ties": rng.integers(0, 4, 300).astype(float), "same": [5.0] * 40,
              "skew": 10.0 ** rng.uniform(-30, 30, 200), "both": np.concatenate([-(10.0 ** rng.uniform(-5, 5, 99)), [0.0, -0.0, 1e308, -1e308]]),
              None: rng.normal(size=50), "empty": [np.nan]}
    pdf = pd.concat([pd.DataFrame({"g": [g] * len(v), "value": v}) for g, v in groups.items()])
    df = spark.createDataFrame([(g, None if v != v else float(v)) for g, v in pdf.itertuples(index=False)], "g string, value double").repartition(5)
    check(df, pdf.assign(value=pdf["value"]), bins)


def test_a_group_of_a_million_distinct_values(spark):
    """No gathering of a group: its million values go through bins."""
    df = spark.range(1_000_000).select(F.when(F.col("id") % 100 == 0, "small").otherwise("large").alias("g"),
                                       (F.pow(F.col("id") * 7919 % 1_000_003, F.lit(1.5)) / 3).alias("value"))
    check(df, df.toPandas())


def test_describe_and_box(spark):
    rng = np.random.default_rng(2)
    pdf = pd.DataFrame({"g": rng.integers(0, 3, 400), "value": np.round(rng.exponential(3, 400), 1)})
    df = spark.createDataFrame(pdf)
    d = {r.g: r for r in rp.describe(df, ["g"]).collect()}
    b = {r.g: r for r in rp.box_stats(df, ["g"]).collect()}
    for g, v in pdf.groupby("g")["value"]:
        want = v.describe()
        assert [d[g][c] for c in ("count", "mean", "std", "min", "q25", "q50", "q75", "max")] == pytest.approx(list(want))
        lo, hi = want["25%"] - 1.5 * (want["75%"] - want["25%"]), want["75%"] + 1.5 * (want["75%"] - want["25%"])
        inside = v[(v >= lo) & (v <= hi)]
        assert [b[g][c] for c in ("q1", "median", "q3", "mean", "whisker_lo", "whisker_hi", "n_outliers")] == pytest.approx(
            [want["25%"], want["50%"], want["75%"], v.mean(), inside.min(), inside.max(), len(v) - len(inside)])
