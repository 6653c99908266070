"""Steps over all windows that go through their rows once: last status, test rows, errors, and the tables by pair."""

import glob
import random

import pyarrow.parquet as pq

from dosecast.operators import backtest as bk
from dosecast.operators.extract import PAIR
from dosecast.plans import q_reports
from dosecast.session import _WRITTEN, materialize_by

PAIRS = [(s, c, m, d) for s, c in ((0, 1), (1, 2)) for m in ("Brand#1", "Brand#2") for d in (3, 4)]
KEYS = "hdp_shardid long, skclientkey long, medid string, device_naturalkey long"
ORDER = ["hdp_shardid", "skclientkey", "medid", "device_naturalkey", "train_start"]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def windows_of(spark):
    return spark.createDataFrame([(c, t) for c, n in ((1, 30), (2, 9)) for t in range(100, 100 + n)] + [(1, 100)], "skclientkey long, train_start int")


def test_last_status_of_every_window(spark):
    """Gaps of up to two windows, repeated rows, null flags; a row goes into the windows that it is the last one of."""
    rnd = random.Random(1)
    rows = [(*p, m, rnd.choice([0, 1, 2, None])) for p in PAIRS for m in sorted(rnd.sample(range(95, 150), 9))]
    rows += rows[::4] + [(*PAIRS[0], None, 1)]
    starts = {1: range(100, 130), 2: range(100, 109)}
    want = {}
    for s, c, m, d, month, flag in rows:
        for t in starts[c]:
            if month is not None and t <= month < t + 12 and month >= want.get((s, c, m, d, t), (0,))[0]:
                want[s, c, m, d, t] = month, flag
    last = bk.window_last_status(spark.createDataFrame(rows, KEYS + ", month int, isinactive int"), windows_of(spark))
    got = [(tuple(r[k] for k in ORDER), (r.last_month, r.isinactive)) for r in last.collect()]
    assert dict(got) == want and len(got) == len(want)
    assert "max_by" not in plan_of(last)                     # no row for each window that holds it, to be put together again


def test_test_rows_in_one_pass(spark):
    """A removal row wins over snapshots, repeated rows multiply as in the joins, pairs with neither row are left out."""
    rnd = random.Random(2)
    p = bk.DEFAULT
    feats = [f for f in p.features if f != "usage100"]
    cols = "".join(f", {f} double" for f in feats)
    row = lambda *key: (*key, *[rnd.choice([None, float(rnd.randrange(9))]) for _ in feats])
    months = range(112, 116)
    snap = [row(*k, m) for k in PAIRS for m in months if rnd.random() < 0.7]
    rem = [(*row(*k, m), rnd.randrange(5), float(rnd.randrange(1, 9))) for k in PAIRS for m in months if rnd.random() < 0.4]
    usage = [(*k, m, rnd.choice([None, 7, 8])) for k in PAIRS for m in months if rnd.random() < 0.5]
    snap, rem, usage = snap + snap[::3], rem + rem[::3], usage + usage[::5]
    assign = [(*k, t, f"m{t}", 3) for k in PAIRS for t in range(100, 105)]
    df = bk.window_test_features(
        spark.createDataFrame(rem, KEYS + ", month int" + cols + ", usage100 long, transactionquantity double"),
        spark.createDataFrame(snap, KEYS + ", month int" + cols), spark.createDataFrame(usage, KEYS + ", month int, usage100 long"),
        spark.createDataFrame(assign, KEYS + ", train_start int, model_key string, months_w_removals long"), p)
    want = []
    for a in assign:
        key = (*a[:4], a[4] + 12)
        removals = [r for r in rem if r[:5] == key]
        for r in removals:
            want.append((a[:5], dict(zip([*feats, "usage100"], [*r[5:-2], float(r[-2])])), r[-1], "removal"))
        for s in [] if removals else [s for s in snap if s[:5] == key]:
            for u in [u[-1] for u in usage if u[:5] == key] or [None]:
                want.append((a[:5], dict(zip([*feats, "usage100"], [*s[5:], float(u or 0)])), 0.0, "snapshot"))
    got = [(tuple(r[k] for k in ORDER), {f: r[f] for f in [*feats, "usage100"]}, r.y, r.source) for r in df.collect()]
    show = lambda x: (x[0], sorted(x[1].items()), x[2], x[3])
    assert sorted(map(str, map(show, got))) == sorted(map(str, map(show, want))) and len({x[-1] for x in want}) == 2
    assert "Union" not in plan_of(df)                        # the pairs are gone through once, not once for each source


def test_errors_are_written_once(spark):
    """Passes over the errors read what is written, not the results' joins."""
    class Results:
        def results(self, pair_cap):
            one = spark.createDataFrame([(100, 1, 3, 1.0, None), (101, 1, 4, 2.0, 5.0)],
                                        "train_start int, skclientkey long, months_w_removals long, MAE_Dashboard double, MAE_Estimator_Model double")
            return one.join(one.hint("merge"), one.columns[:3], "left_semi")

    df = q_reports.long_errors(Results())
    assert "Join" not in plan_of(df)
    assert sorted((r.train_start, r.metric, r.value) for r in df.where("value is not null").collect()) == [
        (100, "MAE_Dashboard", 1.0), (101, "MAE_Dashboard", 2.0), (101, "MAE_Estimator_Model", 5.0)]


def test_tables_by_pair_are_sorted_by_the_device_first(spark):
    """Within each bucket, whose hash the sort does not compare."""
    rnd = random.Random(3)
    rows = [(rnd.randrange(3), f"Brand#{rnd.randrange(9)}", rnd.randrange(40)) for _ in range(500)]
    df = materialize_by(spark.createDataFrame(rows, "skclientkey long, medid string, device_naturalkey long"), PAIR, "rows", 3)
    assert PAIR[0] == "device_naturalkey" and "Exchange" not in plan_of(df.groupBy(*PAIR).count())
    assert sorted((r.skclientkey, r.medid, r.device_naturalkey) for r in df.collect()) == sorted(rows)
    files = glob.glob(_WRITTEN[spark.sparkContext.applicationId][-1] + "/*.parquet")
    assert len(files) == 3
    for f in files:
        own = [(r["device_naturalkey"], r["medid"], r["skclientkey"]) for r in pq.read_table(f).to_pylist()]
        assert own == sorted(own)
