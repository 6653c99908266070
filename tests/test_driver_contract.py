"""entry(), queries() and a fast subset of the oracle gate at sf0.001."""

import duckdb

import __spark_entry__ as E
from dosecast.sources.tables import TABLE_NAMES

from conftest import SF

FAST = ["removal_tx", "monthly_removals", "monthly_usage", "latest_cost", "panel", "eligible_panel",
        "training_pairs", "model_assignment", "crossings", "snap_points", "scalar_suite", "tile_threshold"]


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "transactionquantity" in df.columns


def test_every_oracle_key_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


def _canon(pdf):
    pdf = pdf[sorted(pdf.columns)]
    out = []
    for row in pdf.itertuples(index=False):
        out.append(tuple("∅" if v is None or (isinstance(v, float) and v != v)
                         else repr(round(float(v), 6)) if isinstance(v, float) else str(v) for v in row))
    return sorted(out)


def test_fast_oracle_subset(spark):
    con = duckdb.connect()
    for t in TABLE_NAMES:
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    qs, ors = E.queries(), E.oracle_sql()
    for name in FAST:
        s = qs[name](spark, SF).toPandas()
        o = con.execute(ors[name]).df()
        assert sorted(s.columns) == sorted(o.columns), name
        assert _canon(s) == _canon(o), name
