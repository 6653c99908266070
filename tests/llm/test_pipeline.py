"""The pipeline's stages, each against what its own input asks for; the queries' SQL."""

import re

import duckdb

import __spark_entry__ as entry
import corpus_pipeline
from dosecast.llm import decontaminate, oracle, quality, simhash

SF = "/root/testdata/sf0.001"
TABLES = ("documents", "benchmark", "conversations")


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    seen = [docs]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, seen[-1], SF).cache()
        if i < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == docs.columns
        seen.append(out)
    ids = [[r["doc_id"] for r in s.collect()] for s in seen]
    good = {r["doc_id"] for r in quality.quality(seen[0]).where("kept").collect()}
    assert sorted(ids[1]) == sorted(good) and len(good) > 0.7 * len(ids[0])
    assert sorted(ids[2]) == sorted({r["component_id"] for r in simhash.near_duplicates(seen[1]).collect()})
    assert sorted(ids[3]) == sorted(ids[2])
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    assert decontaminate.matches(seen[2], bench).where("n_hit > 0").count() > 0
    words = lambda df: sum(len(re.findall(r"[^\x20\x09-\x0D]+", r["text"])) for r in df.collect())
    assert abs(words(seen[4]) - 1.5 * words(seen[3])) < 0.01 * words(seen[3])
    assert sorted(ids[5]) == sorted(ids[4])


def test_sql_gives_the_same_rows(spark):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    norm = lambda v: round(v, 6) if isinstance(v, float) else v
    order = lambda row: [(v is not None, v) for v in row]  # noqa: E731  (op12's form and form_n may be null)
    for name, sql in oracle.SQL.items():
        df = entry.queries()[name](spark, SF)
        cols = sorted(df.columns)
        got = sorted((tuple(norm(r[c]) for c in cols) for r in df.collect()), key=order)
        rel = con.sql(sql)
        assert sorted(rel.columns) == cols
        want = sorted((tuple(norm(v) for v in r) for r in con.sql(f"select {', '.join(cols)} from ({sql})").fetchall()), key=order)
        assert got == want, name
