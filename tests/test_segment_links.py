"""Sparse start-end links against all pairs; the island sweep with a third of all rows on one coordinate."""

import random

from pyspark.sql import functions as F

from dosecast.operators.components import segment_groups
from dosecast.operators.geometry import overlap_islands


def brute(segs, eps):
    """Union-find over all pairs of one island, on (id, start, end)."""
    root = {i: i for i, _, _ in segs}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, s, _ in segs:
        for j, _, e in segs:
            if i != j and abs(s - e) <= eps:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: find(i) for i, _, _ in segs}


def test_sparse_links_give_the_components_of_all_pairs(spark):
    rnd = random.Random(5)
    rows, want = [], {}
    for tile in range(4):
        segs = []
        for k in range(60):
            x = float(rnd.choice([rnd.randrange(150), 40]) if k % 3 else 40)   # equal coordinates, a hot one
            segs.append((tile * 1000 + k, x, x + rnd.choice([0, 1, 5, 30]) + rnd.choice([0.0, 0.5])))
        rows += [(tile, i, s, 7.0, e, 7.0) for i, s, e in segs]
        want.update(brute(segs, 3.0))
    df = spark.createDataFrame(rows, "tile long, id long, x1 double, y1 double, x2 double, y2 double")
    got = {r.id: r.comp for r in segment_groups(df).collect()}
    assert got == want
    turned = df.select("tile", "id", F.col("y1").alias("x1"), F.col("x1").alias("y1"), F.col("y2").alias("x2"),
                       F.col("x2").alias("y2"))
    assert {r.id: r.comp for r in segment_groups(turned, axis="x").collect()} == want


def test_islands_with_a_hot_coordinate(spark):
    rnd = random.Random(6)
    rows = [(1, i, 500.0 if i % 3 == 0 else float(rnd.randrange(2000)), 0.0) for i in range(600)]
    rows = [(t, i, lo, lo + rnd.randrange(4)) for t, i, lo, _ in rows]
    got = {r.id: r.g for r in overlap_islands(
        spark.createDataFrame(rows, "tile long, id long, lo double, hi double"), "lo", "hi", ["tile"], "g").collect()}
    want, top, n = {}, None, 0
    for _, i, lo, hi in sorted(rows, key=lambda r: (r[2], r[3], r[1])):
        if top is None or lo > top:
            n += 1
        top = hi if top is None else max(top, hi)
        want[i] = n
    assert got == want
