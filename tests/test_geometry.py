"""Grid-cell joins against brute force; edge cases of FIXTURES section 3 item 8."""

import itertools
import random

from dosecast.operators import components as cc
from dosecast.operators import geometry as ge


def test_crossings_match_brute_force(spark):
    rnd = random.Random(7)
    v = [(t, i, float(rnd.randint(0, 60)), float(a), float(a + rnd.randint(0, 40)))
         for i in range(120) for t in [rnd.randint(0, 2)] for a in [rnd.randint(0, 60)]]
    h = [(t, 1000 + i, float(a), float(a + rnd.randint(0, 50)), float(rnd.randint(0, 80)))
         for i in range(150) for t in [rnd.randint(0, 2)] for a in [rnd.randint(0, 60)]]
    vd = spark.createDataFrame(v, "tile int, id int, x double, y1 double, y2 double")
    hd = spark.createDataFrame(h, "tile int, id int, x1 double, x2 double, y double")
    got = sorted((r.v_id, r.h_id) for r in ge.crossings(vd, hd, cell=7.0).collect())
    want = sorted((a[1], b[1]) for a, b in itertools.product(v, h)
                  if a[0] == b[0] and b[2] <= a[2] <= b[3] and a[3] <= b[4] <= a[4])
    assert got == want


def test_intersections_parallel_and_touching(spark):
    a = spark.createDataFrame([(0, 1, 0.0, 0.0, 10.0, 0.0), (0, 2, 0.0, 5.0, 10.0, 5.0)],
                              "tile int, id int, x1 double, y1 double, x2 double, y2 double")
    b = spark.createDataFrame([(0, 9, 10.0, 0.0, 10.0, 8.0),      # touches segment 1 at its end
                               (0, 8, 0.0, 0.0, 10.0, 0.0)],      # parallel (collinear) with 1: skipped
                              "tile int, id int, x1 double, y1 double, x2 double, y2 double")
    got = sorted((r.id, r.px, r.py) for r in ge.segment_intersections(a, b, cell=3.0).collect())
    assert got == [(1, 10.0, 0.0), (2, 10.0, 5.0)]


def test_snap_radius_is_strict(spark):
    pts = spark.createDataFrame([(0, 1, 0.0, 0.0), (0, 2, 20.0, 20.0)], "tile int, id int, x double, y double")
    tg = spark.createDataFrame([(0, 4.0, 0.0), (0, 21.0, 21.0), (0, 22.0, 20.0)], "tile int, x double, y double")
    got = {r.id: (r.adj_x, r.adj_y, r.matched) for r in ge.snap_points(pts, tg).collect()}
    assert got[1] == (0.0, 0.0, False)          # distance exactly 4 is not within the radius
    assert got[2] == (21.0, 21.0, True)         # nearest of two candidates


def test_gap_islands_eps_boundary(spark):
    df = spark.createDataFrame([(0, 1, 0.0), (0, 2, 2.0), (0, 3, 5.0), (0, 4, 8.0)], "tile int, id int, pc double")
    got = {r.id: r.pgroup for r in ge.gap_islands(df, "pc", 2.0).collect()}
    assert got == {1: 1, 2: 1, 3: 2, 4: 3}      # gap exactly eps joins, eps + 1 splits


def test_components_shapes(spark):
    ring = [(0, r, c) for r in range(3) for c in range(3) if (r, c) != (1, 1)]
    diag = [(1, 0, 0), (1, 1, 1), (1, 2, 2)]          # 8-connected -> one component
    single = [(2, 5, 5)]
    two = [(3, 0, 0), (3, 0, 2)]                       # not touching -> two components
    m = spark.createDataFrame(ring + diag + single + two, "tile long, r int, c int")
    comp = cc.pixel_components(m)
    n = {r.tile: r.n for r in comp.groupBy("tile").agg({"label": "approx_count_distinct"})
         .withColumnRenamed("approx_count_distinct(label)", "n").collect()}
    assert n == {0: 1, 1: 1, 2: 1, 3: 2}


def test_sweep_in_stretches_equals_plain_sweep(spark):
    rnd = random.Random(11)
    rows = []
    for t in range(3):
        for i in range(200):
            lo = float(rnd.randint(0, 400))
            rows.append((t, t * 1000 + i, lo, lo + rnd.choice([0, 1, 2, 5, 30])))
    df = spark.createDataFrame(rows, "tile int, id int, lo double, hi double")
    got = {r.id: r.g for r in ge.sweep_islands(df, "lo", "hi", ["tile"], "g").collect()}
    want = {}
    for t in range(3):
        cur, mx = 0, None
        for _, i, lo, hi in sorted((r for r in rows if r[0] == t), key=lambda r: (r[2], r[3], r[1])):
            if mx is None or lo > mx:
                cur += 1
            mx = hi if mx is None else max(mx, hi)
            want[i] = cur
    assert got == want


def test_connected_components_random_graphs(spark):
    rnd = random.Random(5)
    nodes, edges = [], []
    for tile in range(4):
        ids = list(range(tile * 1000, tile * 1000 + 120))
        rnd.shuffle(ids)
        nodes += [(tile, i) for i in ids]
        # a long path with shuffled ids (large diameter) plus random extra edges
        edges += [(tile, ids[k], ids[k + 1]) for k in range(0, 59)]
        edges += [(tile, rnd.choice(ids[60:]), rnd.choice(ids[60:])) for _ in range(40)]
    nd = spark.createDataFrame(nodes, "tile long, node long")
    ed = spark.createDataFrame(edges, "tile long, src long, dst long")
    got = {(r.tile, r.node): r.label for r in cc.connected_components(nd, ed).collect()}
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for t, a, b in edges:
        ra, rb = find((t, a)), find((t, b))
        if ra != rb:
            parent[max(ra, rb)] = min(ra, rb)
    want = {n: find(n)[1] for n in nodes}
    assert got == want
