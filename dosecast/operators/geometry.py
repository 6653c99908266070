"""Segment-table operators: classify, group, merge, extend, cross, split, snap.

Everything is partitioned by ``tile``.  Range and nearest-neighbour joins
are equi-joins on (tile, grid cell) followed by an exact re-check, so no
operator forms all pairs of a tile: a pair of segments can only meet in the
cells both cover, and each pair is emitted from exactly one cell.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dosecast.operators import scan
from dosecast.session import deal, large

# Fixed values of the reference's geometry routines.
EPS_PRIMARY = 2.0       # DBSCAN eps / KD radius on the primary axis
EPS_SECONDARY = 3.0     # end-to-start gap joining segments of a primary group
MAX_GAP = 8.0           # largest gap closed when extending to a perpendicular line
SNAP_RADIUS = 4.0       # via -> intersection radius
SPLIT_BAND = 1.0        # point-to-line distance for splitting at points
TOL = 1e-9              # parametric tolerance of the intersection test


def classify(seg: DataFrame) -> DataFrame:
    """Snap to the nearer axis, then label H, V or N."""
    dx = F.abs(F.col("x1") - F.col("x2"))
    dy = F.abs(F.col("y1") - F.col("y2"))
    y2 = F.when(dy < dx, F.col("y1")).otherwise(F.col("y2"))
    x2 = F.when((dy < dx), F.col("x2")).when(dx < dy, F.col("x1")).otherwise(F.col("x2"))
    s = seg.withColumns({"x2": x2, "y2": y2})
    kind = F.when(F.col("y1") == F.col("y2"), "H").when(F.col("x1") == F.col("x2"), "V").otherwise("N")
    return s.withColumn("kind", kind)


def sweep_islands(df: DataFrame, lo: str, hi, part, out: str) -> DataFrame:
    """Islands of a sorted sweep: a row opens a new island when ``lo`` exceeds the
    largest ``hi`` of all rows with a smaller ``lo``; ids are 1, 2, ... per part.

    Rows with the same ``lo`` share an island, so the sweep runs over the distinct
    coordinates with their largest ``hi`` (a partial aggregation): a coordinate that
    holds a third of all rows is one row there, and the join back is an equi-join whose
    skewed side AQE splits.  The coordinates are swept in stretches (``scan``); each
    takes over the largest ``hi`` and the number of islands of the earlier ones.
    """
    part = list(part)
    hi_c = F.col(hi) if isinstance(hi, str) else hi
    x = df.withColumns({"_lo": F.col(lo), "_hi": hi_c})
    d = scan.stretches(x.groupBy(*part, "_lo").agg(F.max("_hi").alias("_hi")), part, ["_lo"])
    run = [*part, scan.STRETCH]
    carry = scan.carried(d.groupBy(*run).agg(F.max("_hi").alias("_m")), part, {"_carry": F.max("_m")})
    wr = Window.partitionBy(*run).orderBy("_lo")
    prev = F.greatest(F.max("_hi").over(wr.rowsBetween(Window.unboundedPreceding, -1)), F.col("_carry"))
    d = (d.join(large(carry), run)
          .withColumn("_s", F.when(prev.isNull() | (F.col("_lo") > prev), 1).otherwise(0))
          .withColumn("_local", F.sum("_s").over(wr.rowsBetween(Window.unboundedPreceding, 0))))
    offs = scan.carried(d.groupBy(*run).agg(F.sum("_s").alias("_n")), part, {"_off": F.sum("_n")})
    ids = d.join(large(offs), run).select(*part, "_lo", (F.coalesce("_off", F.lit(0)) + F.col("_local")).cast("long").alias(out))
    return x.join(large(ids), [*part, "_lo"]).select(*df.columns, out)


def gap_islands(df: DataFrame, coord: str, eps: float = EPS_PRIMARY, part=("tile",), out: str = "pgroup") -> DataFrame:
    """1-D DBSCAN with min_samples=1 = gaps-and-islands on a sorted coordinate.

    A new island starts where the gap to the previous value exceeds ``eps``,
    i.e. where ``coord`` exceeds the largest earlier ``coord + eps``.
    """
    return sweep_islands(df, coord, F.col(coord) + F.lit(eps), part, out)


def overlap_islands(df: DataFrame, lo: str, hi: str, part, out: str = "sgroup") -> DataFrame:
    """Intervals that overlap or touch share an island (running max of ends)."""
    return sweep_islands(df, lo, hi, part, out)


def primary_secondary(seg: DataFrame, axis: str = "y") -> DataFrame:
    """Primary coordinate (mean on the primary axis) and sorted secondary interval."""
    if axis == "y":
        p, a, b = (F.col("y1") + F.col("y2")) / 2, F.col("x1"), F.col("x2")
    else:
        p, a, b = (F.col("x1") + F.col("x2")) / 2, F.col("y1"), F.col("y2")
    return seg.withColumns({"pc": p, "s_lo": F.least(a, b), "s_hi": F.greatest(a, b)})


def overlap_groups(seg: DataFrame, axis: str = "y", eps: float = EPS_PRIMARY) -> DataFrame:
    """W2 + W3: primary islands, then overlap islands inside them."""
    x = gap_islands(primary_secondary(seg, axis), "pc", eps)
    x = overlap_islands(x, "s_lo", "s_hi", ["tile", "pgroup"])
    return x.withColumn("group", F.concat_ws(":", "pgroup", "sgroup"))


def merge_groups(seg: DataFrame, axis: str = "y") -> DataFrame:
    """One segment per group -- min/max on the long axis, mean on the short axis."""
    if axis == "y":
        g = seg.groupBy("tile", "group").agg(
            F.least(F.min("x1"), F.min("x2")).alias("lo"), F.greatest(F.max("x1"), F.max("x2")).alias("hi"),
            ((F.avg("y1") + F.avg("y2")) / 2).alias("mid"), F.count(F.lit(1)).alias("n"))
        return g.select("tile", "group", F.col("lo").alias("x1"), F.col("mid").alias("y1"),
                        F.col("hi").alias("x2"), F.col("mid").alias("y2"), "n")
    g = seg.groupBy("tile", "group").agg(
        F.least(F.min("y1"), F.min("y2")).alias("lo"), F.greatest(F.max("y1"), F.max("y2")).alias("hi"),
        ((F.avg("x1") + F.avg("x2")) / 2).alias("mid"), F.count(F.lit(1)).alias("n"))
    return g.select("tile", "group", F.col("mid").alias("x1"), F.col("lo").alias("y1"),
                    F.col("mid").alias("x2"), F.col("hi").alias("y2"), "n")


def _nearest_levels(ends: DataFrame, levels: DataFrame, end_col: str, side: str, gap: float) -> DataFrame:
    """Nearest level strictly before (``side='below'``: after) an end within ``gap``.

    Levels are distinct per (tile, value) and bucketed by ``gap``; a level is put into its own
    and the neighbouring buckets, so that an end, of which there are more, is sent once.
    """
    at = F.floor(F.col("level") / gap)
    lv = levels.select("tile", F.col("level")).distinct().withColumn("b", F.explode(F.array(at - 1, at, at + 1)))
    j = ends.withColumn("b", F.floor(F.col(end_col) / gap)).join(large(lv), ["tile", "b"])
    if side == "above":
        j = j.where((F.col("level") < F.col(end_col)) & (F.col(end_col) - F.col("level") <= gap))
        return j.groupBy("tile", "id").agg(F.max("level").alias("new_end"))
    j = j.where((F.col("level") > F.col(end_col)) & (F.col("level") - F.col(end_col) <= gap))
    return j.groupBy("tile", "id").agg(F.min("level").alias("new_end"))


def extend_to_perpendicular(seg: DataFrame, other: DataFrame, vertical: bool, gap: float = MAX_GAP) -> DataFrame:
    """Move a segment's ends to the nearest perpendicular line within ``gap``.

    Only the perpendicular coordinate is compared (no overlap test), as in
    the reference; vertical: y1 up to the nearest h.y < y1, y2 down to the
    nearest h.y > y2; horizontal likewise on x.
    """
    if vertical:
        lv = other.select("tile", F.col("y1").alias("level"))
        a, b = "y1", "y2"
    else:
        lv = other.select("tile", F.col("x1").alias("level"))
        a, b = "x1", "x2"
    up = _nearest_levels(seg.select("tile", "id", a), lv, a, "above", gap).withColumnRenamed("new_end", "_na")
    dn = _nearest_levels(seg.select("tile", "id", b), lv, b, "below", gap).withColumnRenamed("new_end", "_nb")
    j = seg.join(large(up), ["tile", "id"], "left").join(large(dn), ["tile", "id"], "left")
    return (j.withColumn(a, F.coalesce(F.col("_na"), F.col(a)))
             .withColumn(b, F.coalesce(F.col("_nb"), F.col(b)))
             .drop("_na", "_nb"))


def _cells(lo, hi, size):
    return F.sequence(F.floor(lo / size), F.floor(hi / size))


def crossings(v: DataFrame, h: DataFrame, cell: float = 16.0, partitions: int | None = None) -> DataFrame:
    """Vertical x horizontal crossings: v.x lies between h's ends and h.y between v's.

    v covers cells (cx(v.x), cy(y1)..cy(y2)); h covers (cx(x1)..cx(x2), cy(h.y)).
    A crossing pair meets in exactly one cell, (cx(v.x), cy(h.y)).  Both are dealt by tile and cy, and h
    is put into its cells behind the shuffle.
    """
    vv = (v.select("tile", F.col("id").alias("v_id"), F.col("x").alias("vx"), F.col("y1").alias("vy1"),
                   F.col("y2").alias("vy2"))
           .withColumn("cx", F.floor(F.col("vx") / cell))
           .withColumn("cy", F.explode(_cells(F.least("vy1", "vy2"), F.greatest("vy1", "vy2"), cell))))
    vv = deal(vv, "tile", "cy", partitions=partitions)
    hh = (deal(h.select("tile", F.col("id").alias("h_id"), F.col("x1").alias("hx1"), F.col("x2").alias("hx2"),
                        F.col("y").alias("hy"))
                .withColumn("cy", F.floor(F.col("hy") / cell)), "tile", "cy", partitions=partitions)
           .withColumn("cx", F.explode(_cells(F.least("hx1", "hx2"), F.greatest("hx1", "hx2"), cell))))
    j = vv.join(large(hh), ["tile", "cx", "cy"])
    # either end of a segment may come first
    j = j.where(F.col("vx").between(F.least("hx1", "hx2"), F.greatest("hx1", "hx2"))
                & F.col("hy").between(F.least("vy1", "vy2"), F.greatest("vy1", "vy2")))
    return j.select("tile", "v_id", "h_id", F.col("vx").alias("x"), F.col("hy").alias("y"))


def segment_intersections(a: DataFrame, b: DataFrame, cell: float = 16.0, tol: float = TOL) -> DataFrame:
    """General intersections (bounding boxes that overlap, then the places on both segments).

    Both sides explode to the cells of their bounding boxes; a pair is kept
    only in the cell holding the lower-left corner of the bbox overlap, so it
    is tested once.  Parallel pairs are skipped; the
    result is the distinct points per left segment.
    """
    def boxes(d, p):
        d = d.select("tile", F.col("id").alias(f"{p}id"), *[F.col(c).alias(f"{p}{c}") for c in ("x1", "y1", "x2", "y2")])
        d = d.withColumns({f"{p}minx": F.least(f"{p}x1", f"{p}x2"), f"{p}maxx": F.greatest(f"{p}x1", f"{p}x2"),
                           f"{p}miny": F.least(f"{p}y1", f"{p}y2"), f"{p}maxy": F.greatest(f"{p}y1", f"{p}y2")})
        d = d.withColumn("cx", F.explode(_cells(F.col(f"{p}minx"), F.col(f"{p}maxx"), cell)))
        return d.withColumn("cy", F.explode(_cells(F.col(f"{p}miny"), F.col(f"{p}maxy"), cell)))
    j = boxes(a, "a_").join(boxes(b, "b_"), ["tile", "cx", "cy"])
    ox, oy = F.greatest("a_minx", "b_minx"), F.greatest("a_miny", "b_miny")
    j = j.where((F.col("a_minx") <= F.col("b_maxx")) & (F.col("b_minx") <= F.col("a_maxx"))
                & (F.col("a_miny") <= F.col("b_maxy")) & (F.col("b_miny") <= F.col("a_maxy"))
                & (F.floor(ox / cell) == F.col("cx")) & (F.floor(oy / cell) == F.col("cy")))
    def cross(p, q):
        return p[0] * q[1] - p[1] * q[0]

    # a's start + place * its run = b's start + other * its run; crossing both sides with a run
    # leaves one unknown each.
    run_a = [F.col(f"a_{c}2") - F.col(f"a_{c}1") for c in "xy"]
    run_b = [F.col(f"b_{c}2") - F.col(f"b_{c}1") for c in "xy"]
    gap = [F.col(f"b_{c}1") - F.col(f"a_{c}1") for c in "xy"]
    turn = cross(run_a, run_b)
    j = (j.where(F.abs(turn) > tol)
          .withColumn("place", cross(gap, run_b) / turn).withColumn("other", cross(gap, run_a) / turn))
    inside = [F.col(c).between(-tol, 1 + tol) for c in ("place", "other")]
    return (j.where(inside[0] & inside[1])
             .select("tile", F.col("a_id").alias("id"), (F.col("a_x1") + F.col("place") * run_a[0]).alias("px"),
                     (F.col("a_y1") + F.col("place") * run_a[1]).alias("py"))
             .distinct())


def snap_points(pts: DataFrame, targets: DataFrame, radius: float = SNAP_RADIUS, partitions: int | None = None) -> DataFrame:
    """Each point moves to its nearest target closer than ``radius`` (k = 1), else stays.

    Targets sit in cells of side ``radius``; a point probes its 3 x 3 cells.
    Ties are broken by target coordinates.  ``matched`` marks moved points.
    """
    t = (targets.select("tile", F.col("x").alias("tx"), F.col("y").alias("ty"))
                .withColumn("cx", F.floor(F.col("tx") / radius)).withColumn("cy", F.floor(F.col("ty") / radius)))
    t = deal(t, "tile", "cy", partitions=partitions).distinct()
    offs = F.array(*[F.lit(i) for i in (-1, 0, 1)])
    p = pts.withColumn("cy", F.explode(F.transform(offs, lambda o: F.floor(F.col("y") / radius) + o)))
    p = deal(p, "tile", "cy", partitions=partitions).withColumn("cx", F.explode(F.transform(offs, lambda o: F.floor(F.col("x") / radius) + o)))
    j = p.join(large(t), ["tile", "cx", "cy"])
    d = F.sqrt((F.col("tx") - F.col("x")) ** 2 + (F.col("ty") - F.col("y")) ** 2)
    j = j.withColumn("d", d).where(F.col("d") < radius)
    # the least struct: combined map-side, no sort of a point's candidates
    best = j.groupBy("tile", "id").agg(F.min(F.struct("d", "tx", "ty")).alias("near")).select("tile", "id", "near.tx", "near.ty")
    out = pts.join(large(best), ["tile", "id"], "left")
    return out.select("tile", "id", "x", "y",
                      F.coalesce(F.col("tx"), F.col("x")).alias("adj_x"),
                      F.coalesce(F.col("ty"), F.col("y")).alias("adj_y"),
                      F.col("tx").isNotNull().alias("matched"))


def split_vertical_at_crossings(v: DataFrame, cross: DataFrame) -> DataFrame:
    """Split each vertical at its crossings, ordered by y (duplicates kept)."""
    starts = v.select("tile", F.col("id").alias("v_id"), F.col("x"), F.col("y1").alias("pos"),
                      F.lit(0).alias("k"), F.lit(0.0).alias("ord"))
    ends = v.select("tile", F.col("id").alias("v_id"), F.col("x"), F.col("y2").alias("pos"),
                    F.lit(2).alias("k"), F.lit(0.0).alias("ord"))
    mids = cross.select("tile", "v_id", "x", F.col("y").alias("pos"), F.lit(1).alias("k"),
                        F.col("h_id").cast("double").alias("ord"))
    allp = starts.unionByName(mids).unionByName(ends)
    # start first, crossings by y, end last
    pieces = scan.sequence(allp, ["tile", "v_id"], ["k", "pos", "ord"], ["pos"])
    return pieces.where(F.col("next_pos").isNotNull()).select(
        "tile", "v_id", F.col("_idx").alias("piece"), F.col("x"), F.col("pos").alias("y_from"), F.col("next_pos").alias("y_to"))


def split_at_points(seg: DataFrame, pts: DataFrame, vertical: bool, band: float = SPLIT_BAND,
                    cell: float = 16.0, partitions: int | None = None) -> DataFrame:
    """Split horizontals (verticals) at points within ``band`` of the line, ordered along it.

    Segments are bucketed by the perpendicular coordinate; a point is put into the
    buckets of its band.
    """
    if vertical:
        perp, far, along_lo, along_hi = "x1", "x2", "y1", "y2"
        pp, pa = "x", "y"
    else:
        perp, far, along_lo, along_hi = "y1", "y2", "x1", "x2"
        pp, pa = "y", "x"
    # segments: (perpendicular band bucket, along-axis cells they span); a point goes to the
    # band buckets around it and to its along-axis cell, so a segment-point pair meets only
    # in the segment's bucket and the point's cell.  Both are dealt by tile and bucket, and a
    # segment is put into its cells behind the shuffle.
    pb = (pts.select("tile", F.col(pp).alias("pp"), F.col(pa).alias("pa"))
             .withColumn("b", F.explode(_cells(F.col("pp") - band, F.col("pp") + band, band))))
    pb = deal(pb, "tile", "b", partitions=partitions).withColumn("xc", F.floor(F.col("pa") / cell))
    s = seg.select("tile", "id", F.col(perp).alias("sp"), F.col(far).alias("sp2"), F.col(along_lo).alias("lo"), F.col(along_hi).alias("hi"))
    sb = (deal(s.withColumn("b", F.floor(F.col("sp") / band)), "tile", "b", partitions=partitions)
          .withColumn("xc", F.explode(_cells(F.least("lo", "hi"), F.greatest("lo", "hi"), cell))))
    keep = ["sp", "sp2"]
    cuts = (sb.join(large(pb), ["tile", "b", "xc"])
              .where((F.abs(F.col("pp") - F.col("sp")) <= band) & (F.col("lo") <= F.col("pa"))
                     & (F.col("pa") <= F.col("hi")))
              .select("tile", "id", F.col("pa").alias("pos"), F.lit(1).alias("k"), *keep))
    # start and end rows carry the segment's columns too: no join back
    base = s.select("tile", "id", F.col("lo").alias("pos"), F.lit(0).alias("k"), *keep)
    endp = s.select("tile", "id", F.col("hi").alias("pos"), F.lit(2).alias("k"), *keep)
    allp = base.unionByName(cuts).unionByName(endp)
    j = (scan.sequence(allp, ["tile", "id"], ["k", "pos"], ["pos", "k"])
         .withColumnsRenamed({"next_pos": "to", "next_k": "to_k", "_idx": "piece"}).where(F.col("to").isNotNull()))
    # inner pieces stay on the start line; the last piece ends at the segment's end point
    is_last = F.col("to_k") == 2
    if vertical:
        return j.select("tile", "id", "piece", F.col("sp").alias("x1"), F.col("pos").alias("y1"),
                        F.when(is_last, F.col("sp2")).otherwise(F.col("sp")).alias("x2"), F.col("to").alias("y2"))
    return j.select("tile", "id", "piece", F.col("pos").alias("x1"), F.col("sp").alias("y1"),
                    F.col("to").alias("x2"), F.when(is_last, F.col("sp2")).otherwise(F.col("sp")).alias("y2"))


def rebase(seg: DataFrame, tiles_per_row: int = 10, width: float = 1000.0, height: float = 200.0) -> DataFrame:
    """U8: tile-local to global coordinates (x + tile column * width, y + tile row * height)."""
    ox = (F.col("tile") % tiles_per_row) * width
    oy = F.floor(F.col("tile") / tiles_per_row) * height
    return seg.withColumns({c: F.col(c) + (ox if c.startswith("x") else oy)
                            for c in seg.columns if c in ("x", "x1", "x2", "y", "y1", "y2")})
