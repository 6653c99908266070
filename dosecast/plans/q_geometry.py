"""Segment-table queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from dosecast.operators import geometry as ge
from dosecast.plans.catalog import register
from dosecast.session import partitions_for
from dosecast.sources import fixtures as fx


def h_full(t):
    h = fx.hseg(t)
    return h.withColumns({"y1": F.col("y"), "y2": F.col("y")})


def v_full(t):
    v = fx.vseg(t)
    return v.withColumns({"x1": F.col("x"), "x2": F.col("x")})


def parts(t) -> int:
    """Partitions of the joins by cell: a line item, order or event is a segment or a point, which lies in a few cells.
    The counts come from the files' footers."""
    return partitions_for(t.spark, t.lineitem.count() + t.orders.count() + t.events.count())


GV = {
    "cross_v": """
select v.tile, v.id as v_id, h.id as h_id, v.x, h.y from vseg v join hseg h
  on v.tile = h.tile and h.x1 <= v.x and v.x <= h.x2 and v.y1 <= h.y and h.y <= v.y2""",
    "snap_v": """
select v.tile, v.id, v.x, v.y, coalesce(b.tx, v.x) as adj_x, coalesce(b.ty, v.y) as adj_y, b.tx is not null as matched
from via v left join (
  select tile, id, tx, ty from (
    select v.tile, v.id, p.tx, p.ty,
           row_number() over (partition by v.tile, v.id
                              order by sqrt((p.tx - v.x) ** 2 + (p.ty - v.y) ** 2), p.tx, p.ty) as r
    from via v join (select distinct tile, x as tx, y as ty from cross_v) p
      on v.tile = p.tile and abs(p.tx - v.x) < 4 and abs(p.ty - v.y) < 4
    where sqrt((p.tx - v.x) ** 2 + (p.ty - v.y) ** 2) < 4) where r = 1) b using (tile, id)""",
    "split_pts": "select tile, adj_x as x, adj_y as y from snap_v where matched",
    "pg_v": """
select *, sum(s) over (partition by tile order by pc, id rows between unbounded preceding and current row) as pgroup
from (select *, case when lag(pc) over (partition by tile order by pc, id) is null
                      or pc - lag(pc) over (partition by tile order by pc, id) > 2.0 then 1 else 0 end as s
      from (select *, (y + y) / 2 as pc, least(x1, x2) as s_lo, greatest(x1, x2) as s_hi from hseg))""",
    "og_v": """
select *, concat_ws(':', pgroup, sgroup) as "group" from (
select *, sum(s2) over (partition by tile, pgroup order by s_lo, s_hi, id
                        rows between unbounded preceding and current row) as sgroup
from (select *, case when max(s_hi) over (partition by tile, pgroup order by s_lo, s_hi, id
                                          rows between unbounded preceding and 1 preceding) is null
                       or s_lo > max(s_hi) over (partition by tile, pgroup order by s_lo, s_hi, id
                                                 rows between unbounded preceding and 1 preceding)
                     then 1 else 0 end as s2 from pg_v))""",
}


@register("classify_segments", "src:s tile:l id:l x1:d y1:d x2:d y2:d kind:s", """
select src, tile, id, x1, y1,
       case when abs(y1 - y2) < abs(x1 - x2) then x2 when abs(x1 - x2) < abs(y1 - y2) then x1 else x2 end as x2,
       case when abs(y1 - y2) < abs(x1 - x2) then y1 else y2 end as y2,
       case when y1 = (case when abs(y1 - y2) < abs(x1 - x2) then y1 else y2 end) then 'H'
            when x1 = (case when abs(y1 - y2) < abs(x1 - x2) then x2 when abs(x1 - x2) < abs(y1 - y2) then x1
                            else x2 end) then 'V' else 'N' end as kind
from (select 'a' as src, * from seg_a union all select 'b', * from seg_b)""")
def q_classify(t):
    """X19."""
    a = fx.seg_a(t).withColumn("src", F.lit("a"))
    b = fx.seg_b(t).withColumn("src", F.lit("b"))
    return ge.classify(a.unionByName(b))


@register("gap_islands", "tile:l id:l pc:d pgroup:l", "select tile, id, pc, pgroup from pg_v", GV)
def q_gap_islands(t):
    """1-D DBSCAN (min_samples=1, eps=2) on the primary coordinate."""
    return ge.gap_islands(ge.primary_secondary(h_full(t), "y"), "pc", ge.EPS_PRIMARY)


@register("overlap_islands", "tile:l id:l pgroup:l sgroup:l group:s", "select * from og_v", GV)
def q_overlap_islands(t):
    """overlap/touch islands inside each primary group."""
    return ge.overlap_groups(h_full(t), "y")


@register("merge_segments", "tile:l group:s x1:d y1:d x2:d y2:d n:l", """
select tile, "group", least(min(x1), min(x2)) as x1, (avg(y) + avg(y)) / 2 as y1,
       greatest(max(x1), max(x2)) as x2, (avg(y) + avg(y)) / 2 as y2, count(*) as n
from og_v group by tile, "group" """, GV)
def q_merge(t):
    """One segment per group."""
    return ge.merge_groups(ge.overlap_groups(h_full(t), "y"), "y")


@register("extend_v", "tile:l id:l x:d y1:d y2:d", """
select v.tile, v.id, v.x,
       coalesce((select max(h.y) from hseg h where h.tile = v.tile and h.y < v.y1 and v.y1 - h.y <= 8), v.y1) as y1,
       coalesce((select min(h.y) from hseg h where h.tile = v.tile and h.y > v.y2 and h.y - v.y2 <= 8), v.y2) as y2
from vseg v""")
def q_extend_v(t):
    """Verticals extended to the nearest horizontal within 8."""
    return ge.extend_to_perpendicular(fx.vseg(t), h_full(t), vertical=True)


@register("extend_h", "tile:l id:l x1:d x2:d y:d", """
select h.tile, h.id,
       coalesce((select max(v.x) from vseg v where v.tile = h.tile and v.x < h.x1 and h.x1 - v.x <= 8), h.x1) as x1,
       coalesce((select min(v.x) from vseg v where v.tile = h.tile and v.x > h.x2 and v.x - h.x2 <= 8), h.x2) as x2,
       h.y
from hseg h""")
def q_extend_h(t):
    """Horizontals extended to the nearest vertical within 8."""
    return ge.extend_to_perpendicular(fx.hseg(t), v_full(t), vertical=False)


@register("crossings", "tile:l v_id:l h_id:l x:d y:d", "select * from cross_v", GV)
def q_crossings(t):
    """Range join through grid cells."""
    return ge.crossings(fx.vseg(t), fx.hseg(t), partitions=parts(t))


@register("segment_intersections", "tile:l id:l px:d py:d", """
with near as (
  select l.tile, l.id, l.x1 as px, l.y1 as py, l.x2 - l.x1 as lx, l.y2 - l.y1 as ly,
         r.x2 - r.x1 as rx, r.y2 - r.y1 as ry, r.x1 - l.x1 as gx, r.y1 - l.y1 as gy
  from seg_a l join seg_b r on r.tile = l.tile
  where greatest(least(l.x1, l.x2), least(r.x1, r.x2)) <= least(greatest(l.x1, l.x2), greatest(r.x1, r.x2))
    and greatest(least(l.y1, l.y2), least(r.y1, r.y2)) <= least(greatest(l.y1, l.y2), greatest(r.y1, r.y2))),
turned as (select *, lx * ry - ly * rx as turn from near),
placed as (
  select *, (gx * ry - gy * rx) / turn as place, (gx * ly - gy * lx) / turn as other from turned where abs(turn) > 1e-9)
select distinct tile, id, px + place * lx as px, py + place * ly as py from placed
where place between -1e-9 and 1 + 1e-9 and other between -1e-9 and 1 + 1e-9""")
def q_intersections(t):
    """J19 (+ U6 distinct points)."""
    return ge.segment_intersections(fx.seg_a(t), fx.seg_b(t))


@register("snap_points", "tile:l id:l x:d y:d adj_x:d adj_y:d matched:b", "select * from snap_v", GV)
def q_snap(t):
    """Vias to the nearest crossing within radius 4."""
    n = parts(t)
    cr = ge.crossings(fx.vseg(t), fx.hseg(t), partitions=n)
    return ge.snap_points(fx.via(t), cr.select("tile", "x", "y"), partitions=n)


@register("split_at_crossings", "tile:l v_id:l piece:l x:d y_from:d y_to:d", """
select tile, v_id, piece, x, y_from, y_to from (
  select tile, v_id, x, pos as y_from, lead(pos) over w as y_to, row_number() over w - 1 as piece
  from (select tile, id as v_id, x, y1 as pos, 0 as k, 0.0 as ord from vseg
        union all select tile, v_id, x, y, 1, cast(h_id as double) from cross_v
        union all select tile, id, x, y2, 2, 0.0 from vseg)
  window w as (partition by tile, v_id order by k, pos, ord))
where y_to is not null""", GV)
def q_split_cross(t):
    """W4."""
    v = fx.vseg(t)
    return ge.split_vertical_at_crossings(v, ge.crossings(v, fx.hseg(t), partitions=parts(t)))


def _split_sql(vertical: bool) -> str:
    if vertical:
        seg = "select tile, id, x as sp, y1 as lo, y2 as hi, x as x1, y1, x as x2, y2 from vseg"
        cond = "abs(p.x - s.sp) <= 1 and s.lo <= p.y and p.y <= s.hi"
        pos = "p.y"
        out = "sp as x1, pos as y1, case when to_k = 2 then x2 else sp end as x2, \"to\" as y2"
    else:
        seg = "select tile, id, y as sp, x1 as lo, x2 as hi, x1, y as y1, x2, y as y2 from hseg"
        cond = "abs(p.y - s.sp) <= 1 and s.lo <= p.x and p.x <= s.hi"
        pos = "p.x"
        out = "pos as x1, sp as y1, \"to\" as x2, case when to_k = 2 then y2 else sp end as y2"
    return f"""
select tile, id, piece, {out} from (
  select a.*, lead(pos) over w as "to", lead(k) over w as to_k, row_number() over w - 1 as piece
  from (select tile, id, lo as pos, 0 as k from segs
        union all select s.tile, s.id, {pos}, 1 from segs s join split_pts p on s.tile = p.tile and {cond}
        union all select tile, id, hi, 2 from segs) a
  window w as (partition by tile, id order by k, pos)) x
join segs using (tile, id)
where "to" is not null""".replace("segs", "segs_" + ("v" if vertical else "h")), seg


_HS, _HSEG = _split_sql(False)
_VS, _VSEG = _split_sql(True)


@register("split_h_at_points", "tile:l id:l piece:l x1:d y1:d x2:d y2:d", _HS, {**GV, "segs_h": _HSEG})
def q_split_h(t):
    """W5 on horizontals, at the snapped via points."""
    n = parts(t)
    cr = ge.crossings(fx.vseg(t), fx.hseg(t), partitions=n)
    sp = ge.snap_points(fx.via(t), cr.select("tile", "x", "y"), partitions=n).where("matched") \
           .select("tile", F.col("adj_x").alias("x"), F.col("adj_y").alias("y"))
    return ge.split_at_points(h_full(t), sp, vertical=False, partitions=n)


@register("split_v_at_points", "tile:l id:l piece:l x1:d y1:d x2:d y2:d", _VS, {**GV, "segs_v": _VSEG})
def q_split_v(t):
    """W5 on verticals, at the snapped via points."""
    n = parts(t)
    cr = ge.crossings(fx.vseg(t), fx.hseg(t), partitions=n)
    sp = ge.snap_points(fx.via(t), cr.select("tile", "x", "y"), partitions=n).where("matched") \
           .select("tile", F.col("adj_x").alias("x"), F.col("adj_y").alias("y"))
    return ge.split_at_points(v_full(t), sp, vertical=True, partitions=n)


@register("rebase_tiles", "tile:l id:l x1:d x2:d y:d", """
select tile, id, x1 + (tile % 10) * 1000.0 as x1, x2 + (tile % 10) * 1000.0 as x2,
       y + floor(tile / 10) * 200.0 as y from hseg""")
def q_rebase(t):
    """U8: tile offsets to global coordinates."""
    return ge.rebase(fx.hseg(t).select("tile", "id", "x1", "x2", "y"))
