"""Pixel and component queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from dosecast.operators import components as cc
from dosecast.operators import geometry as ge
from dosecast.plans.catalog import register
from dosecast.sources import fixtures as fx

LIMIT_MEDIAN, LIMIT_MAX = 20.0, 5.0


def thr_sql(base: str, steps: int, limit: float) -> str:
    return f"""
select tile, t as threshold, share, i from (
  select s.*, min(case when share > {limit} then i end) over (partition by tile) as pick
  from (select tile, i, base - 10 * i as t,
               count_if(v > base - 10 * i) * 100.0 / count(*) as share
        from (select p.*, b.base from pixel p join (select tile, {base} as base from pixel group by tile) b
              using (tile)) x
        cross join range(0, {steps}) as r(i)
        group by tile, i, base) s)
where i = coalesce(pick, {steps - 1})"""


PV = {
    "thr_v": thr_sql("quantile_cont(v, 0.5)", 14, LIMIT_MEDIAN),
    "mask_v": "select p.tile, p.r, p.c from pixel p join thr_v t using (tile) where p.v > t.threshold",
    "edges_v": """
select a.tile, a.r * 8 + a.c as src, b.r * 8 + b.c as dst from mask_v a join mask_v b
  on a.tile = b.tile and abs(a.r - b.r) <= 1 and abs(a.c - b.c) <= 1 and not (a.r = b.r and a.c = b.c)""",
    "comp_v": """
select m.tile, m.r, m.c, m.r * 8 + m.c as node, l.label from mask_v m join (
  with recursive reach(tile, node, lbl) as (
    select tile, r * 8 + c, r * 8 + c from mask_v
    union
    select r.tile, e.dst, r.lbl from reach r join edges_v e on r.tile = e.tile and r.node = e.src)
  select tile, node, min(lbl) as label from reach group by tile, node) l
  on l.tile = m.tile and l.node = m.r * 8 + m.c""",
}


@register("tile_threshold", "tile:l threshold:d share:d i:l", "select * from thr_v", PV)
def q_thr(t):
    """V1."""
    return cc.tile_threshold(fx.pixel(t), LIMIT_MEDIAN)


@register("tile_threshold_max", "tile:l threshold:d share:d i:l",
          "select * from thrmax_v", {"thrmax_v": thr_sql("cast(max(v) as double)", 10, LIMIT_MAX)})
def q_thr_max(t):
    """V2."""
    return cc.tile_threshold_max(fx.pixel(t), LIMIT_MAX)


@register("dilate_mask", "tile:l r:l c:l", """
select distinct tile, r + dr as r, c + dc as c from mask_v
cross join (values (-1), (0), (1)) a(dr) cross join (values (-1), (0), (1)) b(dc)
where r + dr between 0 and 7 and c + dc between 0 and 7""", PV)
def q_dilate(t):
    """V3."""
    px = fx.pixel(t)
    return cc.dilate(cc.mask(px, cc.tile_threshold(px, LIMIT_MEDIAN)))


def comps(t):
    px = fx.pixel(t)
    return cc.pixel_components(cc.mask(px, cc.tile_threshold(px, LIMIT_MEDIAN)))


@register("pixel_components", "tile:l r:l c:l node:l label:l", "select * from comp_v", PV)
def q_components(t):
    """V4: 8-connected components (recursive SQL oracle)."""
    return comps(t)


@register("component_stats", "tile:l label:l size:l r_min:l c_min:l r_max:l c_max:l rank:l", """
select *, row_number() over (partition by tile order by size desc, label) as rank from (
  select tile, label, count(*) as size, min(r) as r_min, min(c) as c_min, max(r) as r_max, max(c) as c_max
  from comp_v group by tile, label)""", PV)
def q_component_stats(t):
    """A23 + T5."""
    return cc.component_stats(comps(t))


@register("blob_centres", "tile:l label:l size:l boundary:l cr:l cc:l", """
select tile, label, count(*) as size, sum(is_b) as boundary, cast(trunc(avg(r)) as bigint) as cr,
       cast(trunc(avg(c)) as bigint) as cc
from (select a.tile, a.label, a.r, a.c,
             max(case when b.label is null or b.label <> a.label then 1 else 0 end) as is_b
      from comp_v a cross join (values (-1, 0), (1, 0), (0, -1), (0, 1)) o(dr, dc)
      left join comp_v b on b.tile = a.tile and b.r = a.r + o.dr and b.c = a.c + o.dc
      group by a.tile, a.label, a.r, a.c)
group by tile, label having sum(is_b) <= 12""", PV)
def q_blobs(t):
    """V5 (re-aimed: pixel means and boundary-pixel counts)."""
    return cc.blob_centres(comps(t))


@register("segment_groups", "tile:l pgroup:l id:l comp:l", """
with recursive e as (
  select a.tile, a.pgroup, a.id as src, b.id as dst from pg_v a join pg_v b
    on a.tile = b.tile and a.pgroup = b.pgroup and a.id <> b.id and abs(a.x1 - b.x2) <= 3
  union select a.tile, a.pgroup, b.id, a.id from pg_v a join pg_v b
    on a.tile = b.tile and a.pgroup = b.pgroup and a.id <> b.id and abs(a.x1 - b.x2) <= 3),
reach(tile, pgroup, node, lbl) as (
  select tile, pgroup, id, id from pg_v
  union
  select r.tile, r.pgroup, e.dst, r.lbl from reach r join e on r.tile = e.tile and r.pgroup = e.pgroup
    and r.node = e.src)
select tile, pgroup, node as id, min(lbl) as comp from reach group by tile, pgroup, node""",
          {"pg_v": """
select *, sum(s) over (partition by tile order by pc, id rows between unbounded preceding and current row) as pgroup
from (select *, case when lag(pc) over (partition by tile order by pc, id) is null
                      or pc - lag(pc) over (partition by tile order by pc, id) > 2.0 then 1 else 0 end as s
      from (select *, (y + y) / 2 as pc from hseg))"""})
def q_segment_groups(t):
    """V6: primary islands, then end-to-start components."""
    h = fx.hseg(t)
    return cc.segment_groups(h.withColumns({"y1": F.col("y"), "y2": F.col("y")}))


@register("segment_groups_x", "tile:l pgroup:l id:l comp:l", """
with recursive near as (
  select tile, pgroup, a.id as one, b.id as two from xg_v a join xg_v b using (tile, pgroup)
  where a.id <> b.id and least(abs(a.y1 - b.y2), abs(b.y1 - a.y2)) <= 3),
seen(tile, pgroup, id, root) as (
  select tile, pgroup, id, id from xg_v
  union
  select s.tile, s.pgroup, n.two, s.root from seen s join near n on n.tile = s.tile and n.pgroup = s.pgroup and n.one = s.id)
select tile, pgroup, id, min(root) as comp from seen group by tile, pgroup, id""",
          {"xg_v": """
select tile, id, y1, y2, sum(opens) over (partition by tile order by x, id rows unbounded preceding) as pgroup
from (select *, case when x - lag(x) over (partition by tile order by x, id) <= 2.0 then 0 else 1 end as opens
      from vseg)"""})
def q_segment_groups_x(t):
    """V6 on the x axis: vertical segments, starts and ends on y."""
    v = fx.vseg(t)
    return cc.segment_groups(v.withColumns({"x1": F.col("x"), "x2": F.col("x")}), axis="x")


del ge
