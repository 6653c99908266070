"""The fixture views of ``dosecast.sources.fixtures`` written in DuckDB SQL.

Used only to build independent oracle queries for the correctness check;
``with_views(body)`` prepends the CTEs a query needs, in dependency order.
Integer truncation is ``trunc`` here (a DuckDB cast rounds), pandas-style
rounding is ``round_even``.
"""

from __future__ import annotations

import re

B = "cast(substr(p_brand, 7) as integer)"

VIEWS: dict[str, str] = {}
ORDER: list[str] = []


def view(name: str, sql: str) -> None:
    VIEWS[name] = sql
    ORDER.append(name)


def mi(ts: str) -> str:
    return f"(year({ts}) * 12 + month({ts}) - 1)"


def datekey(d: str) -> str:
    return f"(year({d}) * 10000 + month({d}) * 100 + day({d}))"


def med_name(m: str) -> str:
    b = f"cast(substr({m}, 7) as integer)"
    return (f"(case when {b} % 12 = 0 then 'Insulin ' || {m} when {b} % 12 = 5 then 'Patient supply ' || {m} "
            f"when {b} = 7 then null else {m} end)")


view("facility", """
select cast(n_nationkey as bigint) as skclientkey, cast(n_regionkey as bigint) as hdp_shardid,
       r_name as idn_name, case when n_nationkey % 5 <> 0 then 1 else 0 end as ismaenabled
from nation join region on n_regionkey = r_regionkey""")

view("active_facilities", "select * from facility where ismaenabled = 1")

view("item", f"""
with owned as (
  select distinct l_partkey as itemrootkey, cast(s_nationkey as bigint) as skclientkey,
         cast(n_regionkey as bigint) as hdp_shardid, p_brand, {B} as b
  from lineitem join supplier on l_suppkey = s_suppkey join nation on s_nationkey = n_nationkey
  join part on l_partkey = p_partkey)
select itemrootkey, skclientkey, hdp_shardid, p_brand as itemid, case when b % 10 <> 0 then 1 else 0 end as meditemflag,
       cast(null as timestamp) as endlocaldatetime from owned
union all
select itemrootkey, skclientkey, hdp_shardid, 'old', case when b % 10 <> 0 then 1 else 0 end,
       timestamp '1996-01-01 00:00:00' from owned where itemrootkey % 3 = 0""")

view("device", """
select s_suppkey as dispensingdevicerootkey, s_name as dispensingdevicename,
       cast(s_nationkey as bigint) as skclientkey, cast(n_regionkey as bigint) as hdp_shardid,
       case when s_suppkey % 5 = 0 then 4 else 1 + s_suppkey % 2 end as devicetypekey,
       cast(null as timestamp) as endlocaldatetime
from supplier join nation on s_nationkey = n_nationkey""")

view("tx", """
select l_orderkey * 8 + l_linenumber as itemtransactionkey, l_partkey as itemrootkey,
       l_suppkey as dispensingdevicerootkey, cast(s_nationkey as bigint) as skclientkey,
       cast(n_regionkey as bigint) as hdp_shardid, l_shipdate as transactionlocaldatetime,
       case l_returnflag when 'A' then 13 when 'R' then 502 else 1 end as legacytransactiontypekey,
       l_quantity as transactionquantity,
       cast(l_quantity + l_linenumber as double) as startstoragespaceinventoryquantity,
       cast(l_linenumber + case when l_orderkey % 50 = 0 then 1 else 0 end as double)
           as endstoragespaceinventoryquantity,
       case when l_orderkey % 40 = 0 then 1 else 0 end as cancelflag,
       case when l_orderkey % 7 = 0 then null else cast(l_quantity + l_linenumber as double) end
           as actualbegincount
from lineitem join supplier on l_suppkey = s_suppkey join nation on s_nationkey = n_nationkey""")

view("removal_tx", f"""
select x.itemtransactionkey, x.skclientkey, x.hdp_shardid, x.itemrootkey, i.itemid as medid,
       {med_name('i.itemid')} as medfullname,
       x.dispensingdevicerootkey as device_naturalkey, d.dispensingdevicename, x.transactionlocaldatetime,
       x.cancelflag, x.startstoragespaceinventoryquantity, x.endstoragespaceinventoryquantity,
       x.legacytransactiontypekey, x.transactionquantity, x.actualbegincount
from tx x
join item i on i.itemrootkey = x.itemrootkey and i.skclientkey = x.skclientkey and i.hdp_shardid = x.hdp_shardid
     and i.endlocaldatetime is null and i.meditemflag = 1
join device d on d.dispensingdevicerootkey = x.dispensingdevicerootkey and d.skclientkey = x.skclientkey
     and d.hdp_shardid = x.hdp_shardid and d.endlocaldatetime is null
where x.legacytransactiontypekey in (13, 502) and x.transactionquantity > 0
  and x.startstoragespaceinventoryquantity - x.endstoragespaceinventoryquantity = x.transactionquantity
  and x.cancelflag = 0""")

view("monthly_removals", f"""
select hdp_shardid, skclientkey, medid, device_naturalkey, {mi('transactionlocaldatetime')} as month,
       sum(transactionquantity) as transactionquantity, coalesce(sum(actualbegincount), 0.0) as actualbegincount
from removal_tx where transactionquantity <= 1000
group by all""")

view("usage_src", f"""
select x.hdp_shardid, x.skclientkey as clientkey, cast({B} as bigint) as medkey,
       x.dispensingdevicerootkey as devicekey, {datekey('x.transactionlocaldatetime')} as datekey,
       x.transactionquantity as usagedoses, cast(1 as bigint) as usage,
       case when x.itemtransactionkey % 8 = 7 then 1 else 2 end as sourcesystemkey
from tx x join part on x.itemrootkey = p_partkey
where x.legacytransactiontypekey = 1""")

view("med", f"""
select hdp_shardid, skclientkey as clientkey, cast({B} as bigint) as medkey, p_brand as medid,
       case when {B} % 4 = 0 then 1 else 0 end as iscontrolledmed,
       case when ({B} + skclientkey) % 13 = 0 then 0 else 1 end as isactive,
       case when {B} % 9 = 0 then 1 else 0 end as ismedexcluded,
       case when ({B} + skclientkey) % 17 = 0 then 1 else 0 end as isshortageexcluded
from (select distinct x.hdp_shardid, x.skclientkey, p_brand
      from tx x join part on x.itemrootkey = p_partkey where x.legacytransactiontypekey = 1)""")

view("usage_device", """
select hdp_shardid, dispensingdevicerootkey as devicekey, dispensingdevicename as devicename,
       dispensingdevicerootkey as naturalkey from device""")

view("usage_enriched", """
select u.*, m.medid, m.iscontrolledmed, m.isactive, m.ismedexcluded, m.isshortageexcluded,
       d.devicename, d.naturalkey
from usage_src u
join med m on u.hdp_shardid = m.hdp_shardid and u.clientkey = m.clientkey and u.medkey = m.medkey
join usage_device d on u.hdp_shardid = d.hdp_shardid and u.devicekey = d.devicekey
where u.sourcesystemkey = 2""")

view("monthly_usage", """
select hdp_shardid, clientkey, medkey, medid, devicename, naturalkey as device_naturalkey,
       cast(floor(datekey / 100) as integer) as year_month,
       max(iscontrolledmed) as iscontrolledmed, min(isactive) as isactive,
       max(ismedexcluded) as ismedexcluded, max(isshortageexcluded) as isshortageexcluded,
       sum(usagedoses) / 30 as avgdailyusage30, sum(usage) as usage_count30,
       min(datekey) as MinUsagedateKey, max(datekey) as MaxUsagedateKey, count(*) as number_of_activedays
from usage_enriched
group by hdp_shardid, clientkey, medkey, medid, devicename, naturalkey, cast(floor(datekey / 100) as integer)""")

view("usage_feat", """
select hdp_shardid, clientkey as skclientkey, medid, device_naturalkey, devicename as dispensingdevicename,
       cast(floor(year_month / 100) * 12 + year_month % 100 - 1 + 1 as integer) as month,
       avgdailyusage30, cast(trunc(avgdailyusage30 * 100) as bigint) as usage100
from monthly_usage""")

view("pocket_snapshot", f"""
select cast(s_nationkey as bigint) as skclientkey, cast(n_regionkey as bigint) as hdp_shardid,
       {datekey('last_day(cast(l_shipdate as date))')} as sktimekeyeffmonth,
       l_partkey as itemrootkey, l_suppkey as dispensingdevicerootkey,
       case when l_orderkey % 11 = 0 then 1 else 0 end as isinactive, l_quantity as cur,
       case when l_orderkey % 9 = 0 then null
            else {datekey('(last_day(cast(l_shipdate as date)) + cast(l_orderkey % 400 as integer))')} end
           as expireitemtimekey,
       l_linenumber % 2 as standardstockwithindispensingdeviceflag,
       l_quantity + 10 as max, cast(floor(l_quantity / 4) as double) as min
from lineitem join supplier on l_suppkey = s_suppkey join nation on s_nationkey = n_nationkey""")

view("snap", f"""
select d.skclientkey, d.hdp_shardid,
       last_day(make_date(cast(floor(mi / 12) as integer), cast(mi % 12 + 1 as integer), 1)) as lastday_of_month,
       pr.medid, d.dispensingdevicename, d.devicetypekey,
       case when b % 10 <> 0 then 1 else 0 end as meditemflag, pr.s as device_naturalkey,
       case when (pr.s + b) % 11 = 0 and mi % 12 > 9 then 1 else 0 end as isinactive,
       cast((pr.s * 7 + b * 13 + mi * 5) % 60 + case when (pr.s + b + mi) % 23 = 0 then 2000 else 0 end as double)
           as inventoryquantity,
       case when (pr.s + b + mi) % 9 = 0 then null
            else make_date(cast(floor((mi + 1) / 12) as integer), cast((mi + 1) % 12 + 1 as integer), 1)
                 + cast((pr.s * 31 + b * 17 + mi * 11) % 400 - 40 as integer) end as earliestnextexpirationdate,
       cast((b + pr.s) % 2 as integer) as standardstockwithindispensingdeviceflag,
       cast(20 + (b * 3 + pr.s) % 30 as double) as max_par_level,
       cast(floor((20 + (b * 3 + pr.s) % 30) / 4) as double) as min_par_level
from (select distinct p_brand as medid, l_suppkey as s, {B} as b
      from lineitem join part on l_partkey = p_partkey) pr
join device d on d.dispensingdevicerootkey = pr.s
cross join (select unnest(range(min({mi('l_shipdate')}) - 1, max({mi('l_shipdate')}) + 1)) as mi from lineitem) m""")

view("snap_feat", """
select *, case when dist_eed > 120 then 0 when dist_eed < 0 then 2 else 1 end as dist_eed_120,
          case when dist_eed > 90 then 0 when dist_eed < 0 then 2 else 1 end as dist_eed_90
from (select *, cast(coalesce(d0, floor(avg(d0) over (partition by skclientkey, medid, device_naturalkey)), 0)
                     as integer) as dist_eed
      from (select *, lastday_of_month + 1 as monthfirstday,
                   cast(year(lastday_of_month + 1) * 12 + month(lastday_of_month + 1) - 1 as integer) as month,
                   date_diff('day', lastday_of_month + 1, earliestnextexpirationdate) as d0
            from snap))""")

view("cost_src", """
select cast(n_nationkey as bigint) as clientkey, p_brand as medid,
       timestamp '1995-01-01 00:00:00' + to_days(p_size) as lastmodifieddatetime,
       case when p_partkey % 11 = 0 then null else p_retailprice end as unitcost,
       cast(n_regionkey as bigint) as hdp_shardid,
       case when p_partkey % 4 = 0 then 1 else 2 end as sourcesystemkey, p_partkey as medkey
from part join nation on p_partkey % 5 = n_nationkey % 5""")

view("latest_cost", """
select r.clientkey as skclientkey, medid, lastmodifieddatetime, unitcost, r.hdp_shardid, sourcesystemkey
from (select *, row_number() over (partition by clientkey, sourcesystemkey, hdp_shardid, medid
                                    order by lastmodifieddatetime desc, medkey desc) as med_rank
      from cost_src where unitcost is not null) r
join active_facilities f on f.skclientkey = r.clientkey
where med_rank <= 1 and sourcesystemkey = 2""")

view("med_names", """
select distinct skclientkey, medid, medfullname from
  (select skclientkey, medid, medfullname,
          rank() over (partition by skclientkey, medid order by transactionlocaldatetime desc) as r
   from removal_tx) where r = 1""")

view("device_names", """
select distinct skclientkey, device_naturalkey, dispensingdevicename from
  (select skclientkey, device_naturalkey, dispensingdevicename,
          rank() over (partition by skclientkey, device_naturalkey order by transactionlocaldatetime desc) as r
   from removal_tx) where r = 1""")

view("panel", """
select s.hdp_shardid, s.skclientkey, s.medid, s.device_naturalkey, s.month, s.inventoryquantity,
       s.standardstockwithindispensingdeviceflag, s.dist_eed, s.dist_eed_120, s.dist_eed_90, s.max_par_level,
       s.min_par_level, s.devicetypekey, s.meditemflag, s.isinactive,
       coalesce(u.avgdailyusage30, 0) as avgdailyusage30, coalesce(u.usage100, 0) as usage100,
       coalesce(c.unitcost, 0) as unitcost, coalesce(r.transactionquantity, 0) as transactionquantity,
       r.actualbegincount, mn.medfullname, dn.dispensingdevicename,
       r.actualbegincount is not null as any_expiry_removal
from snap_feat s
left join usage_feat u on u.hdp_shardid = s.hdp_shardid and u.skclientkey = s.skclientkey and u.medid = s.medid
     and u.device_naturalkey = s.device_naturalkey and u.month = s.month
left join latest_cost c on c.hdp_shardid = s.hdp_shardid and c.skclientkey = s.skclientkey and c.medid = s.medid
left join monthly_removals r on r.hdp_shardid = s.hdp_shardid and r.skclientkey = s.skclientkey
     and r.medid = s.medid and r.device_naturalkey = s.device_naturalkey and r.month = s.month
left join med_names mn on mn.skclientkey = s.skclientkey and mn.medid = s.medid
left join device_names dn on dn.skclientkey = s.skclientkey and dn.device_naturalkey = s.device_naturalkey""")

view("marked", """
select *, coalesce(meditemflag = 0, false) as non_drug,
       (lower(coalesce(medfullname, 'No med full name')) like '%insuli%'
        or lower(coalesce(medfullname, 'No med full name')) like '%patient%') as insuli_patient,
       coalesce(devicetypekey not in (1, 2), true) as anesth_minitry,
       coalesce(inventoryquantity > 1000, false) as outrng_inv
from panel""")

view("eligible", """
select * exclude (non_drug, insuli_patient, anesth_minitry, outrng_inv) from marked
where not (non_drug or insuli_patient or anesth_minitry or outrng_inv)""")

view("removal_panel", "select * from eligible where any_expiry_removal")

view("hseg", """
select l_suppkey as tile, (l_orderkey * 8 + l_linenumber) * 1000000 + l_partkey as id,
       cast(l_orderkey % 1000 as double) as x1, cast(l_orderkey % 1000 as double) + q as x2,
       cast(l_partkey % 200 as double) as y, l_linenumber as ln
from (select l_orderkey, l_linenumber, l_partkey, l_suppkey, max(l_quantity) as q from lineitem
      group by l_orderkey, l_linenumber, l_partkey, l_suppkey)""")

view("vseg", """
select o_custkey % (select count(*) from supplier) as tile, o_orderkey as id,
       cast(o_orderkey % 1000 as double) as x, cast(o_custkey % 200 as double) as y1,
       cast(o_custkey % 200 as double) + 1 + o_orderkey % 30 as y2
from orders""")

view("seg_a", "select tile, id, x as x1, y1, x + id % 3 as x2, y2 from vseg")

view("seg_b", "select tile, id, x1, y as y1, x2, y + ln % 2 as y2 from hseg")

view("via", """
select user_id % (select count(*) from supplier) as tile, event_id as id, cast(event_id % 1000 as double) as x,
       cast((user_id * 7) % 200 as double) as y
from events""")

view("pixel", """
select vec_id as tile, cast(floor((i - 1) / 8) as integer) as r, cast((i - 1) % 8 as integer) as c,
       cast(floor(cast(embedding[i] as double) * 1000) as bigint) as v
from (select vec_id, embedding, generate_subscripts(embedding, 1) as i from embeddings)""")

_WORD = re.compile(r"[A-Za-z_][A-Za-z_0-9]*")


def _deps(sql: str) -> set[str]:
    return {w for w in _WORD.findall(sql) if w in VIEWS}


def with_views(body: str, extra: dict[str, str] | None = None) -> str:
    """``WITH <needed views> <body>``; ``extra`` adds query-local views."""
    allv = dict(VIEWS)
    order = list(ORDER)
    if extra:
        for k, v in extra.items():
            allv[k] = v
            order.append(k)
    need: set[str] = set()
    stack = [w for w in _WORD.findall(body) if w in allv]
    while stack:
        v = stack.pop()
        if v in need:
            continue
        need.add(v)
        stack.extend(w for w in _WORD.findall(allv[v]) if w in allv and w != v)
    # materialized: each view is planned and computed once, however many others read it
    ctes = [f"{v} as materialized ({allv[v]})" for v in order if v in need]
    if not ctes:
        return body
    head = body.lstrip()
    # a body's own list of CTEs is appended to the views'
    for own in ("with recursive", "with"):
        if head.lower().startswith(own):
            return own + " " + ",\n".join(ctes) + ",\n" + head[len(own):]
    return "with " + ",\n".join(ctes) + "\n" + body
