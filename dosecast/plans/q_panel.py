"""Panel queries: derived columns, the panel join, exclusions, statuses."""

from __future__ import annotations

from dosecast.operators import panel as pn
from dosecast.params import DEFAULT
from dosecast.plans.catalog import register
from dosecast.sources import fixtures as fx

P = DEFAULT
KEYS = "hdp_shardid:l skclientkey:l medid:s device_naturalkey:l month:l"

PANEL_SPEC = KEYS + """ inventoryquantity:d standardstockwithindispensingdeviceflag:l dist_eed:l dist_eed_120:l
dist_eed_90:l max_par_level:d min_par_level:d devicetypekey:l meditemflag:l isinactive:l avgdailyusage30:d
usage100:l unitcost:d transactionquantity:d actualbegincount:d medfullname:s dispensingdevicename:s
any_expiry_removal:b"""


def panel_of(t):
    return pn.build_panel(pn.Inputs.shared(t, P))


@register("derived_columns", KEYS + " dispensingdevicename:s avgdailyusage30:d usage100:l",
          "select * from usage_feat")
def q_derived(t):
    """P1 on usage: next-month feature month, truncated usage x 100."""
    from dosecast.operators import extract as ex
    return pn.usage_features(ex.monthly_usage(t))


@register("dist_eed", KEYS + " monthfirstday:dt earliestnextexpirationdate:dt dist_eed:l", """
select hdp_shardid, skclientkey, medid, device_naturalkey, month, monthfirstday, earliestnextexpirationdate,
       dist_eed from snap_feat""")
def q_dist_eed(t):
    """P2 (with P1's snapshot month)."""
    return pn.snap_features(fx.snap(t))


@register("eed_category", KEYS + " dist_eed:l dist_eed_120:l dist_eed_90:l",
          "select * from snap_feat")
def q_eed_category(t):
    """P3."""
    return pn.snap_features(fx.snap(t))


@register("panel", PANEL_SPEC, "select * from panel")
def q_panel(t):
    """J3 (+ J5: names joined on)."""
    return panel_of(t)


@register("exclusion_marks", KEYS + " non_drug:b insuli_patient:b anesth_minitry:b outrng_inv:b",
          "select * from marked")
def q_marks(t):
    """F8-F11 as marks (U4: column-wise, no positional concat)."""
    return pn.exclusion_marks(panel_of(t), P)


@register("eligible_panel", PANEL_SPEC, "select * from eligible")
def q_eligible(t):
    """F12."""
    return pn.eligible(panel_of(t), P)


@register("eligible_panel_strict", PANEL_SPEC, """
select * from eligible where meditemflag is not null and medfullname is not null and devicetypekey is not null
  and inventoryquantity is not null""")
def q_eligible_strict(t):
    """sequential null-dropping variant."""
    return pn.eligible(panel_of(t), P, nulls="drop")


@register("excluded_rows", KEYS + " non_drug:b insuli_patient:b anesth_minitry:b outrng_inv:b", """
select * from marked where non_drug or insuli_patient or anesth_minitry or outrng_inv""")
def q_excluded(t):
    """Audit rows removed by the exclusions."""
    return pn.excluded_rows(panel_of(t), P)


@register("removal_panel", PANEL_SPEC, "select * from removal_panel")
def q_removal_panel(t):
    """The preprocessing chain's removal-only panel."""
    return pn.removal_panel(pn.eligible(panel_of(t), P))


@register("latest_med_name", "skclientkey:l medid:s medfullname:s", "select * from med_names")
def q_med_names(t):
    """J6 for medicine names."""
    from dosecast.operators import extract as ex
    return pn.latest_med_name(ex.removal_tx(t))


@register("latest_device_name", "skclientkey:l device_naturalkey:l dispensingdevicename:s",
          "select * from device_names")
def q_device_names(t):
    """J6 for device names."""
    from dosecast.operators import extract as ex
    return pn.latest_device_name(ex.removal_tx(t))


# Snapshot columns are null where a removal month has no snapshot: nullable
# integers are emitted as doubles so both engines render them alike.
TXP_SPEC = KEYS + """ transactionquantity:d actualbegincount:d unitcost:d avgdailyusage30:d usage100:l
inventoryquantity:d standardstockwithindispensingdeviceflag:d dist_eed:d dist_eed_120:d dist_eed_90:d
max_par_level:d min_par_level:d devicetypekey:d meditemflag:d isinactive:d"""

TXP_VIEW = {"tx_panel": """
select r.hdp_shardid, r.skclientkey, r.medid, r.device_naturalkey, r.month, r.transactionquantity,
       r.actualbegincount, coalesce(c.unitcost, 0) as unitcost, u.avgdailyusage30,
       coalesce(u.usage100, 0) as usage100, s.inventoryquantity, s.standardstockwithindispensingdeviceflag,
       s.dist_eed, s.dist_eed_120, s.dist_eed_90, s.max_par_level, s.min_par_level, s.devicetypekey,
       s.meditemflag, s.isinactive
from monthly_removals r
left join latest_cost c on c.hdp_shardid = r.hdp_shardid and c.skclientkey = r.skclientkey and c.medid = r.medid
left join usage_feat u on u.hdp_shardid = r.hdp_shardid and u.skclientkey = r.skclientkey and u.medid = r.medid
     and u.device_naturalkey = r.device_naturalkey and u.month = r.month
left join snap_feat s on s.hdp_shardid = r.hdp_shardid and s.skclientkey = r.skclientkey and s.medid = r.medid
     and s.device_naturalkey = r.device_naturalkey and s.month = r.month"""}


@register("tx_panel", TXP_SPEC, "select * from tx_panel", TXP_VIEW)
def q_tx_panel(t):
    """Transaction-driven panel."""
    return pn.tx_panel(pn.Inputs.shared(t, P))


@register("drop_null_inv", TXP_SPEC, """
select * from tx_panel where hdp_shardid is not null and skclientkey is not null and medid is not null
  and device_naturalkey is not null and month is not null and usage100 is not null
  and inventoryquantity is not null and dist_eed is not null and standardstockwithindispensingdeviceflag is not null
  and transactionquantity is not null and actualbegincount is not null and dist_eed_120 is not null
  and unitcost is not null and max_par_level is not null and min_par_level is not null
  and devicetypekey is not null and meditemflag is not null""", TXP_VIEW)
def q_drop_null_inv(t):
    """F16: rows without nulls in the model columns."""
    return pn.drop_null_inv(pn.tx_panel(pn.Inputs.shared(t, P)))[0]


@register("null_inventory_report",
          "skclientkey:l medid:s device_naturalkey:l month:l transactionquantity:d inventoryquantity:d", """
select skclientkey, medid, device_naturalkey, month, transactionquantity, inventoryquantity
from tx_panel where inventoryquantity is null""", TXP_VIEW)
def q_null_inv_report(t):
    """F16: report of rows with a null inventory."""
    return pn.drop_null_inv(pn.tx_panel(pn.Inputs.shared(t, P)))[1]


LMS_VIEW = {"last_status": f"""
select hdp_shardid, skclientkey, medid, device_naturalkey, max(month) as last_month,
       arg_max(isinactive, month) as isinactive
from snap_feat where month between {P.train_start} and {P.train_end}
group by hdp_shardid, skclientkey, medid, device_naturalkey"""}


@register("last_month_status", "hdp_shardid:l skclientkey:l medid:s device_naturalkey:l last_month:l isinactive:l",
          "select * from last_status", LMS_VIEW)
def q_last_status(t):
    """Status in each pair's last training month."""
    return pn.last_month_status(pn.snap_features(fx.snap(t)), P.train_start, P.window_months)


@register("not_unloaded", TXP_SPEC + " last_isinactive:l", """
select p.*, s.isinactive as last_isinactive from tx_panel p
join last_status s on s.hdp_shardid = p.hdp_shardid and s.skclientkey = p.skclientkey and s.medid = p.medid
 and s.device_naturalkey = p.device_naturalkey
where s.isinactive <> 1""", {**TXP_VIEW, **LMS_VIEW})
def q_not_unloaded(t):
    """Transaction panel rows of pairs not unloaded in their last training month."""
    i = pn.Inputs.shared(t, P)
    return pn.not_unloaded(pn.tx_panel(i), i.snap, P.train_start, P.window_months)


@register("unloaded_pairs", "hdp_shardid:l skclientkey:l medid:s device_naturalkey:l last_month:l",
          "select * from last_status where isinactive = 1", LMS_VIEW)
def q_unloaded(t):
    """Pairs fully unloaded in their last training month (the complement of J8)."""
    return pn.unloaded_pairs(pn.snap_features(fx.snap(t)), P.train_start, P.window_months)
