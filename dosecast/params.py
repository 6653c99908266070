"""All tunable values in one frozen dataclass, with the reference defaults."""

from __future__ import annotations

from dataclasses import dataclass


def month_index(year: int, month: int) -> int:
    """Month index used everywhere: year*12 + month - 1."""
    return year * 12 + month - 1


@dataclass(frozen=True)
class Params:
    # Fixed values that must equal the reference's for the same results.
    inv_cutoff: float = 1000.0          # inventory above this is excluded
    rmvl_cutoff: float = 1000.0         # removal quantities above this are ignored
    prediction_cutoff: float = 50.0     # fixed cap of the "less conservative" estimate
    baseline_pct: float = 0.45          # dashboard rule: 45 % of inventory
    baseline_days: int = 120            # ... when the EED is within 120 days
    group_days: int = 90                # group rule distance to EED
    freq_limits: tuple = ((2, 3.0), (3, 2.5), (4, 2.3), (5, 2.0))
    recency_months: tuple = ((2, 4), (3, 5), (4, 5), (5, 5))
    own_model_min: int = 5              # pairs with more removal months get their own model
    pool_min: int = 2                   # pools for k = pool_min .. own_model_min
    min_pair_count: int = 1             # training pairs need count > this
    huber_epsilon: float = 1.01
    huber_alpha: float = 1e-4
    huber_max_iter: int = 20_000
    ridge_alpha: float = 0.1
    margin_percent: float = 0.0
    name_keys: tuple = ("insuli", "patient")
    device_types: tuple = (1, 2)
    features: tuple = ("usage100", "inventoryquantity", "dist_eed",
                       "max_par_level", "standardstockwithindispensingdeviceflag")
    # Windows of the driver fixture: training 1996-03 .. 1997-02, test 1997-03.
    train_start: int = month_index(1996, 3)
    window_months: int = 12
    # Profile of a pair with one removal month: 1 (script) or 0 (notebook).
    single_month_frequency: float = 1.0
    # Rows of a model that one task holds: larger groups are dealt into chunks, whose sums are added up.
    rows_per_chunk: int = 100_000

    @property
    def test_month(self) -> int:
        return self.train_start + self.window_months

    @property
    def train_end(self) -> int:
        return self.train_start + self.window_months - 1


DEFAULT = Params()
