"""One back-test run of one window: panel -> pairs -> models -> test month -> rules.

All clients are one set of jobs, not a loop over pairs; ``backtest`` does the
same for all windows at once.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dosecast.operators import models as md
from dosecast.operators import panel as pn
from dosecast.operators import rules as ru
from dosecast.operators import windows as wn
from dosecast.operators.extract import PAIR
from dosecast.operators.features import FeatureSet
from dosecast.params import DEFAULT, Params
from dosecast.session import materialize
from dosecast.sources import fixtures as fx
from dosecast.sources.tables import Tables
from dosecast.functions.months import brand_no


class BackTest:
    def __init__(self, t: Tables, p: Params = DEFAULT, model: str = "LR", predictions: str = "model",
                 grouped: bool = True, features: FeatureSet | None = None):
        """``predictions='stand_in'`` replaces model scores by the fixture's
        deterministic stand-in so the rule stages can be checked exactly;
        ``grouped=False`` gives every pair its own model (M9); ``features``
        replaces the numeric feature list of ``p``."""
        self.inputs = pn.Inputs.shared(t, p)
        self.features = features or FeatureSet(p.features)
        self.t, self.p, self.model, self.predictions, self.grouped = t, self.features.params(p), model, predictions, grouped

    @cached_property
    def panel(self) -> DataFrame:
        return pn.build_panel(self.inputs)

    @cached_property
    def eligible(self) -> DataFrame:
        return self.inputs.eligible

    @cached_property
    def removal_rows(self) -> DataFrame:
        return self.features.add(pn.removal_panel(self.eligible))

    @cached_property
    def pairs(self) -> DataFrame:
        p = self.p
        return wn.training_pairs(self.removal_rows, p.train_start, p.window_months, p.min_pair_count)

    @cached_property
    def assignment(self) -> DataFrame:
        return wn.model_assignment(self.pairs, self.p, grouped=self.grouped)

    @cached_property
    def train(self) -> DataFrame:
        p = self.p
        return wn.training_rows(self.removal_rows, self.assignment, p.train_start, p.window_months, p)

    @cached_property
    def scaler(self) -> DataFrame:
        return wn.scaler(self.train, self.p)

    @cached_property
    def train_scaled(self) -> DataFrame:
        return wn.apply_scaler(self.train, self.scaler, self.p)

    @cached_property
    def models(self) -> DataFrame:
        # one row for each model: fitted once, read by every branch that scores
        return materialize(md.fit_models(self.train_scaled, self.p, self.model), "models")

    @cached_property
    def test(self) -> DataFrame:
        p = self.p
        return ru.test_features(self.removal_rows, self.features.add(self.inputs.snap), self.inputs.usage, self.assignment,
                                p.test_month, p, self.features.names)

    @cached_property
    def scored(self) -> DataFrame:
        x = wn.apply_scaler(self.test, self.scaler, self.p)
        if self.predictions == "stand_in":
            return x.withColumn("y_predict", fx.stand_in_prediction(F.col("device_naturalkey"),
                                                                    brand_no("medid"), F.col("month")))
        return materialize(md.score(x, self.models, self.p), "scored")

    @cached_property
    def cutoff(self) -> DataFrame:
        p = self.p
        return wn.prediction_cutoff(self.inputs.removals, p.train_start, p.window_months, p.margin_percent)

    def result(self, pair_cap: bool = True) -> DataFrame:
        return ru.result_table(self.scored, self.p, self.cutoff if pair_cap else None)

    @cached_property
    def profile(self) -> DataFrame:
        return wn.training_profile(self.train, self.p.train_start, self.p.single_month_frequency)

    @cached_property
    def group_result(self) -> DataFrame:
        p = self.p
        return ru.group_rule(self.profile, self.result(True), p.train_start, p.test_month, p)

    @cached_property
    def all_pairs(self) -> DataFrame:
        p = self.p
        # the reference counts every eligible row of the window here, not only removal months
        pairs0 = wn.training_pairs(self.eligible, p.train_start, p.window_months, 0)
        return ru.all_pairs_test(self.eligible, pairs0, p.test_month)

    @cached_property
    def one_zero(self) -> DataFrame:
        return ru.one_zero_rule(self.all_pairs, self.p)

    @cached_property
    def final(self) -> DataFrame:
        base = self.one_zero.select(*PAIR, *ru.OVERLAY_COLS)
        upd = self.group_result.select(*PAIR, *ru.OVERLAY_COLS)
        return ru.overlay(base, upd)
