"""Back-test over all clients and all training windows, from pairs to errors.

Every table carries ``train_start``; the test month of a window is
``train_start + window_months``.  Windows are never looped over: a removal row
is exploded into the windows that contain it (at most ``window_months``, bounded
by the parameter) and everything after that is an equi-join or a group-by whose
key includes the window, so one job covers all of them.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dosecast.functions.months import brand_no
from dosecast.operators import models as md
from dosecast.operators import panel as pn
from dosecast.operators import rules as ru
from dosecast.operators import windows as wn
from dosecast.operators.extract import PAIR, PAIR4
from dosecast.params import DEFAULT, Params
from dosecast.session import large, materialize, materialize_by
from dosecast.sources import fixtures as fx

WPAIR = [*PAIR, "train_start"]
WPAIR4 = [*PAIR4, "train_start"]


def window_test_features(rem: DataFrame, snap: DataFrame, usage: DataFrame, assign: DataFrame,
                         p: Params = DEFAULT) -> DataFrame:
    """P9 for every window: the pair's removal row of the window's test month, else its snapshot row with usage."""
    key = [*PAIR4, "month"]
    a = assign.select(*WPAIR4, "model_key", "months_w_removals", (F.col("train_start") + p.window_months).alias("month"))
    # One pass over the pairs: those with a removal row match no snapshot or usage row, as their ``_open`` is null.
    r = rem.select(*key, F.struct(*p.features, F.col("transactionquantity").alias("y")).alias("_r"))
    s = snap.select(*key, F.lit(1).alias("_open"), F.struct(*[f for f in p.features if f != "usage100"]).alias("_s"))
    u = usage.select(*key, F.lit(1).alias("_open"), "usage100")
    j = (a.join(large(r), key, "left").withColumn("_open", F.when(F.col("_r").isNull(), 1))
          .join(large(s), [*key, "_open"], "left").where(F.col("_r").isNotNull() | F.col("_s").isNotNull())
          .join(large(u), [*key, "_open"], "left"))
    removal = F.col("_r").isNotNull()
    feats = [F.when(removal, F.col(f"_r.{f}")).otherwise(F.coalesce("usage100", F.lit(0)) if f == "usage100" else F.col(f"_s.{f}"))
             .cast("double").alias(f) for f in p.features]
    return j.select("model_key", *WPAIR4, "month", "months_w_removals", *feats,
                    F.when(removal, F.col("_r.y")).otherwise(0.0).alias("y"), F.when(removal, "removal").otherwise("snapshot").alias("source"))


def window_cutoff(removals: DataFrame, windows: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """A7 for every window."""
    e = wn.window_rows(removals, windows, p.window_months)
    return (e.groupBy(*WPAIR).agg(F.max("transactionquantity").alias("max_removal"))
             .withColumn("prediction_cutoff", F.bround(F.col("max_removal") * (1 + p.margin_percent), 0)))


def months_before(rows: DataFrame, keys: list[str], months: int, flag=None):
    """Rows of a pair in the ``months`` months before the row's own (``flag``: only where it holds).

    The window of a pair holds one row for each month, so it is bounded by calendar time.
    """
    w = Window.partitionBy(*keys).orderBy("month").rangeBetween(-months, -1)
    one = F.lit(1) if flag is None else F.when(flag, 1)
    return rows.withColumn("count", F.count(one).over(w))


def window_all_pairs(elig: DataFrame, windows: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """P13 / J14 for every window: eligible rows of each test month with their training count (0 if none)."""
    c = months_before(elig, PAIR4, p.window_months)
    w = windows.select("skclientkey", "train_start", F.col("test_month").alias("month")).distinct()
    return c.join(F.broadcast(w), ["skclientkey", "month"]).fillna(0, subset=["transactionquantity"])


def window_flags(elig: DataFrame, windows: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """A10 for every window, attached to the panel: the windows in which the row's pair
    has at least two removal months, as a sorted list beside the panel's columns.

    One list column instead of one boolean column for each window: the number of windows
    is data, not schema.  A pair without such a window has an empty list.
    """
    e = wn.window_rows(elig.where(F.col("any_expiry_removal")).select(*PAIR, "month"), windows, p.window_months)
    two = e.groupBy(*WPAIR).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= 2)
    flags = two.groupBy(*PAIR).agg(F.sort_array(F.collect_list("train_start")).alias("two_or_more_windows"))
    none = F.array().cast("array<int>")
    return elig.join(large(flags), PAIR, "left").withColumn(
        "two_or_more_windows", F.coalesce(F.col("two_or_more_windows").cast("array<int>"), none))


def window_last_status(snap: DataFrame, windows: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """J7 for every window: each pair's snapshot status in its last month of the window.

    A row is its pair's last one in the windows that hold it and end before the pair's next row: for a
    pair with a row for each month that is one window, so rows are not put into all that hold them.
    """
    rows = snap.select(*PAIR4, "month", "isinactive").where(F.col("month").isNotNull())
    next_month = F.lead("month").over(Window.partitionBy(*PAIR4).orderBy("month"))
    rows = rows.withColumn("_next", next_month).withColumns({
        "_from": F.col("month") - (p.window_months - 1), "_to": F.least("month", F.col("_next") - p.window_months)})
    e = rows.where(F.col("_from") <= F.col("_to")).withColumn("train_start", F.explode(F.sequence("_from", "_to")))
    ws = windows.select("skclientkey", "train_start").distinct()
    return (e.join(F.broadcast(ws), ["skclientkey", "train_start"])   # clients x months
             .select(*WPAIR4, F.col("month").alias("last_month"), "isinactive"))


class WindowedBackTest:
    """The stages of a back-test for every client and window.

    ``inputs`` is a ``panel.Inputs`` (from the fixture or from given frames); its windows are taken where none are given.
    ``predictions='stand_in'`` replaces model scores by the fixture's formula.
    """

    def __init__(self, inputs: pn.Inputs, windows: DataFrame | None = None, p: Params = DEFAULT, model: str = "LR",
                 predictions: str = "model"):
        self.inputs, self.given, self.p, self.model, self.predictions = inputs, windows, p, model, predictions

    @property
    def windows(self) -> DataFrame:
        return self.inputs.windows if self.given is None else self.given

    @cached_property
    def eligible(self) -> DataFrame:
        return self.inputs.eligible

    @cached_property
    def removal_rows(self) -> DataFrame:
        return pn.removal_panel(self.eligible)

    @cached_property
    def train(self) -> DataFrame:
        # read by the scaler, the models, the profile and the training results; by pair like the rows it comes from
        rows = wn.all_window_training(self.removal_rows, self.windows, self.p)
        return materialize_by(rows, PAIR, "train", self.inputs.partitions)

    @cached_property
    def assignment(self) -> DataFrame:
        return self.train.select(*WPAIR4, "model_key", "months_w_removals").distinct()

    @cached_property
    def unscored(self) -> DataFrame:
        """J10 for every window: trained pairs without a test row (or without a model)."""
        return self.assignment.join(large(self.scored.select(*WPAIR4)), WPAIR4, "left_anti")

    @cached_property
    def pair_counts(self) -> DataFrame:
        """A21 and J10 for every window: trained pairs of a client, and those of them without an estimate."""
        seen = self.scored.select(*WPAIR4, F.lit(1).alias("_s"))
        return (self.assignment.join(large(seen), WPAIR4, "left").groupBy("skclientkey", "train_start")
                .agg(F.count(F.lit(1)).alias("modeled_pairs"), F.count_if(F.col("_s").isNull()).alias("unscored_pairs")))

    @cached_property
    def scaler(self) -> DataFrame:
        return large(wn.scaler(self.train, self.p))

    @cached_property
    def models(self) -> DataFrame:
        m = md.fit_models(wn.apply_scaler(self.train, self.scaler, self.p), self.p, self.model)
        return materialize(m, "models")   # one row for each model: fitted once, joined by several branches

    def _score(self, rows: DataFrame) -> DataFrame:
        x = wn.apply_scaler(rows, self.scaler, self.p)
        if self.predictions == "stand_in":
            return x.withColumn("y_predict", fx.stand_in_prediction(F.col("device_naturalkey"),
                                                                    brand_no("medid"), F.col("month")))
        return md.score(x, self.models, self.p)

    @cached_property
    def scored(self) -> DataFrame:
        test = window_test_features(self.removal_rows, self.inputs.snap, self.inputs.usage, self.assignment, self.p)
        return materialize(self._score(test), "scored")   # read with both caps, by the rules and by reports

    @cached_property
    def training_results(self) -> DataFrame:
        """P10, training side: the training rows scored, with the fixed cap."""
        return ru.result_table(self._score(self.train), self.p)

    def results(self, pair_cap: bool = True) -> DataFrame:
        """P10, test side."""
        cut = large(window_cutoff(self.inputs.removals, self.windows, self.p)) if pair_cap else None
        return ru.result_table(self.scored, self.p, cut)

    @cached_property
    def errors(self) -> DataFrame:
        """A12 for every client, test month and setting."""
        keys = ["skclientkey", "train_start", "is_pair_prediction_cutoff"]
        parts = [ru.error_summary(self.results(cap).withColumn(keys[-1], F.lit(cap)), keys) for cap in (True, False)]
        return (parts[0].unionByName(parts[1])
                .withColumn("test_month", F.col("train_start") + self.p.window_months)
                .withColumn("margin_percent", F.lit(self.p.margin_percent)))

    @cached_property
    def group_result(self) -> DataFrame:
        prof = wn.training_profile(self.train, F.col("train_start"), self.p.single_month_frequency, WPAIR)
        return ru.group_rule(prof, self.results(True), F.col("train_start"),
                             F.col("train_start") + self.p.window_months, self.p, WPAIR)

    @cached_property
    def final(self) -> DataFrame:
        """P16 for every window: the modelled pairs' estimates over the all-pair rule."""
        base = ru.one_zero_rule(window_all_pairs(self.eligible, self.windows, self.p), self.p)
        return ru.overlay(base.select(*WPAIR, *ru.OVERLAY_COLS), self.group_result.select(*WPAIR, *ru.OVERLAY_COLS),
                          WPAIR, scope=("train_start", "skclientkey"))
