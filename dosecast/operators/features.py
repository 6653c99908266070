"""Feature sets as data.

A feature set names numeric columns and categorical ones with their levels.
``add`` makes a 0/1 column of each level, so training and test rows always have
the same columns: dummies taken from the data could add or drop one between
them.  Everything after it (training rows, scaler, models, scores) works on
``columns``, whatever the set.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dosecast.params import DEFAULT, Params


@dataclass(frozen=True)
class FeatureSet:
    numeric: tuple[str, ...]
    categorical: tuple[tuple[str, tuple[int, ...]], ...] = ()

    @property
    def columns(self) -> tuple[str, ...]:
        """Names of the model's columns."""
        return self.numeric + tuple(f"{c}_{v}" for c, levels in self.categorical for v in levels)

    @property
    def names(self) -> tuple[str, ...]:
        """The categorical columns themselves, which rules read."""
        return tuple(c for c, _ in self.categorical)

    def add(self, df: DataFrame) -> DataFrame:
        """``df`` with a column for each level: 1 where the value is that level, else 0 (null and unknown values: 0)."""
        return df.withColumns({f"{c}_{v}": F.coalesce((F.col(c) == v).cast("double"), F.lit(0.0))
                               for c, levels in self.categorical for v in levels})

    def params(self, p: Params = DEFAULT) -> Params:
        return replace(p, features=self.columns)


# The feature list with the distance to the EED as a category.
BY_CATEGORY = FeatureSet(("usage100", "inventoryquantity", "max_par_level"),
                         (("dist_eed_120", (0, 1, 2)), ("standardstockwithindispensingdeviceflag", (0, 1))))
