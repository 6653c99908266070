"""Lazy access to the driver's parquet tables.

Each table is one parquet scan; Catalyst prunes columns and pushes filters
into it, so callers select what they need and nothing else is read.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLE_NAMES = ("region", "nation", "customer", "supplier", "part", "orders",
               "lineitem", "events", "documents", "embeddings", "pages",
               "benchmark", "labels", "conversations")


class Tables:
    """``t.lineitem`` -> DataFrame of ``{sf_dir}/lineitem.parquet``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._cache: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in TABLE_NAMES:
            raise AttributeError(name)
        if name not in self._cache:
            self._cache[name] = self.spark.read.parquet(os.path.join(self.sf_dir, f"{name}.parquet"))
        return self._cache[name]
