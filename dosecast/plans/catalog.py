"""Registry of named queries: Spark builder + output spec + oracle SQL.

``register(name, spec, sql)`` decorates a builder ``(Tables) -> DataFrame``.
Builders may write shared tables (the extracts, iterative rounds); the caller triggers the rest.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import DataFrame, SparkSession

from dosecast.plans.oracle_views import with_views
from dosecast.plans.spec import final_sql, finalize
from dosecast.session import ship_package
from dosecast.sources.tables import Tables


@dataclass
class Entry:
    build: Callable[[Tables], DataFrame]
    spec: str
    sql: str | None
    extra_views: dict | None = None


REGISTRY: dict[str, Entry] = {}


def register(name: str, spec: str, sql: str | None = None, views: dict | None = None):
    def deco(fn):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Entry(fn, " ".join(spec.split()), sql, views)
        return fn
    return deco


def _load_all() -> None:
    # Importing the modules registers their queries.
    from dosecast.plans import q_extract, q_panel, q_model, q_rules, q_windows  # noqa: F401
    from dosecast.plans import q_geometry, q_pixels, q_audit, q_reports  # noqa: F401


def run(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    _load_all()
    e = REGISTRY[name]
    ship_package(spark)
    return finalize(e.build(Tables(spark, sf_dir)), e.spec)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load_all()
    return {n: (lambda spark, sf_dir, _n=n: run(_n, spark, sf_dir)) for n in REGISTRY}


def oracle_sql() -> dict[str, str]:
    _load_all()
    return {n: final_sql(with_views(e.sql, e.extra_views), e.spec)
            for n, e in REGISTRY.items() if e.sql is not None}
