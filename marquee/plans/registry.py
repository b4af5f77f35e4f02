"""Query registry: every operator is exposed as a runnable query.

A query is a callable ``(spark, sf_dir) -> DataFrame``.  When an
equivalent ANSI SQL text exists it is registered with it, so the same
result can be recomputed by an independent engine (DuckDB) over the same
parquet tables.  ``kind`` records the check level: ``Q`` (oracle SQL),
``R`` (rows-only; property tests in ``tests/``).
"""

from __future__ import annotations

import importlib
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from marquee.sources.tables import Tables

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    name: str
    fn: QueryFn
    oracle: str | None
    group: str


_REGISTRY: dict[str, Entry] = {}

PLAN_MODULES = (
    "marquee.plans.catalog",
    "marquee.plans.relational",
    "marquee.plans.joins",
    "marquee.plans.aggregates",
    "marquee.plans.windows",
    "marquee.plans.scalars",
    "marquee.plans.timeseries",
    "marquee.plans.udfs",
    "marquee.plans.graph",
    "marquee.plans.streams",
    "marquee.plans.io",
    "marquee.plans.ml",
    "marquee.plans.frames",
)


def query(name: str, oracle: str | None = None):
    """Register ``fn(t: Tables) -> DataFrame`` under ``name``."""

    def deco(fn):
        if name in _REGISTRY:
            raise ValueError(f"duplicate query {name}")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Tables(spark, sf_dir))

        run.__name__ = f"q_{name}"
        run.__doc__ = fn.__doc__
        _REGISTRY[name] = Entry(name, run, oracle.strip() if oracle else None,
                                fn.__module__.rsplit(".", 1)[-1])
        return fn

    return deco


def load_all() -> dict[str, Entry]:
    for m in PLAN_MODULES:
        importlib.import_module(m)
    return dict(_REGISTRY)


def queries() -> dict[str, QueryFn]:
    return {k: e.fn for k, e in load_all().items()}


def oracles() -> dict[str, str]:
    return {k: e.oracle for k, e in load_all().items() if e.oracle}
