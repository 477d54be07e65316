"""Registry of queries: one per operator ID of the blueprint.

Every entry is a callable ``(spark, sf_dir) -> DataFrame`` that reads the
driver's tables, loads them into silver once (``plans.load``: the first query
that asks for a table writes it, later ones read it) and applies one operator
over the WHOLE tables; most have an independent SQL statement
(``plans.oracle_sql``) the driver runs in DuckDB to check the results.
"""

from __future__ import annotations

import weakref
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerlight.plans.config import TESTDATA
from ledgerlight.plans import load, silver as silver_plan
from ledgerlight.sources import testdata

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(key: str, sql: str | None = None):
    def deco(fn):
        QUERIES[key] = fn
        if sql is not None:
            ORACLES[key] = sql
        return fn
    return deco


def staging(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return testdata.staging(spark, sf_dir)


_KEPT: "weakref.WeakKeyDictionary[SparkSession, dict]" = weakref.WeakKeyDictionary()


def silver(spark: SparkSession, sf_dir: str, cfg=TESTDATA) -> silver_plan.Silver:
    """The kept silver tables of the folder ``sf_dir``; changed input files are loaded anew."""
    root = load.kept_root(spark, sf_dir, testdata.source_paths(sf_dir), cfg)
    kept = _KEPT.setdefault(spark, {})
    if root not in kept:
        testdata.forget(spark, sf_dir)
        kept[root] = load.KeptSilver(spark, staging(spark, sf_dir), cfg, root)
    return kept[root]


def load_all() -> None:
    """Import the modules that register queries."""
    from ledgerlight.plans import queries_gold, queries_quality, queries_silver, queries_measures  # noqa: F401
