"""Registry: query name -> (Spark callable, check SQL or None)."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidewell.sources.star import Star

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

MODULES = ("basics", "game", "bank", "charging", "live", "finance", "corpus", "monitoring", "metrics", "streams")


def query(name: str, oracle: str | None = None):
    """Register `fn(star) -> DataFrame` under a name, with the SQL that must give the same rows."""

    def register(fn: Callable[[Star], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = lambda spark, root: fn(Star(spark, root))
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return register


def load() -> tuple[dict[str, Query], dict[str, str]]:
    for module in MODULES:
        importlib.import_module(f"tidewell.checks.{module}")
    return QUERIES, ORACLES
