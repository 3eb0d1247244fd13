"""Name → query and name → SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from callops.plans.star import Star
from callops.session import tune

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None):
    """Register a function ``Star → DataFrame`` under its own name."""

    def register(build: Callable[[Star], DataFrame]):
        name = build.__name__
        QUERIES[name] = lambda spark, folder: build(Star(tune(spark), folder))
        if oracle is not None:
            ORACLES[name] = oracle
        return build

    return register
