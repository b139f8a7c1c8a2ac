"""Named queries and, where SQL can say the same, their oracle text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from workload.retail import Retail

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    """Register a function of the retail tables under ``name``."""

    def register(function: Callable[[Retail], DataFrame]) -> Callable[[Retail], DataFrame]:
        QUERIES[name] = lambda spark, folder: function(Retail(spark, folder))
        if oracle is not None:
            ORACLES[name] = oracle
        return function

    return register
