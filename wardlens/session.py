"""A Spark session with the settings the operators are tuned for."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    # The report generates more classes than the default cache of 100 holds.
    "spark.sql.codegen.cache.maxEntries": "2000",
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def local_session(cores: int | str = "*", app: str = "wardlens", **settings: str) -> SparkSession:
    """A local session for tests and benchmarks; a cluster brings its own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    parallel = os.cpu_count() if cores == "*" else int(cores)
    values = {
        **SETTINGS,
        "spark.sql.shuffle.partitions": str(parallel),
        "spark.driver.memory": "8g",
        "spark.ui.showConsoleProgress": "false",
        **settings,
    }
    for name, value in values.items():
        builder = builder.config(name, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session
