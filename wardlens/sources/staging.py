"""Intermediate tables in the shared folder of the cluster.

A staged table cuts lineage, survives the loss of executors, is computed once
however often it is read, and has a known size, so that Spark's broadcast threshold
decides on real bytes.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from functools import cache

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder ``spark.checkpoint.dir`` names; a scratch folder in local mode only."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    local = spark.conf.get("spark.master", "").startswith("local")
    if folder and folder.startswith("file:") and not local:
        raise ValueError(f"{folder} in spark.checkpoint.dir is a folder of one machine")
    if folder:
        return folder.rstrip("/")
    if not local:
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    return _local_folder(spark.sparkContext.applicationId)


@cache
def _local_folder(application: str) -> str:
    return tempfile.mkdtemp(prefix=f"wardlens-{application}-")


class Stage:
    """Writes tables under one run folder of the shared folder and reads them back.

    The folder belongs to whoever makes the stage. As a context manager it removes the folder
    at the end, also after an error; results that read staged tables must be written before::

        with Stage(spark) as stage:
            risk_report(tables, options, stage).write.parquet(path)
    """

    def __init__(self, spark: SparkSession, folder: str | None = None):
        self.spark = spark
        self.folder = f"{folder or shared_folder(spark)}/run-{uuid.uuid4().hex}"

    def __enter__(self) -> Stage:
        return self

    def __exit__(self, *error) -> None:
        self.remove()

    def remove(self) -> None:
        """Delete all staged tables."""
        context = self.spark.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(self.folder)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.folder}/{name}"
        df.write.mode("error").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def keep_all(self, frames: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
        """Stage independent tables at the same time."""
        with ThreadPoolExecutor(len(frames)) as pool:
            kept = {name: pool.submit(self.keep, df, name) for name, df in frames.items()}
            return {name: future.result() for name, future in kept.items()}
