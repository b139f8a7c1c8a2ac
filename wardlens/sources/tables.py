"""Reading named tables and writing results."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession


def parquet_table(
    spark: SparkSession, folder: str, name: str, schema: str | None = None
) -> DataFrame:
    """The table ``name`` of a folder of ``<name>.parquet`` files."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(f"{folder}/{name}.parquet")


def catalog_table(spark: SparkSession, name: str, schema: str | None = None) -> DataFrame:
    """A table or view by name, ``schema`` being an optional ``catalog.schema`` prefix."""
    return spark.table(f"{schema}.{name}" if schema else name)


def save_result(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write a result as Parquet."""
    df.write.mode(mode).parquet(path)


#: The partition column of results kept by day, and the file Spark ends a written folder with.
DAY_COLUMN = "as_of"
COMPLETE = "_SUCCESS"


def save_day(df: DataFrame, path: str, day: date) -> None:
    """Write a result as the partition of ``day``, in the place of an earlier one.

    The old partition goes first and the marker comes last, so a run that is killed leaves a
    partition without marker, which :func:`read_days` leaves out and the next run replaces.
    """
    marked = df.write.mode("overwrite").option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true")
    marked.parquet(f"{path}/{DAY_COLUMN}={day.isoformat()}")


def complete_days(spark: SparkSession, path: str) -> list[date]:
    """The days whose partitions were written to their end."""
    context = spark.sparkContext
    paths = context._jvm.org.apache.hadoop.fs.Path
    root = paths(path)
    system = root.getFileSystem(context._jsc.hadoopConfiguration())
    if not system.exists(root):
        return []
    folders = [entry.getPath().getName() for entry in system.listStatus(root)]
    days = [name.partition("=")[2] for name in folders if name.startswith(f"{DAY_COLUMN}=")]
    done = [day for day in days if system.exists(paths(f"{path}/{DAY_COLUMN}={day}/{COMPLETE}"))]
    return sorted(date.fromisoformat(day) for day in done)


def read_days(spark: SparkSession, path: str, days: Sequence[date] | None = None) -> DataFrame:
    """The results of complete days (of ``days`` only, if given), with column ``as_of``.

    It is an error if one of ``days`` is not complete, or if no day is.
    """
    complete = complete_days(spark, path)
    wanted = complete if days is None else sorted(set(days))
    missing = [day.isoformat() for day in wanted if day not in complete]
    if missing or not wanted:
        raise FileNotFoundError(f"no complete result in {path} for {', '.join(missing) or 'any day'}")
    folders = [f"{path}/{DAY_COLUMN}={day.isoformat()}" for day in wanted]
    return spark.read.option("basePath", path).parquet(*folders)
