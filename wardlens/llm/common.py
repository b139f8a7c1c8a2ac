"""What several operators of this folder share."""

from __future__ import annotations

import itertools
import tempfile
import zipfile
from collections.abc import Callable, Iterable, Iterator
from functools import cache
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlens.sources.staging import Stage

#: Fixed value: what separates words, as a class of Java and Python patterns.
BLANKS = r"[\x20\x09-\x0D]"
#: Text handled at once by a Python task, in bytes (a longer text alone).
SLICE_BYTES = 4_000_000


def ship(spark: SparkSession) -> None:
    """Give the Python workers this package, once per application."""
    _ship(spark.sparkContext.applicationId)


@cache
def _ship(application: str) -> None:
    package = Path(__file__).resolve().parents[1]
    path = Path(tempfile.mkdtemp(prefix="package-")) / "wardlens_package.zip"
    with zipfile.ZipFile(path, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    SparkSession.active().sparkContext.addPyFile(str(path))


def by_arrow(df: DataFrame, function: Callable, schema: str) -> DataFrame:
    """mapInArrow with the package at hand."""
    ship(df.sparkSession)
    return df.mapInArrow(function, schema)


def slices(
    batches: Iterable[pa.RecordBatch], text: str = "text", size: int = SLICE_BYTES
) -> Iterator[tuple[pa.RecordBatch, pa.StringArray]]:
    """Parts of the batches with about ``size`` bytes of text, and their texts (null: empty)."""
    for batch in batches:
        texts = pc.fill_null(batch.column(text).cast(pa.string()), "")
        if not len(texts):
            continue
        sizes = pc.binary_length(texts).to_numpy().astype(np.int64)
        cuts = np.flatnonzero(np.diff(np.cumsum(sizes) // size)) + 1
        for start, end in itertools.pairwise([0, *cuts.tolist(), len(texts)]):
            yield batch.slice(start, end - start), texts.slice(start, end - start)
            pa.default_memory_pool().release_unused()


def smallest_chances(df: DataFrame, chance: Column, size: int, *ties: str) -> DataFrame:
    """At most ``size`` rows, those with the smallest ``chance`` (a 64-bit hash).

    Rows that are far from being among them are left out before any are put in order, so
    that about twice as many meet, whatever the table's size. Where chances repeat, too few
    may pass; then the bound is doubled until enough do.
    """
    least = chance.bitwiseAND(F.lit((1 << 63) - 1))
    share = (2 * size + 1000) / max(df.count(), 1)
    while share < 1:
        near = df.where(least <= F.lit(int((1 << 63) * share)))
        if near.count() >= size:
            df = near
            break
        share *= 2
    return df.orderBy(least, *ties).limit(size)


def repeats(counts: np.ndarray, size: int) -> np.ndarray:
    """Places of rows that stand for ``counts`` equal ones each, the first ``size`` of them all."""
    # No count is over ``size`` then, and with at most ``size`` rows no sum is too large.
    ends = np.minimum(np.cumsum(np.minimum(counts, size)), size)
    return np.repeat(np.arange(len(counts)), np.diff(ends, prepend=0))


def stage(spark: SparkSession) -> Stage:
    """A new run folder in the folder of spark.checkpoint.dir."""
    return Stage(spark)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it as long as ``df`` has such a column."""
    taken = {column.lower() for column in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def add_running_total(df: DataFrame, values: str, to: str, block: int = 64) -> DataFrame:
    """``df`` with ``to``: for the counts in array ``values``, the sums before each of them.

    Sums over blocks come first, so that long arrays need no sum over all before. What is
    used more than once is a column of its own, so that Spark works it out once a row.
    """
    blocks, sums = f"{to}_blocks", f"{to}_sums"

    def total(part: Column) -> Column:
        return F.aggregate(part, F.lit(0).cast("long"), lambda a, x: a + x)

    numbers = F.sequence(F.lit(0), F.floor((F.size(values) - 1) / block).cast("int"))
    cut = F.transform(numbers, lambda b: F.slice(values, b * block + 1, F.lit(block)))
    empty = F.array().cast("array<array<bigint>>")
    df = df.withColumn(blocks, F.when(F.size(values) > 0, cut).otherwise(empty))
    df = df.withColumn(sums, F.transform(blocks, total))
    starts = F.transform(sums, lambda _, i: total(F.slice(sums, F.lit(1), i)))
    parts = F.zip_with(
        blocks,
        starts,
        lambda part, start: F.transform(
            part, lambda _, i: start + total(F.slice(part, F.lit(1), i))
        ),
    )
    return df.withColumn(to, F.flatten(parts)).drop(blocks, sums)
