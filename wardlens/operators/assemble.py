"""One row per cohort encounter out of many per-key features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def stack_features(features: Sequence[DataFrame], key: str) -> DataFrame:
    """Merge one-row-per-key features into a single wide row per key.

    The features are stacked and collapsed by one shuffle instead of joined one
    after the other. A key a feature lacks has null in its columns.
    """
    stacked = features[0]
    for feature in features[1:]:
        stacked = stacked.unionByName(feature, allowMissingColumns=True)
    names = [name for name in stacked.columns if name != key]
    return stacked.groupBy(key).agg(*[F.max(name).alias(name) for name in names])


def yes_no(test: Column) -> Column:
    """'YES' where ``test`` holds, else 'NO'; unknown is 'NO'."""
    return F.when(test, "YES").otherwise("NO")


def one_zero(test: Column) -> Column:
    """1 where ``test`` holds, else 0; unknown is 0."""
    return F.when(test, 1).otherwise(0)


def or_zero(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0)).alias(name)


def log_or_zero(count: Column) -> Column:
    """Natural logarithm of a count, 0 where there is none."""
    return F.coalesce(F.ln(count), F.lit(0.0))


def flag_values(rows: DataFrame, keys: Sequence[str], test: Column, name: str) -> DataFrame:
    """Per ``keys`` whether ``test`` holds for some row (``name_yes``) and fails for some (``name_no``)."""
    holds = F.coalesce(test, F.lit(False))
    return rows.groupBy(*keys).agg(
        F.max(holds).alias(f"{name}_yes"), F.max(~holds).alias(f"{name}_no")
    )


def each_flag_value(rows: DataFrame, name: str, one_row: bool) -> DataFrame:
    """Turn :func:`flag_values` columns into a 'YES'/'NO' column.

    A key with both kinds of rows gives two output rows, or 'YES' alone with ``one_row``.
    """
    yes, no = F.col(f"{name}_yes"), F.col(f"{name}_no")
    if one_row:
        value = yes_no(yes)
    else:
        both = F.array(F.lit("YES"), F.lit("NO"))
        single = F.array(yes_no(yes))
        value = F.explode(F.when(yes & no, both).otherwise(single))
    return rows.withColumn(name, value).drop(f"{name}_yes", f"{name}_no")
