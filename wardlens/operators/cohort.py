"""Choosing the cohort and describing its members."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardlens.functions.times import age_years, on_days


def select_cohort(
    encounters: DataFrame,
    *,
    as_of: datetime,
    encounter: str,
    admitted: str,
    first_day: int = -1,
    last_day: int = -1,
    where: Column | None = None,
) -> DataFrame:
    """Encounters admitted on the calendar days ``first_day``..``last_day`` from ``as_of``."""
    test = on_days(encounters, admitted, as_of, first_day, last_day)
    test = test & F.col(encounter).isNotNull()
    if where is not None:
        test = test & where
    return encounters.where(test)


def copies_per_key(cohort: DataFrame, key: str, per_patient: bool = False) -> DataFrame:
    """One row per cohort key with the number of its cohort rows as ``copies``.

    A feature counted once per cohort row is the key's own value times ``copies``,
    which needs no join of every cohort row with every event of the key.
    ``per_patient`` sets ``copies`` to one.
    """
    counted = cohort.groupBy(key).agg(F.count(F.lit(1)).alias("copies"))
    if per_patient:
        counted = counted.withColumn("copies", F.lit(1).cast("long"))
    return counted


def anchors_per_day(
    cohort: DataFrame, key: str, admitted: str, per_patient: bool = False
) -> DataFrame:
    """Per key and admission day: first admission instant and number of cohort rows.

    A key has at most as many rows as the cohort window has days. ``per_patient``
    keeps the earliest admission of each key only.
    """
    if per_patient:
        first = cohort.groupBy(key).agg(F.min(admitted).alias("first_admitted"))
        return first.select(
            key,
            F.to_date("first_admitted").alias("admit_date"),
            "first_admitted",
            F.lit(1).cast("long").alias("copies"),
        )
    return cohort.groupBy(key, F.to_date(admitted).alias("admit_date")).agg(
        F.min(admitted).alias("first_admitted"),
        F.count(F.lit(1)).alias("copies"),
    )


def keep_cohort_keys(reduced: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows of an aggregate whose ``key`` is in the cohort (``keys``: one row per key).

    Put after the aggregation on purpose: Catalyst moves this semi join below the
    aggregate when the size of ``keys`` allows a broadcast; otherwise the join sees
    rows already merged map-side, so a key holding much of the table stays cheap.
    """
    return reduced.join(keys.select(key), key, "left_semi")


@dataclass(frozen=True)
class Lookup:
    """A left lookup: fact column, table, its key, and {table column: output name}."""

    on: str
    table: DataFrame
    key: str
    columns: Mapping[str, str]


def enrich(fact: DataFrame, lookups: Sequence[Lookup]) -> DataFrame:
    """Left-join each lookup in turn; a later one may use a column an earlier one added."""
    for lookup in lookups:
        side = lookup.table.select(
            F.col(lookup.key).alias(lookup.on),
            *[F.col(source).alias(name) for source, name in lookup.columns.items()],
        )
        fact = fact.join(side, lookup.on, "left")
    return fact


def demographics(
    patients: DataFrame,
    *,
    birth: str,
    as_of: datetime,
    lookups: Sequence[Lookup] = (),
    age_name: str = "age",
) -> DataFrame:
    """Patients with their age on ``as_of`` and looked-up labels."""
    return enrich(patients.withColumn(age_name, age_years(F.col(birth), as_of)), lookups)
