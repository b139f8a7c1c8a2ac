"""Diagnosis roll-up, first-match categories and the weighted index."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def parent_codes(
    diagnoses: DataFrame, codes: DataFrame, *, group: str, parent: str, code_id: str, code: str
) -> DataFrame:
    """Distinct (``group``, parent code) pairs over a diagnosis table.

    Diagnoses of one group share the parents of all of them. Taking the distinct
    pairs before any diagnosis joins back keeps a large group from being paired
    with itself.
    """
    coded = codes.where(F.col(code).isNotNull()).select(
        F.col(code_id).alias(parent), F.col(code).alias("parent_code")
    )
    return diagnoses.select(group, parent).join(coded, parent).select(group, "parent_code").distinct()


def rollup_to_parent(
    seen: DataFrame, diagnoses: DataFrame, parents: DataFrame, *, code_id: str, group: str
) -> DataFrame:
    """Seen diagnoses with the parent codes of their group; columns of ``seen`` stay.

    Diagnoses meet the parents of their group first, so that what patients have joins once,
    on the diagnosis, and never on a group many diagnoses share.
    """
    return seen.distinct().join(diagnoses.join(parents, group), code_id)


def first_match(mapping: DataFrame) -> DataFrame:
    """One (code, category) per code: the category of lowest ``priority`` that lists it."""
    return mapping.groupBy("code").agg(F.min_by("category", "priority").alias("category"))


def categorize(rows: DataFrame, categories: DataFrame, code: str) -> DataFrame:
    """Every row with the ``category`` of its code, null where none lists it."""
    side = categories.select(F.col("code").alias(code), "category")
    return rows.join(side, code, "left")


def weigh(rows: DataFrame, weights: DataFrame) -> DataFrame:
    """Every row with the ``weight`` of its category; no category or weight counts 0."""
    weight = F.coalesce(F.col("weight"), F.lit(0)).alias("weight")
    return rows.join(weights, "category", "left").select(
        *[F.col(name) for name in rows.columns], weight
    )


def weighted_index(rows: DataFrame, key: str, name: str, where: Column | None = None) -> DataFrame:
    """Sum of ``weight`` per key."""
    kept = rows if where is None else rows.where(where)
    return kept.groupBy(key).agg(F.sum("weight").alias(name))
