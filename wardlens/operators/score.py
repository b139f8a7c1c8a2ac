"""Linear predictors and logistic percentages from versioned models."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardlens.functions.numeric import logistic_pct, nearest, whole

CASTS = {"whole": whole, "nearest": nearest}


@dataclass(frozen=True)
class Term:
    """Coefficient times a feature, the feature cut (``whole``) or rounded (``nearest``)."""

    feature: str
    coefficient: str
    cast: str = "whole"


@dataclass(frozen=True)
class ScoreModel:
    version: str
    intercept: str
    terms: tuple[Term, ...]

    def numbers(self) -> list[str]:
        """The intercept and the coefficients."""
        return [self.intercept, *(term.coefficient for term in self.terms)]


def linear_score(model: ScoreModel) -> Column:
    """Exact decimal sum of the intercept and the weighted features; null if one is null.

    It has as many places as the finest coefficient, four at least.
    """
    total = F.lit(Decimal(model.intercept))
    for term in model.terms:
        total = total + F.lit(Decimal(term.coefficient)) * CASTS[term.cast](F.col(term.feature))
    places = max(4, *(-Decimal(number).as_tuple().exponent for number in model.numbers()))
    return total.cast(f"decimal({14 + places},{places})")


def score(rows: DataFrame, model: ScoreModel, *, score_name: str, pct_name: str) -> DataFrame:
    """Rows with the linear predictor and its logistic percentage."""
    scored = rows.withColumn(score_name, linear_score(model))
    return scored.withColumn(pct_name, logistic_pct(F.col(score_name)))


def score_versions(
    rows: DataFrame, models: Sequence[ScoreModel], *, score_name: str, pct_name: str
) -> DataFrame:
    """Every row once per model, in a single pass over the rows."""
    versions = F.array(
        *[
            F.struct(F.lit(m.version).alias("model_version"), linear_score(m).alias(score_name))
            for m in models
        ]
    )
    return (
        rows.withColumn("scored", F.explode(versions))
        .select(*rows.columns, "scored.*")
        .withColumn(pct_name, logistic_pct(F.col(score_name)))
    )
