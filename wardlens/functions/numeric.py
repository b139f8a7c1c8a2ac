"""Numeric rules the features and scores depend on."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def is_integral(kind: T.DataType) -> bool:
    return isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))


def ratio(total: Column, count: Column, integral: bool) -> Column:
    """``total / count``; an integral total keeps integer division, cut toward zero."""
    if integral:
        return F.when(count != 0, F.call_function("div", total, count))
    return F.try_divide(total, count)


def whole(value: Column) -> Column:
    """Cut toward zero."""
    return value.cast("int")


def nearest(value: Column) -> Column:
    """Nearest whole number, halves away from zero."""
    return value.cast(T.DecimalType(18, 0))


def logistic_pct(score: Column, digits: int = 2) -> Column:
    """Logistic of ``score`` as a percentage.

    Written as 1 / (1 + e^-s), which stays finite for large scores.
    """
    return F.round(F.lit(100.0) / (F.lit(1.0) + F.exp(-score.cast("double"))), digits)
