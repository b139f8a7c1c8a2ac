"""Calendar windows and day arithmetic.

Every window is anchored on an explicit ``as_of`` and turned into a half-open
range on the raw column, with literals of the column's own type, so that the
range reaches the Parquet reader as a pushed filter.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def midnight(moment: datetime | date, days: int = 0) -> datetime:
    """00:00 of the day ``days`` after the day of ``moment``."""
    return datetime(moment.year, moment.month, moment.day) + timedelta(days=days)


def next_midnight(moment: datetime) -> datetime:
    """The first 00:00 that is not before ``moment``."""
    start = midnight(moment)
    return start if start == moment else start + timedelta(days=1)


def moment_literal(value: datetime, like: T.DataType) -> Column:
    """``value`` as a literal of type ``like`` (date, timestamp or timestamp_ntz)."""
    if isinstance(like, T.DateType):
        return F.lit(value.date())
    kind = "timestamp_ntz" if isinstance(like, T.TimestampNTZType) else "timestamp"
    return F.expr(f"{kind}'{value.isoformat(sep=' ')}'")


def on_days(
    df: DataFrame,
    column: str,
    as_of: datetime,
    first: int | None = None,
    last: int | None = None,
) -> Column:
    """True where the calendar day of ``column`` is ``first``..``last`` days from ``as_of``.

    Either end may be open. Both ends count.
    """
    like = df.schema[column].dataType
    test = F.lit(True)
    if first is not None:
        test = F.col(column) >= moment_literal(midnight(as_of, first), like)
    if last is not None:
        upper = F.col(column) < moment_literal(midnight(as_of, last + 1), like)
        test = upper if first is None else test & upper
    return test


def day_not_before(df: DataFrame, column: str, moment: datetime) -> Column:
    """True where 00:00 of ``column``'s day is at or after the instant ``moment``."""
    return F.col(column) >= moment_literal(next_midnight(moment), df.schema[column].dataType)


def day_not_after(df: DataFrame, column: str, moment: datetime) -> Column:
    """True where 00:00 of ``column``'s day is at or before the instant ``moment``."""
    return F.col(column) < moment_literal(midnight(moment, 1), df.schema[column].dataType)


def day_diff(start: Column, end: Column) -> Column:
    """Midnights crossed from ``start`` to ``end`` (23:00 to 01:00 is one day)."""
    return F.datediff(F.to_date(end), F.to_date(start))


def age_years(birth: Column, as_of: datetime) -> Column:
    """Whole years of 365.25 days between ``birth`` and the day of ``as_of``."""
    days = F.datediff(F.lit(as_of.date()), F.to_date(birth))
    return F.floor(days / F.lit(365.25)).cast("int")


def compact_day(moment: Column) -> Column:
    """The day written as yyyyMMdd."""
    return F.date_format(moment, "yyyyMMdd")


def short_day(moment: Column) -> Column:
    """The day written as MM/dd/yy."""
    return F.date_format(moment, "MM/dd/yy")


def compact_minute(moment: Column) -> Column:
    """Day and minute written as yyyyMMdd HH:mm."""
    return F.date_format(moment, "yyyyMMdd HH:mm")
