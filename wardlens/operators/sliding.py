"""Features kept from day to day instead of read again from a year of events.

Two kinds of state, both one row per key and part, both written by day (``roll``):

* Days of therapy: bitmaps. A row holds, for a key, drug, order day and block of 64 calendar
  days, one bit per day with an exposure. States merge by bitwise or, which takes rows in any
  order and any number of times; rows whose order day has left the window expire.
* Totals: partial sums per key and day. The window's sums go on by adding the days that enter
  and subtracting the stored partial sums of the days that leave, so what is subtracted is
  what was added, even where events were corrected since. Sums are decimals: no drift.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlens.sources.tables import DAY_COLUMN, complete_days, read_days, save_day

#: Calendar days of one bitmap, the bits of a long.
BLOCK_DAYS = 64
SUM_TYPE = "decimal(38,6)"


def roll(
    spark: SparkSession,
    path: str,
    day: date,
    step: Callable[[DataFrame | None, date | None], DataFrame],
) -> DataFrame:
    """The state of ``day``, made by ``step`` from the last complete state before it.

    ``step`` gets that state and its day (None and None if there is none). Earlier states are
    left as they are, so a run that is killed or repeated starts again from the same state.
    """
    earlier = [done for done in complete_days(spark, path) if done < day]
    since = earlier[-1] if earlier else None
    before = read_days(spark, path, [since]).drop(DAY_COLUMN) if since else None
    save_day(step(before, since), path, day)
    return read_days(spark, path, [day]).drop(DAY_COLUMN)


# ---- days of therapy ------------------------------------------------------


def therapy_state(
    rows: DataFrame, *, key: str, day: str, drug: str, ordered: str, flags: Sequence[str]
) -> DataFrame:
    """Bitmaps of the exposure ``rows``: (key, drug, ordered, block), one mask per flag.

    ``day`` is the day of the exposure and ``ordered`` the one that windows go by, both dates.
    Rows without either are left out; a missing drug counts as the empty name.
    """
    number = F.unix_date(day)
    block = F.floor(number / BLOCK_DAYS).cast("int")
    # A shift by a column takes its count modulo 64, and so is right before 1970 as well.
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(number, F.lit(BLOCK_DAYS)))
    masks = [F.bit_or(F.when(F.col(flag), bit).otherwise(F.lit(0).cast("bigint"))).alias(flag) for flag in flags]
    known = rows.where(F.col(day).isNotNull() & F.col(ordered).isNotNull())
    named = known.withColumns({drug: F.coalesce(drug, F.lit("")), "block": block})
    return named.groupBy(key, drug, ordered, "block").agg(*masks)


def merge_therapy(
    states: Sequence[DataFrame], *, key: str, drug: str, ordered: str, flags: Sequence[str]
) -> DataFrame:
    """One state of several: masks of equal parts by bitwise or."""
    rows = reduce(DataFrame.unionByName, states)
    return rows.groupBy(key, drug, ordered, "block").agg(*[F.bit_or(flag).alias(flag) for flag in flags])


def within(day: str, first: date | None, last: date | None) -> Column:
    """True where ``day`` is from ``first`` to ``last``; either end may be open."""
    test = F.lit(True)
    if first is not None:
        test = test & (F.col(day) >= F.lit(first))
    return test if last is None else test & (F.col(day) <= F.lit(last))


def therapy_counts(
    state: DataFrame,
    *,
    key: str,
    drug: str,
    ordered: str,
    flags: Mapping[str, str],
    first: date | None = None,
    last: date | None = None,
) -> DataFrame:
    """Distinct (day, drug) pairs per key with an order day from ``first`` to ``last``.

    As :func:`days_of_therapy`: ``flags`` maps masks to counts, a count without a day is null.
    Masks meet per (key, drug, block) first, which spreads a key with very many of them.
    """
    parts = state.where(within(ordered, first, last)).groupBy(key, drug, "block")
    masks = parts.agg(*[F.bit_or(flag).alias(flag) for flag in flags])
    sums = {name: F.sum(F.bit_count(flag).cast("bigint")) for flag, name in flags.items()}
    counted = masks.groupBy(key).agg(*[F.when(total > 0, total).alias(name) for name, total in sums.items()])
    return counted


# ---- totals ---------------------------------------------------------------


def day_totals(
    events: DataFrame, *, keys: Sequence[str], day: str, counts: Sequence[str] = (), sums: Sequence[str] = ()
) -> DataFrame:
    """Partial sums per ``keys`` and ``day`` (a date): non-null values counted, values added."""
    counted = [F.count(name).alias(name) for name in counts]
    added = [F.coalesce(F.sum(F.col(name).cast("decimal(28,6)")), F.lit(0)).cast(SUM_TYPE).alias(name) for name in sums]
    return events.groupBy(*keys, day).agg(F.count(F.lit(1)).alias("rows"), *counted, *added)


def window_totals(
    daily: DataFrame,
    *,
    keys: Sequence[str],
    day: str,
    names: Sequence[str],
    first: date | None = None,
    last: date | None = None,
) -> DataFrame:
    """Sums of the partial sums from ``first`` to ``last``: a window's first state."""
    return _added(daily.where(within(day, first, last)), keys, names)


def slide_totals(
    window: DataFrame,
    entering: DataFrame,
    leaving: DataFrame,
    *,
    keys: Sequence[str],
    names: Sequence[str],
) -> DataFrame:
    """``window`` with the partial sums ``entering`` added and ``leaving`` subtracted.

    Keys whose last row left are gone. No join: what enters and leaves is added up with the
    sums so far, in one shuffle that combines on the map side.
    """
    values = ["rows", *names]
    less = leaving.select(*keys, *[(-F.col(name)).cast(leaving.schema[name].dataType).alias(name) for name in values])
    parts = [frame.select(*keys, *values) for frame in (window, entering)]
    return _added(reduce(DataFrame.unionByName, [*parts, less]), keys, names)


def _added(parts: DataFrame, keys: Sequence[str], names: Sequence[str]) -> DataFrame:
    sums = [
        F.sum(name).cast(parts.schema[name].dataType).alias(name) for name in ("rows", *names)
    ]
    return parts.groupBy(*keys).agg(*sums).where("rows > 0")
