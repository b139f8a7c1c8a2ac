"""Time-bounded look-back over event tables.

Events are merged per key (and day) before they meet the cohort, so no operator
joins all cohort rows of a key with all its events.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardlens.functions.numeric import is_integral, ratio
from wardlens.functions.times import day_diff, on_days
from wardlens.operators.cohort import keep_cohort_keys


def prior_events(
    events: DataFrame,
    *,
    ts: str,
    as_of: datetime,
    first_day: int = -367,
    last_day: int = -2,
    where: Column | None = None,
) -> DataFrame:
    """Events on the calendar days ``first_day``..``last_day`` from ``as_of``."""
    test = on_days(events, ts, as_of, first_day, last_day)
    return events.where(test if where is None else test & where)


def count_per_key(events: DataFrame, key: str, item: str, name: str) -> DataFrame:
    """Non-null ``item`` values per key, repeats included."""
    return events.groupBy(key).agg(F.count(item).alias(name))


def times_copies(
    feature: DataFrame, copies: DataFrame, key: str, columns: Sequence[str]
) -> DataFrame:
    """One-row-per-key ``feature`` with ``columns`` multiplied by the key's ``copies``.

    Keys outside the cohort drop out.
    """
    scaled = {name: (F.col(name) * F.col("copies")).alias(name) for name in columns}
    return feature.join(copies, key).select(
        *[scaled.get(name, F.col(name)) for name in feature.columns]
    )


def total_and_items(
    prior: DataFrame,
    amounts: DataFrame,
    *,
    key: str,
    item: str,
    amount: str,
    total_name: str,
    items_name: str,
    keys: DataFrame | None = None,
) -> DataFrame:
    """Sum of ``amount`` over a key's prior items, and the number of distinct items.

    An item without an amount still counts; a key without amounts has no sum. ``keys``
    restricts the keys.
    """
    items = prior.groupBy(key, item).agg(F.count(F.lit(1)).alias("item_rows"))
    if keys is not None:
        items = keep_cohort_keys(items, keys, key)
    # Sums over the amount rows themselves: an inner join can broadcast either side.
    totals = (
        items.join(amounts.select(item, amount), item)
        .groupBy(key)
        .agg(F.sum(F.col(amount) * F.col("item_rows")).alias(total_name))
    )
    counted = items.groupBy(key).agg(F.count(item).alias(items_name))
    return counted.join(totals, key, "left")


def total_and_mean(
    prior: DataFrame,
    amounts: DataFrame,
    *,
    key: str,
    item: str,
    amount: str,
    total_name: str,
    mean_name: str,
    copies: DataFrame | None = None,
) -> DataFrame:
    """Sum of ``amount`` over a key's prior items, and that sum per distinct item.

    With ``copies`` the sum is taken once per cohort row, before the division, while
    items stay distinct.
    """
    integral = is_integral(amounts.schema[amount].dataType)
    per_key = total_and_items(
        prior,
        amounts,
        key=key,
        item=item,
        amount=amount,
        total_name="total",
        items_name="items",
        keys=copies,
    )
    if copies is not None:
        per_key = times_copies(per_key, copies, key, ["total"])
    zero = F.lit(0)
    return per_key.select(
        key,
        F.coalesce("total", zero).alias(total_name),
        F.coalesce(ratio(F.col("total"), F.col("items"), integral), zero).alias(mean_name),
    )


def episode_days(
    prior: DataFrame,
    episodes: DataFrame,
    anchors: DataFrame,
    *,
    key: str,
    item: str,
    start: str,
    end: str,
    name: str,
    reach: int = 367,
    as_written: bool = True,
) -> DataFrame:
    """Days spent in episodes of a key's prior items, entered at most ``reach`` days
    before an admission day of the key.

    ``anchors`` holds ``admit_date`` and ``copies`` per key and day. The days are
    counted once per cohort row in reach; ``as_written`` counts that once more per
    cohort row of the key.
    """
    items = prior.groupBy(key, item).agg(F.count(F.lit(1)).alias("item_rows"))
    items = keep_cohort_keys(items, anchors, key)
    length = F.abs(day_diff(F.col(start), F.col(end)))
    # At most one row per key and calendar day before the anchors come in.
    daily = (
        items.join(episodes.select(item, start, end), item)
        .groupBy(key, F.to_date(start).alias("start_date"))
        .agg(F.sum(length * F.col("item_rows")).alias("days"))
    )
    per_key = (
        daily.join(anchors, key)
        .where(F.col("start_date") >= F.date_sub("admit_date", reach))
        .groupBy(key)
        .agg(F.sum(F.col("days") * F.col("copies")).alias(name))
    )
    if not as_written:
        return per_key
    totals = anchors.groupBy(key).agg(F.sum("copies").alias("copies"))
    return times_copies(per_key, totals, key, [name])


def within_hours(
    cohort: DataFrame,
    episodes: DataFrame,
    *,
    on: str,
    anchor: str,
    start: str,
    hours: int = 24,
) -> DataFrame:
    """Episodes entered from the anchor instant up to ``hours`` later, both ends included.

    ``on`` is the encounter: one cohort row meets its own episodes only. They meet by bins of
    ``hours``: an episode is in one bin, an anchor reaches at most two, and the episodes of an
    encounter with very many of them are spread over their bins.
    """
    limit = F.col(anchor) + F.expr(f"INTERVAL {int(hours)} HOURS")
    bin_ = next(name for name in ("bin", "_bin", "__bin") if name not in {*cohort.columns, *episodes.columns})
    reached = cohort.withColumn(bin_, F.explode(F.sequence(time_bin(F.col(anchor), hours), time_bin(limit, hours))))
    placed = episodes.withColumn(bin_, time_bin(F.col(start), hours))
    return reached.join(placed, [on, bin_]).where(F.col(start).between(F.col(anchor), limit)).drop(bin_)


def time_bin(moment: Column, hours: int) -> Column:
    """The number of the stretch of ``hours`` that ``moment`` is in."""
    origin = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    seconds = F.timestamp_diff("SECOND", origin, moment.cast("timestamp_ntz"))
    return F.floor(seconds / (3600 * int(hours)))
