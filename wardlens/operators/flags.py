"""Yes/no features from code lists, code ranges, value sets, episodes and registries."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardlens.operators.prefilter import reduce_by_ids

OPEN_END = "9999-12-31"


#: From so many ranges on, they are searched in a table instead of tested one by one.
SEARCHED = 16


def merged_ranges(ranges: Sequence[tuple[str, str]]) -> list[tuple[str, str]]:
    """The same text ranges in order, those that overlap or touch as one, empty ones gone."""
    merged: list[tuple[str, str]] = []
    for low, high in sorted(pair for pair in ranges if pair[0] <= pair[1]):
        if merged and low <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(high, merged[-1][1]))
        else:
            merged.append((low, high))
    return merged


def range_holding(code: Column, ranges: Sequence[tuple[str, str]]) -> Column:
    """True where ``code`` lies in one of ``ranges`` (in order and apart), by binary search.

    The bounds are two constant arrays; the place of the last range that begins at or before
    the code is found by halving, so an expression of fixed size does for any number.
    """
    lows, highs = (F.from_json(F.lit(json.dumps(list(side))), "array<string>") for side in zip(*ranges, strict=True))
    halves = [1 << bit for bit in reversed(range((len(ranges) - 1).bit_length()))]

    def step(place: Column, half: Column) -> Column:
        ahead = place + half
        return F.when((ahead < len(ranges)) & (F.get(lows, ahead) <= code), ahead).otherwise(place)

    place = F.aggregate(F.array(*map(F.lit, halves)), F.lit(0), step)
    # The outermost bounds go to the scan as a filter.
    return code.between(ranges[0][0], max(high for _, high in ranges)) & (code <= F.get(highs, place))


def code_in(
    code: Column, codes: Sequence[str] = (), ranges: Sequence[tuple[str, str]] = ()
) -> Column:
    """True where ``code`` is listed or lies in a text range, both ends included."""
    tests = [code.isin(list(codes))] if codes else []
    merged = merged_ranges(ranges)
    if len(merged) >= SEARCHED:
        tests.append(range_holding(code, merged))
    else:
        tests += [code.between(low, high) for low, high in merged]
    return reduce(or_, tests, F.lit(False)) if len(tests) != 1 else tests[0]


def stack_flags(sets: Mapping[str, DataFrame], *keys: str) -> DataFrame:
    """Merge named sets into one row per ``keys`` with a boolean column per set."""
    stacked = None
    for name, members in sets.items():
        marks = [F.lit(other == name).alias(other) for other in sets]
        rows = members.select(*keys, *marks)
        stacked = rows if stacked is None else stacked.union(rows)
    return stacked.groupBy(*keys).agg(*[F.max(name).alias(name) for name in sets])


def active_flags(
    conditions: DataFrame,
    coded: DataFrame,
    anchors: DataFrame,
    *,
    key: str,
    code_id: str,
    noted: str,
    ended: str,
    flags: Sequence[str],
    noted_days: int = 2,
    ended_days: int = 367,
    admissions: DataFrame | None = None,
) -> DataFrame:
    """Cohort keys with a coded condition that was active before an admission.

    ``coded`` has one row per condition code of interest with a boolean column for
    each of ``flags`` (see :func:`stack_flags`); the result has 1 or null for each. A
    condition counts when noted at least ``noted_days`` before the admission and ended
    not earlier than ``ended_days`` before it, or never.

    Columns with a time of day are compared as instants with ``admissions``, the distinct
    (key, admitted) of the cohort: the first admission late enough after the noted instant
    decides (see :func:`next_admission`). For calendar dates, per key and noted date the latest end decides, and per key and admission day the
    first admission does: dates sit on midnights, so the first admission of a day
    meets both bounds whenever any of that day's does. Both sides of the join are
    thereby bounded by the calendar, however many rows one key has.
    """
    kinds = {conditions.schema[name].dataType for name in (noted, ended)}
    if kinds != {T.DateType()}:
        if admissions is None:
            raise ValueError(f"{noted} or {ended} has a time of day: admissions are needed")
        return _active_by_instant(
            conditions, coded, admissions, key, code_id, noted, ended, flags, noted_days, ended_days
        )
    open_end = F.lit(OPEN_END).cast("date")
    end = F.coalesce(F.to_date(ended), open_end)
    spans = (
        conditions.join(coded.select(code_id, *flags), code_id)
        .groupBy(key, F.to_date(noted).alias("noted_on"))
        .agg(*[F.max(F.when(F.col(flag), end)).alias(flag) for flag in flags])
        .join(anchors.select(key), key, "left_semi")
    )
    admitted = F.col("first_admitted").cast("timestamp_ntz")

    def reaches(last: Column) -> Column:
        # An open end has no latest admission; date_add past year 9999 is avoided.
        latest = F.when(last < open_end, F.date_add(last, ended_days)).cast("timestamp_ntz")
        return last.isNotNull() & (latest.isNull() | (admitted <= latest))

    earliest = F.date_add("noted_on", noted_days).cast("timestamp_ntz")
    found = (
        spans.join(anchors, key)
        .where(admitted >= earliest)
        .groupBy(key)
        .agg(*[F.max(F.when(reaches(F.col(flag)), 1)).alias(flag) for flag in flags])
    )
    return found.where(reduce(or_, (F.col(flag) == 1 for flag in flags)))


def next_admission(
    spans: DataFrame, admissions: DataFrame, key: str, due: str, *columns: str
) -> DataFrame:
    """``key``, ``columns`` and ``next_admitted``: the first admission at or after ``due``, if any.

    Spans and admissions of a key never meet as pairs: both are put in one order, by key and
    day, and each span takes the admission carried along from behind it. What comes after a
    day's end is worked out on one row per key and day, so the rows of one key are spread
    over its days.
    """
    admitted = F.col("admitted").cast("timestamp_ntz")
    none = F.lit(None).cast("timestamp_ntz")
    asked = spans.select(key, F.col(due).alias("due_at"), none.alias("next_admitted"), F.lit(True).alias("is_span"), *columns)
    blank = [F.lit(None).cast(spans.schema[name].dataType).alias(name) for name in columns]
    given = admissions.select(key, admitted.alias("due_at"), admitted.alias("next_admitted"), F.lit(False).alias("is_span"), *blank)
    both = asked.unionByName(given).where("due_at is not null").withColumn("due_day", F.to_date("due_at"))
    days = both.groupBy(key, "due_day").agg(F.min("next_admitted").alias("next_admitted"))
    later = Window.partitionBy(key).orderBy(F.col("due_day").desc()).rowsBetween(Window.unboundedPreceding, -1)
    # A day's end stands for all admissions after it.
    end = F.date_add("due_day", 1).cast("timestamp_ntz")
    ends = days.select(key, end.alias("due_at"), F.min("next_admitted").over(later).alias("next_admitted"), F.lit(False).alias("is_span"), *blank, "due_day")
    order = Window.partitionBy(key, "due_day").orderBy(F.col("due_at").desc(), "is_span")
    carried = F.min("next_admitted").over(order.rowsBetween(Window.unboundedPreceding, 0))
    found = both.unionByName(ends.where("next_admitted is not null")).withColumn("next_admitted", carried)
    return found.where("is_span and next_admitted is not null").select(key, *columns, "next_admitted")


def _active_by_instant(
    conditions: DataFrame,
    coded: DataFrame,
    admissions: DataFrame,
    key: str,
    code_id: str,
    noted: str,
    ended: str,
    flags: Sequence[str],
    noted_days: int,
    ended_days: int,
) -> DataFrame:
    open_end = F.lit(f"{OPEN_END} 00:00:00").cast("timestamp_ntz")
    end = F.coalesce(F.col(ended).cast("timestamp_ntz"), open_end)
    spans = (
        conditions.join(coded.select(code_id, *flags), code_id)
        .groupBy(key, F.col(noted).cast("timestamp_ntz").alias("noted"))
        .agg(*[F.max(F.when(F.col(flag), end)).alias(flag) for flag in flags])
        .join(admissions.select(key).distinct(), key, "left_semi")
    )
    due = F.col("noted") + F.expr(f"INTERVAL {int(noted_days)} DAYS")
    first = next_admission(spans.withColumn("due", due), admissions, key, "due", *flags)
    reach = F.expr(f"INTERVAL {int(ended_days)} DAYS")

    def reaches(last: Column) -> Column:
        return last.isNotNull() & ((last >= open_end) | (F.col("next_admitted") - reach <= last))

    found = first.groupBy(key).agg(
        *[F.max(F.when(reaches(F.col(flag)), 1)).alias(flag) for flag in flags]
    )
    return found.where(reduce(or_, (F.col(flag) == 1 for flag in flags)))


def composite_episodes(
    episodes: DataFrame, stays: DataFrame, *, on: Sequence[str]
) -> DataFrame:
    """Episodes whose stay, matched on every column of ``on``, is among ``stays``."""
    return episodes.join(stays.select(*on), list(on), "left_semi")


def code_case_flag(
    rows: DataFrame, codes: DataFrame, *, code: str, name: str
) -> DataFrame:
    """Every row with 'YES' or 'NO' for membership of ``code`` in the ``codes`` table."""
    listed = codes.select(code).distinct().withColumn("listed", F.lit(True))
    flag = F.when(F.col("listed"), "YES").otherwise("NO")
    return rows.join(listed, code, "left").withColumn(name, flag).drop("listed")


def registry_keys(
    registry: DataFrame,
    *,
    key: str,
    kind: str,
    kind_is: str,
    status: str,
    status_not: Sequence[str],
) -> DataFrame:
    """Keys registered under a kind, entries of certain or unknown status left out."""
    test = (F.col(kind) == kind_is) & ~F.col(status).isin(list(status_not))
    return registry.where(test).select(key).distinct()


def positive_cultures(
    orders: DataFrame,
    specimens: DataFrame,
    results: DataFrame,
    result_lines: DataFrame,
    result_values: DataFrame,
    cultures: DataFrame,
    organisms: DataFrame,
    keep: Callable[[DataFrame, str], DataFrame] | None = None,
) -> DataFrame:
    """Laboratory orders that grew one of ``organisms``, by result and organism.

    Goes from the orders, which a cohort has few of, to their results and on to lines,
    cultures and organisms; ``result_values`` must hold the accepted components only.
    ``keep`` stages orders and results, so that the larger tables join by their real size, and filters those by the staged ids
    where these are too many to broadcast.
    """
    staged = keep is not None
    keep = keep or (lambda df, name: df)
    orders = keep(orders.select("patient_id", "order_id").distinct(), "culture-orders")
    if staged:
        results = reduce_by_ids(results, "order_id", orders.select("order_id"))
    found = results.join(orders.select("order_id").distinct(), "order_id")
    found = keep(found.select("order_id", "result_id"), "culture-results")
    if staged:
        result_lines = reduce_by_ids(result_lines, "result_id", found.select("result_id"))
        result_values = reduce_by_ids(result_values, "order_id", found.select("order_id"))
    grown = (
        found.join(result_lines, "result_id")
        .join(cultures, ["result_id", "line"])
        .join(organisms, "organism_id")
    )
    valued = grown.join(
        result_values.select("order_id", "component_id"),
        ["order_id", "component_id"],
        "left_semi",
    )
    return (
        orders.join(valued, "order_id")
        .join(specimens, "order_id")
        .select(
            "patient_id",
            "order_id",
            "taken_at",
            "result_id",
            "organism_id",
            "record_type",
            "organism",
        )
        .distinct()
    )
