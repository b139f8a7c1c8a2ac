"""State that goes on from day to day against the whole run of every day."""

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from wardlens.operators import exposure, sliding
from wardlens.sources.tables import complete_days, save_day
from workload.drugs import bought_days, therapy_by_day
from workload.history import totals_by_day
from workload.retail import AS_OF, Retail

FOLDER = "/root/testdata/sf0.001"
ONE = timedelta(days=1)
NAMES = {"key": "key", "drug": "drug", "ordered": "ordered", "flags": ["a", "b"]}


def given(count=900, start=date(2024, 1, 1)):
    draw = random.Random(3)
    rows = []
    for _ in range(count):
        key = "hot" if draw.random() < 1 / 3 else draw.choice(["k1", "k2", None])
        ordered = start + timedelta(days=draw.randrange(70))
        day = ordered + timedelta(days=draw.randrange(-3, 90))
        drug = draw.choice(["x", "y", None, ""])
        rows.append((key, ordered, day, drug, draw.random() < 0.5, draw.random() < 0.02))
    return [*rows, ("k1", None, start, "x", True, True), ("k1", start, None, "x", True, True)]


def brute(rows, flag, first, last):
    pairs = {}
    for row in rows:
        if row[1] and row[2] and first <= row[1] <= last:
            pairs.setdefault(row[0], set())
            if row[flag]:
                pairs[row[0]].add((row[2], row[3] or ""))
    return {key: len(of) or None for key, of in pairs.items()}


SCHEMA = "key string, ordered date, day date, drug string, a boolean, b boolean"


@pytest.mark.parametrize("start", [date(2024, 1, 1), date(1969, 12, 1)])
def test_counts_of_merged_states(spark, start):
    rows = given(start=start)
    df = spark.createDataFrame(rows, SCHEMA)
    # Parts that overlap: merging takes rows any number of times.
    parts = [df.where("a"), df.where("not a or b"), df.where("key = 'hot' or key is null")]
    states = [sliding.therapy_state(part, day="day", **NAMES) for part in parts]
    state = sliding.merge_therapy(states, **NAMES)
    for first, last in ((start, start + 69 * ONE), (start + 20 * ONE, start + 40 * ONE)):
        counts = sliding.therapy_counts(
            state, key="key", drug="drug", ordered="ordered", flags={"a": "n_a", "b": "n_b"}, first=first, last=last
        )
        found = counts.collect()
        assert {r.key: r.n_a for r in found} == brute(rows, 4, first, last)
        assert {r.key: r.n_b for r in found} == brute(rows, 5, first, last)


def test_every_bit_of_a_block(spark):
    rows = [("k", date(1970, 1, 1) + i * ONE, date(1970, 1, 1) + i * ONE, "x", True, False) for i in range(-70, 140)]
    state = sliding.therapy_state(spark.createDataFrame(rows, SCHEMA), day="day", **NAMES)
    counts = sliding.therapy_counts(state, key="key", drug="drug", ordered="ordered", flags={"a": "n", "b": "none"})
    assert [tuple(r) for r in counts.collect()] == [("k", 210, None)]
    empty = sliding.therapy_state(spark.createDataFrame([], SCHEMA), day="day", **NAMES)
    assert empty.count() == 0


def full_therapy(rows, last, reach, ordered="ordered"):
    first = None if reach is None else last - timedelta(days=reach)
    inside = rows.where(sliding.within(ordered, first, last))
    whole = exposure.days_of_therapy(inside, key="o_custkey", day="day", drug="drug", flags={"given": "n"})
    return {r.o_custkey: r.n for r in whole.collect()}


@pytest.mark.parametrize(("ordered", "reach"), [("ordered", 366), ("day", None)])
def test_a_month_of_therapy_day_by_day(spark, tmp_path, ordered, reach):
    """Windows of order days, as q17, and of days of exposure without a start, as q19."""
    r = Retail(spark, FOLDER)
    rows = r.stage.keep(bought_days(r), "bought")
    if ordered == "day":
        rows = rows.withColumn("shipped", F.col("day"))
        ordered = "shipped"
    last = AS_OF.date() - ONE
    path = f"{tmp_path}/therapy"
    state = therapy_by_day(r, path, rows, last, steps=30, ordered=ordered, reach=reach)
    assert len(complete_days(spark, path)) == 31
    for back in (0, 11, 23):
        day = last - back * ONE
        state = spark.read.parquet(f"{path}/as_of={day}")
        counts = sliding.therapy_counts(
            state, key="o_custkey", drug="drug", ordered=ordered, flags={"given": "n"}
        )
        assert {c.o_custkey: c.n for c in counts.collect()} == full_therapy(rows, day, reach, ordered)


def test_a_month_of_totals_day_by_day(spark, tmp_path):
    draw = random.Random(9)
    rows = []
    for i in range(1500):
        key = "hot" if draw.random() < 1 / 3 else f"k{draw.randrange(9)}"
        amount = None if draw.random() < 0.1 else draw.randrange(10**6) / 1000
        rows.append((key, date(1997, 10, 1) + draw.randrange(460) * ONE, None if i % 9 == 0 else i, amount))
    events = spark.createDataFrame(rows, "o_custkey string, day date, item int, amount double")
    daily = sliding.day_totals(events, keys=["o_custkey"], day="day", counts=["item"], sums=["amount"])
    r = Retail(spark, FOLDER)
    daily = r.stage.keep(daily, "daily")
    last = date(1998, 12, 30)
    path = f"{tmp_path}/totals"
    totals_by_day(r, path, daily, last, ["o_custkey"], ["item", "amount"], steps=30)
    for back in (0, 9, 30):
        day = last - back * ONE
        expected = {}
        for key, at, item, amount in rows:
            if day - 336 * ONE <= at <= day:
                n, items, total = expected.get(key, (0, 0, 0))
                expected[key] = (n + 1, items + (item is not None), total + round((amount or 0) * 1000))
        found = spark.read.parquet(f"{path}/as_of={day}").collect()
        assert {f.o_custkey: (f.rows, f.item, int(f.amount * 1000)) for f in found} == expected


def test_a_key_goes_when_its_last_row_leaves(spark):
    schema = "key string, day date, rows long, n long"
    daily = spark.createDataFrame([("a", date(2024, 1, 1), 2, 0), ("b", date(2024, 1, 2), 1, 1)], schema)
    given = {"keys": ["key"], "names": ["n"]}
    window = sliding.window_totals(daily, day="day", **given)
    after = sliding.slide_totals(window, daily.limit(0), daily.where("key = 'a'"), **given)
    assert [tuple(r) for r in after.collect()] == [("b", 1, 1)]


def test_a_killed_or_repeated_day_starts_from_the_same_state(spark, tmp_path):
    path, seen = f"{tmp_path}/state", []

    def step(before, since):
        seen.append(since)
        first = spark.createDataFrame([("k", 1)], "key string, n int")
        return first if before is None else before.withColumn("n", F.col("n") + 1)

    day = date(2024, 2, 1)
    sliding.roll(spark, path, day, step)
    save_day(spark.range(3), path, day + ONE)
    (tmp_path / "state" / f"as_of={day + ONE}" / "_SUCCESS").unlink()
    for _ in range(2):
        assert [tuple(r) for r in sliding.roll(spark, path, day + ONE, step).collect()] == [("k", 2)]
    assert sliding.roll(spark, path, day + 4 * ONE, step).first().n == 3
    assert seen == [None, day, day, day + ONE]


def test_plans_combine_before_they_shuffle(spark):
    df = spark.createDataFrame(given(), SCHEMA)
    state = sliding.therapy_state(df, day="day", **NAMES)
    plan = sliding.therapy_counts(
        state, key="key", drug="drug", ordered="ordered", flags={"a": "n"}
    )._jdf.queryExecution().executedPlan().toString()
    assert "partial_bit_or" in plan and "Join" not in plan and "Python" not in plan


def test_timestamps_need_a_day_of_their_own(spark):
    rows = [("k", datetime(2024, 1, 1, 23, 59), "x", True)] * 2 + [("k", datetime(2024, 1, 2), "x", True)]
    df = spark.createDataFrame(rows, "key string, at timestamp_ntz, drug string, a boolean")
    df = df.withColumns({"day": F.to_date("at"), "ordered": F.to_date("at")})
    state = sliding.therapy_state(df, key="key", day="day", drug="drug", ordered="ordered", flags=["a"])
    counts = sliding.therapy_counts(state, key="key", drug="drug", ordered="ordered", flags={"a": "n"})
    assert counts.first().n == 2
