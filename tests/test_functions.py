from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from wardlens.functions import numeric, text, times


@pytest.fixture
def value(spark):
    """Evaluate one column expression."""
    return lambda column: spark.range(1).select(column.alias("v")).first().v


def moment(text_value):
    return F.expr(f"timestamp_ntz'{text_value}'")


def test_days_are_midnights_crossed(value):
    late, early = moment("2024-01-01 23:00:00"), moment("2024-01-02 01:00:00")
    assert value(times.day_diff(late, early)) == 1
    assert value(times.day_diff(early, late)) == -1
    assert value(times.day_diff(moment("2024-01-01 00:00:00"), late)) == 0


@pytest.mark.parametrize(
    ("birth", "age"),
    [("1960-02-23", 64), ("1990-02-24", 33), ("2024-02-23", 0), ("2023-02-23", 0), (None, None)],
)
def test_age_in_years_of_365_25_days(value, birth, age):
    as_of = datetime(2024, 2, 23, 8, 30)
    assert value(times.age_years(F.lit(birth).cast("date"), as_of)) == age


def test_day_window_is_half_open(rows):
    moments = [
        datetime(2024, 2, 20, 23, 59, 59),
        datetime(2024, 2, 21),
        datetime(2024, 2, 22, 23, 59, 59),
        datetime(2024, 2, 23),
        None,
    ]
    df = rows("t timestamp_ntz", [(m,) for m in moments])
    as_of = datetime(2024, 2, 23, 8, 30)
    kept = df.where(times.on_days(df, "t", as_of, -2, -1)).collect()
    assert [r.t for r in kept] == moments[1:3]
    assert df.where(times.on_days(df, "t", as_of, -1)).count() == 2
    assert df.where(times.on_days(df, "t", as_of, None, -1)).count() == 3


def test_day_window_on_dates(rows):
    df = rows("d date", [(date(2024, 2, n),) for n in (20, 21, 22, 23)])
    kept = df.where(times.on_days(df, "d", datetime(2024, 2, 23, 8), -2, -1)).collect()
    assert [r.d.day for r in kept] == [21, 22]


def test_day_start_compared_with_an_instant(rows):
    df = rows("t timestamp_ntz", [(datetime(2024, 2, n, 23, 0),) for n in (20, 21, 22)])
    instant = datetime(2024, 2, 21, 8, 30)
    assert [r.t.day for r in df.where(times.day_not_before(df, "t", instant)).collect()] == [22]
    assert [r.t.day for r in df.where(times.day_not_after(df, "t", instant)).collect()] == [20, 21]
    at_midnight = datetime(2024, 2, 21)
    kept = df.where(times.day_not_before(df, "t", at_midnight)).collect()
    assert [r.t.day for r in kept] == [21, 22]


def test_written_days(value):
    at = moment("2024-02-03 04:05:06")
    assert value(times.compact_day(at)) == "20240203"
    assert value(times.short_day(at)) == "02/03/24"
    assert value(times.compact_minute(at)) == "20240203 04:05"


@pytest.mark.parametrize(
    ("name", "trimmed", "as_is"),
    [
        ("cefazolin 1g", "CEFAZOLIN", "CEFAZOLIN"),
        ("aspirin", "ASPIRIN", "ASPIRIN"),
        (" pen G", "PEN", ""),
        ("", "", ""),
        (None, None, None),
    ],
)
def test_first_token(value, name, trimmed, as_is):
    column = F.lit(name).cast("string")
    assert value(text.first_token(column)) == trimmed
    assert value(text.first_token(column, trim=False)) == as_is


def test_name_matching_ignores_case(value):
    name = F.lit("Pen g Benzathine")
    assert value(text.contains_any(name, ["xyz", "pen G"]))
    assert not value(text.contains_any(name, ["penicillin"]))
    assert value(text.starts_with_any(name, ["PEN"]))
    assert not value(text.starts_with_any(name, ["BENZ"]))
    missing = F.lit(None).cast("string")
    assert value(text.contains_any(missing, ["a"])) is None
    assert value(~text.starts_with_any(missing, ["a"])) is None


def test_joined_skips_nulls(value):
    missing = F.lit(None).cast("string")
    assert value(text.joined(F.lit("01/02/24"), missing)) == "01/02/24"


def test_ratio(value):
    assert value(numeric.ratio(F.lit(7), F.lit(2), integral=True)) == 3
    assert value(numeric.ratio(F.lit(-7), F.lit(2), integral=True)) == -3
    assert value(numeric.ratio(F.lit(7.0), F.lit(2), integral=False)) == 3.5
    assert value(numeric.ratio(F.lit(7.0), F.lit(0), integral=False)) is None
    assert value(numeric.ratio(F.lit(7), F.lit(0), integral=True)) is None


def test_casts(value):
    assert value(numeric.whole(F.lit(-1.9))) == -1
    assert value(numeric.whole(F.lit(7.9))) == 7
    assert value(numeric.nearest(F.lit(1.609))) == 2
    assert value(numeric.nearest(F.lit(0.5))) == 1
    assert value(numeric.nearest(F.lit(-0.5))) == -1


def test_logistic_stays_finite(value):
    assert value(numeric.logistic_pct(F.lit(Decimal("-6.3708")))) == 0.17
    assert value(numeric.logistic_pct(F.lit(0))) == 50.0
    assert value(numeric.logistic_pct(F.lit(800))) == 100.0
    assert value(numeric.logistic_pct(F.lit(-800))) == 0.0
    assert value(numeric.logistic_pct(F.lit(None).cast("double"))) is None
