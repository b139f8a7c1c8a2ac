"""Results by day: reruns replace their day, broken days do not count."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from wardlens.sources.tables import complete_days, read_days, save_day

FIRST, SECOND = date(2024, 2, 23), date(2024, 2, 24)


def result(spark, count):
    return spark.range(count).withColumn("score", F.col("id") * 2)


def test_a_rerun_replaces_its_day_only(spark, tmp_path):
    path = f"{tmp_path}/report"
    assert complete_days(spark, path) == []
    save_day(result(spark, 5), path, FIRST)
    save_day(result(spark, 7), path, SECOND)
    save_day(result(spark, 3), path, FIRST)
    assert complete_days(spark, path) == [FIRST, SECOND]
    counts = {row.as_of: row["count"] for row in read_days(spark, path).groupBy("as_of").count().collect()}
    assert counts == {FIRST: 3, SECOND: 7}
    assert read_days(spark, path, [SECOND]).count() == 7
    save_day(result(spark, 0), path, SECOND)
    assert read_days(spark, path, [SECOND]).count() == 0


def test_a_broken_day_is_left_out_and_replaced_by_the_next_run(spark, tmp_path):
    path = f"{tmp_path}/report"
    save_day(result(spark, 5), path, FIRST)
    broken = result(spark, 9).withColumn("score", F.raise_error(F.lit("killed")).cast("bigint"))
    save_day(result(spark, 4), path, SECOND)
    with pytest.raises(Exception, match="killed"):
        save_day(broken, path, SECOND)
    assert complete_days(spark, path) == [FIRST]
    assert read_days(spark, path).count() == 5
    with pytest.raises(FileNotFoundError, match="2024-02-24"):
        read_days(spark, path, [FIRST, SECOND])
    save_day(result(spark, 2), path, SECOND)
    assert read_days(spark, path).count() == 7


def test_nothing_to_read(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="any day"):
        read_days(spark, f"{tmp_path}/none")
