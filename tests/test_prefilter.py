"""The filter of staged ids: nothing lost, little else let through, in the scan stage."""

import pytest
from pyspark.sql import functions as F

from wardlens.operators import prefilter


@pytest.fixture
def no_broadcast(spark):
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    yield
    spark.conf.set(name, before)


@pytest.mark.parametrize("count", [1, 3000, 200_000])
def test_keeps_all_ids_and_few_others(spark, no_broadcast, count):
    ids = spark.range(count).select((F.col("id") * 7).alias("order_id"))
    rows = spark.range(400_000).select(F.col("id").cast("int").alias("order_id"))
    kept = prefilter.reduce_by_ids(rows, "order_id", ids)
    inside = (F.col("order_id") % 7 == 0) & (F.col("order_id") < 7 * count)
    expected = rows.where(inside).count()
    assert kept.where(inside).count() == expected
    others = rows.count() - expected
    assert kept.count() - expected <= 2 * prefilter.ERROR * others


def test_texts_nulls_and_empty_sides(spark, no_broadcast):
    ids = spark.createDataFrame([("a",), (None,), ("é" * 50,)], "key string")
    rows = spark.createDataFrame([("a",), (None,), ("é" * 50,), ("b",)], "key string")
    kept = {row.key for row in prefilter.reduce_by_ids(rows, "key", ids).collect()}
    assert {"a", "é" * 50} <= kept <= {"a", "é" * 50, "b"}
    assert prefilter.reduce_by_ids(rows, "key", ids.limit(0)).count() == 0
    assert prefilter.reduce_by_ids(rows.limit(0), "key", ids).count() == 0


def test_the_filter_is_in_the_scan_stage(spark, no_broadcast, tmp_path):
    spark.range(50_000).withColumnRenamed("id", "order_id").write.parquet(f"{tmp_path}/facts")
    spark.range(500).withColumnRenamed("id", "order_id").write.parquet(f"{tmp_path}/ids")
    facts, ids = (spark.read.parquet(f"{tmp_path}/{name}") for name in ("facts", "ids"))
    joined = prefilter.reduce_by_ids(facts, "order_id", ids).join(ids, "order_id")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("Exchange hashpartitioning") :]
    assert "xxhash64" in below and "Broadcast" not in plan
    assert "from_json" not in plan
    assert joined.count() == 500


def test_no_filter_where_it_would_not_help(spark):
    ids = spark.range(10).withColumnRenamed("id", "k")
    rows = spark.range(20).withColumnRenamed("id", "k")
    assert prefilter.reduce_by_ids(rows, "k", ids) is rows
    many = spark.range(1000).withColumnRenamed("id", "k")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1k")
    assert prefilter.reduce_by_ids(rows, "k", many, most_bits=512) is rows
    assert prefilter.reduce_by_ids(rows, "k", many) is not rows
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize(("text", "size"), [("-1", -1), ("10485760b", 10485760), ("10MB", 10 << 20), ("256k", 256 << 10), ("0", 0)])
def test_broadcast_limit(spark, text, size):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", text)
    assert prefilter.broadcast_limit(spark) == size
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_filter_shapes_are_bounded():
    assert prefilter.filter_shape(0, 0.01, 1 << 23)[0] == 64
    assert prefilter.filter_shape(10**9, 0.01, 1 << 23) == (1 << 23, 1)
    bits, tries = prefilter.filter_shape(100_000, 0.01, 1 << 23)
    assert bits == 1 << 20 and tries == 7
