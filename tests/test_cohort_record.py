"""Features out of the cohort's own staged rows: one pass over the lines, the same results."""

import pytest
from pyspark.sql import functions as F

from wardlens.sources.staging import Stage
from workload import QUERIES, conditions, drugs, history
from workload.compare import spark_rows
from workload.retail import CohortRecord, Retail

FOLDER = "/root/testdata/sf0.001"
LARGER = "/root/testdata/sf0.01"
FEATURES = [
    history.prior_orders,
    history.quantities,
    history.shipping_days,
    conditions.listed_or_ranged,
    conditions.in_value_set,
    conditions.coded_parent,
    conditions.weighted,
    drugs.therapy_days,
    drugs.class_or_pattern_days,
]


@pytest.mark.parametrize("name", ["q27_assemble", "q29_logistic", "q30_model_versions"])
def test_no_feature_reads_the_whole_line_table_again(spark, name, monkeypatch):
    staged, keep = {}, Stage.keep

    def watched(stage, df, table):
        staged[table] = df
        return keep(stage, df, table)

    monkeypatch.setattr(Stage, "keep", watched)
    staged["result"] = QUERIES[name](spark, FOLDER)
    reading = [table for table, df in staged.items() if any("lineitem.parquet" in path for path in df.inputFiles())]
    assert reading == ["cohort-lines"]


def odd_record(spark):
    """Repeated orders, lines and parts; orders without a customer, lines without a part."""
    whole = Retail(spark, LARGER)
    orders = whole.orders.union(whole.orders.where("o_orderkey % 5 = 0"))
    orders = orders.withColumn("o_custkey", F.when(F.col("o_orderkey") % 11 != 0, F.col("o_custkey")))
    lines = whole.lineitem.union(whole.lineitem.where("l_linenumber = 2"))
    lines = lines.withColumn("l_partkey", F.when(F.col("l_suppkey") % 7 != 0, F.col("l_partkey")))
    part = whole.part.union(whole.part.where("p_partkey % 3 = 0"))
    return Retail(spark, LARGER, orders=orders, lineitem=lines, part=part)


@pytest.fixture(params=["10485760", "-1"])
def threshold(spark, request):
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, request.param)
    yield
    spark.conf.set(name, before)


def test_features_are_those_of_the_whole_tables(spark, threshold):
    whole, own = odd_record(spark), CohortRecord(odd_record(spark))
    assert spark_rows(own.cohort) == spark_rows(whole.cohort)
    assert whole.cohort.where("o_custkey IS NULL").count() > 0
    for feature in FEATURES:
        want = spark_rows(feature(whole))
        assert want[1] and spark_rows(feature(own)) == want, feature.__name__
