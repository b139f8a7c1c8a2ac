"""Every query against its SQL oracle, and what the plans must not contain."""

import re

import pytest

import __spark_entry__ as entry
from wardlens.operators.cohort import anchors_per_day
from wardlens.operators.score import ScoreModel, Term, linear_score
from wardlens.plans.risk_report import (
    cohort_encounters,
    condition_features,
    encounter_rows,
    stay_features,
)
from workload import ORACLES, QUERIES
from workload.compare import oracle_rows, spark_rows
from workload.report import OPTIONS, clinical_tables
from workload.retail import Retail

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", QUERIES)
def test_same_as_oracle(spark, name):
    assert spark_rows(QUERIES[name](spark, FOLDER)) == oracle_rows(FOLDER, ORACLES[name])


def physical_plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("threshold", ["10485760", "-1"])
@pytest.mark.parametrize("name", QUERIES)
def test_plan_has_no_cross_join_and_no_python(spark, name, threshold):
    """With and without the possibility to broadcast."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        plan = physical_plan(QUERIES[name](spark, FOLDER))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas"):
        assert operator not in plan
    if threshold == "-1":
        assert "BroadcastHashJoin" not in plan


def test_cohort_window_reaches_the_scan(spark):
    plan = QUERIES["q01_cohort"](spark, FOLDER)
    text = plan._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    pushed = re.search(r"PushedFilters: \[(.*)\]", text).group(1)
    assert "GreaterThanOrEqual(o_orderdate" in pushed and "LessThan(o_orderdate" in pushed
    assert "EqualTo(o_orderstatus,F)" in pushed
    schema = re.search(r"ReadSchema: struct<(.*)>", text).group(1)
    assert "o_totalprice" not in schema


def test_small_cohort_is_joined_before_the_count(spark):
    plan = physical_plan(QUERIES["q05_prior_count"](spark, FOLDER))
    partial = plan.index("partial_count(o_orderkey")
    assert plan.index("LeftSemi") > partial


def test_report_is_not_merged_again_after_the_patient_join(spark):
    """A patient with many encounters can be split only if no grouping follows the join."""
    plan = physical_plan(QUERIES["q33_risk_report"](spark, FOLDER))
    join = re.search(r"Join \[patient_id#\d+L?\], \[patient_id#\d+L?\], LeftOuter", plan)
    assert "Aggregate" not in plan[: join.start()]


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns[-1] == "risk_score_pct" and df.count() > 0


def test_known_days_reach_the_scans(spark, tmp_path):
    """Problem list, ICU stays and drug orders are read with a range on their times."""
    tables = clinical_tables(Retail(spark, FOLDER))
    for role in ("problems", "icu_stays"):
        tables[role].write.parquet(f"{tmp_path}/{role}")
        tables[role] = spark.read.parquet(f"{tmp_path}/{role}")
    tables["problems"] = tables["problems"].select("patient_id", "dx_id", "noted_on", "ended_on")
    cohort = cohort_encounters(tables, OPTIONS)
    anchors = anchors_per_day(cohort, "patient_id", "admitted_at")
    coded = spark.sql("SELECT 1L AS dx_id, true AS immune, false AS infection")
    found = condition_features(tables, coded, anchors, cohort, OPTIONS)
    plan = pushed_filters(found)
    assert "LessThan(noted_on" in plan and "GreaterThanOrEqual(ended_on" in plan
    stays = cohort.select("patient_id", "encounter_id")
    days = stay_features(stays, tables, anchors, OPTIONS)[2]
    assert "GreaterThanOrEqual(entered_at" in pushed_filters(days)
    plan = pushed_filters(encounter_rows(cohort, tables, OPTIONS))
    assert "GreaterThanOrEqual(entered_at" in plan and "LessThan(entered_at" in plan


def pushed_filters(df):
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    text = df._jdf.queryExecution().explainString(mode)
    return " ".join(re.findall(r"PushedFilters: \[(.*)\]", text))


def test_administrations_are_not_shuffled_for_a_small_cohort(spark):
    plan = physical_plan(QUERIES["q35_drug_exposures"](spark, FOLDER))
    # The scan of the administrations goes into a broadcast join without an exchange between.
    scan = plan.index("l_tax")
    above = plan[:scan].rsplit("BroadcastHashJoin", 1)[-1]
    assert "hashpartitioning" not in above


def test_report_operators_on_five_decimals(spark):
    model = ScoreModel("fine", "0.12345", (Term("x", "0.00001"),))
    rows = spark.sql("SELECT 3 AS x").select(linear_score(model).alias("s"))
    assert str(rows.first().s) == "0.12348"
