from dataclasses import replace
from decimal import Decimal

import pytest
from clinical_fixture import AS_OF, clinical_tables
from pyspark.sql import functions as F

from wardlens.operators import exposure, lookback
from wardlens.plans.risk_report import (
    ReportOptions,
    cohort_encounters,
    drug_exposures,
    drug_sets,
    feature_rows,
    lab_hits,
    procedure_feature,
    risk_report,
)
from wardlens.sources.clinical import empty_tables

OPTIONS = ReportOptions(as_of=AS_OF)
EACH = replace(OPTIONS, per_patient=True, one_row=True)


@pytest.fixture(scope="module")
def tables(spark):
    return clinical_tables(spark)


@pytest.fixture(scope="module")
def as_written(tables):
    return [row.asDict() for row in risk_report(tables, OPTIONS).collect()]


@pytest.fixture(scope="module")
def one_row(tables):
    return {r.encounter_nbr: r.asDict() for r in risk_report(tables, EACH).collect()}


P1 = {
    "patient_id": "P1",
    "encounter_nbr": 1001,
    "medical_record_number": "M1",
    "patient_first_name": "Ada",
    "patient_last_name": "One",
    "patient_age_at_visit": 64,
    "gender": "Female",
    "unit": "Ward 7",
    "facility": "North Hospital",
    "admit_type": "Emergency",
    "admit_day": "20240222",
    "financial_class_desc": "Medicare",
    "prior_hosp": 2,
    "los_prev": 15.8,
    "los_prev_mean": 7.9,
    "icu_prev": "YES",
    "inf_prev": "YES",
    "vent_prev": "YES",
    "prev_dot": 5,
    "prev_blactam": 10,
    "diabetes_present": "YES",
    "cre_prev": 1,
    "cre_lab_prev": 1,
    "cci_score": 11,
    "score": Decimal("-6.3708"),
    "risk_score_pct": 0.17,
}


def of(rows, encounter):
    return [row for row in rows if row["encounter_nbr"] == encounter]


def test_columns_in_order(tables):
    names = risk_report(tables, OPTIONS).columns
    assert len(names) == 27
    assert names[:3] == ["patient_id", "encounter_nbr", "medical_record_number"]
    assert names[-3:] == ["cci_score", "score", "risk_score_pct"]


def test_full_patient(as_written, one_row):
    (row,) = of(as_written, 1001)
    for name, value in P1.items():
        assert row[name] == value, name
        assert one_row[1001][name] == value, name


def test_cohort_edges(as_written):
    assert {row["encounter_nbr"] for row in as_written} == {1001, 2001, 2002, 3001, 4001, 5001}


def test_two_cohort_encounters_repeat_counts(as_written, one_row):
    for encounter in (2001, 2002):
        (row,) = of(as_written, encounter)
        assert row["patient_age_at_visit"] == 33
        assert (row["prior_hosp"], row["los_prev"], row["los_prev_mean"]) == (4, 14.0, 7.0)
        each = one_row[encounter]
        assert (each["prior_hosp"], each["los_prev"], each["los_prev_mean"]) == (2, 7.0, 3.5)
        assert row["icu_prev"] == each["icu_prev"] == "YES"
        assert row["prev_dot"] == 1 and row["inf_prev"] == "YES"
        assert row["vent_prev"] == "NO" and row["cre_prev"] is None
        assert row["unit"] is None and row["financial_class_desc"] is None


def test_icu_days_with_two_cohort_encounters(tables):
    stays = tables["encounters"].where(F.col("encounter_id").isin(2101, 2102))
    cohort = cohort_encounters(tables, OPTIONS)
    anchors = lookback_anchors(cohort)

    def days(as_written):
        rows = lookback.episode_days(
            stays.select("patient_id", "encounter_id"),
            tables["icu_stays"],
            anchors,
            key="patient_id",
            item="encounter_id",
            start="entered_at",
            end="left_at",
            name="days",
            as_written=as_written,
        )
        return [(r.patient_id, r.days) for r in rows.collect()]

    assert days(True) == [("P2", 8)]
    assert days(False) == [("P2", 4)]


def lookback_anchors(cohort):
    from wardlens.operators.cohort import anchors_per_day

    return anchors_per_day(cohort, "patient_id", "admitted_at")


def test_unknown_birth_has_no_score(as_written):
    (row,) = of(as_written, 3001)
    assert row["patient_age_at_visit"] is None and row["gender"] is None
    assert row["score"] is None and row["risk_score_pct"] is None
    assert (row["prior_hosp"], row["los_prev"], row["prev_dot"], row["cci_score"]) == (0, 0, 0, 0)
    assert row["cre_prev"] is None and row["cre_lab_prev"] is None


def test_window_edges_out(as_written):
    (row,) = of(as_written, 4001)
    assert row["prior_hosp"] == 0
    assert row["inf_prev"] == "NO" and row["vent_prev"] == "NO"
    assert row["cci_score"] == 7  # chf once; the first listed category wins
    assert row["cre_prev"] is None and row["cre_lab_prev"] is None


def test_contradicting_flags_and_two_stay_lengths(as_written, one_row):
    rows = of(as_written, 5001)
    assert sorted(row["vent_prev"] for row in rows) == ["NO", "NO", "YES", "YES"]
    assert one_row[5001]["vent_prev"] == "YES"
    assert one_row[5001]["icu_prev"] == "NO"  # a stay of zero days
    assert len(one_row) == 6


def test_immune_flag(tables):
    rows = feature_rows(tables, EACH).select("patient_id", "imm_comp_prev").distinct().collect()
    flag = dict(map(tuple, rows))
    assert flag == {"P1": "YES", "P2": "NO", "P3": "NO", "P4": "NO", "P5": "YES"}


def test_drug_sets(tables):
    rows = drug_sets(tables, OPTIONS).collect()
    antibiotics = {(r.medication_id, r.drug) for r in rows if r.antibiotic}
    beta_lactams = {(r.medication_id, r.drug) for r in rows if r.beta_lactam}
    assert antibiotics == {
        (1, "CEFAZOLIN"),
        (2, "AMOXICILLIN"),
        (3, "AMOXICILLIN-CLAV"),
        (5, "VANCOMYCIN"),
        (9, "LINEZOLID"),
    }
    assert beta_lactams == {
        (1, "CEFAZOLIN"),
        (2, "AMOXICILLIN"),
        (3, "AMOXICILLIN-CLAV"),
        (7, ""),
        (8, "ZZZ"),
    }


def test_exposures_hold_one_row_per_day_and_drug(tables):
    stays = tables["encounters"].where(F.col("patient_id") == "P1")
    keys = cohort_encounters(tables, OPTIONS).select("patient_id").distinct()
    given = drug_exposures(tables, stays, drug_sets(tables, OPTIONS), keys, OPTIONS)
    rows = exposure.merged(
        given,
        ["patient_id", "encounter_id", "day", "drug"],
        ["antibiotic", "beta_lactam"],
    ).collect()
    assert given.count() > len(rows)  # given twice on one day
    assert len(rows) == len({(r.patient_id, r.encounter_id, r.day, r.drug) for r in rows})
    assert sum(r.antibiotic for r in rows) == 5
    assert sum(r.beta_lactam for r in rows) == 10


def test_lab_hits(tables):
    rows = lab_hits(tables, OPTIONS).collect()
    assert {(r.patient_id, r.collected_at, r.organism) for r in rows} == {
        ("P1", "20200101 07:05", "cre E. coli"),
        ("P6", "20200101 07:05", "cre E. coli"),
    }


def test_first_day_icu_window_is_inclusive(tables):
    cohort = cohort_encounters(tables, OPTIONS).select("encounter_id", "admitted_at")
    rows = lookback.within_hours(
        cohort, tables["icu_stays"], on="encounter_id", anchor="admitted_at", start="entered_at"
    )
    assert sorted((r.encounter_id, str(r.entered_at)) for r in rows.collect()) == [
        (4001, "2024-02-22 12:00:00"),
        (4001, "2024-02-23 12:00:00"),
    ]


def test_procedure_flag_with_bounds_in_order(tables, spark):
    cohort = cohort_encounters(tables, OPTIONS)
    codes = spark.sql("SELECT 'GI47' AS procedure_code")
    ordered = dict(tables)
    ordered["lab_orders"] = tables["lab_orders"].withColumn("encounter_id", F.lit(1001).cast("bigint"))
    rows = procedure_feature(ordered, cohort, codes, OPTIONS)
    assert [(r.patient_id, r.prev_gi) for r in rows.collect()] == [("P1", "YES")]
    late = dict(ordered)
    late["procedure_dates"] = tables["procedure_dates"].withColumn(
        "contact_on", F.lit("2024-02-23").cast("date")
    )
    assert procedure_feature(late, cohort, codes, OPTIONS).count() == 0


def test_rows_out_of_every_window_change_nothing(tables, one_row):
    more = dict(tables)
    late = tables["encounters"].withColumns(
        {
            "encounter_id": F.col("encounter_id") + 100000,
            "admitted_at": F.expr("timestamp_ntz'2019-01-01 00:00:00'"),
        }
    )
    more["encounters"] = tables["encounters"].union(late)
    more["seen_diagnoses"] = tables["seen_diagnoses"].union(
        tables["seen_diagnoses"].withColumn("last_seen_on", F.lit("2010-01-01").cast("date"))
    )
    again = {r.encounter_nbr: r.asDict() for r in risk_report(more, EACH).collect()}
    assert again == one_row


def test_input_order_and_partitioning_are_irrelevant(tables, one_row):
    shuffled = {role: df.repartition(3).sortWithinPartitions(df.columns[-1]) for role, df in tables.items()}
    again = {r.encounter_nbr: r.asDict() for r in risk_report(shuffled, EACH).collect()}
    assert again == one_row


def test_integral_stay_lengths_divide_like_integers(tables):
    whole = dict(tables)
    whole["stay_lengths"] = tables["stay_lengths"].withColumn(
        "stay_days", F.col("stay_days").cast("int")
    )
    rows = {r.encounter_nbr: r for r in risk_report(whole, EACH).collect()}
    assert rows[1001].los_prev == 15 and rows[1001].los_prev_mean == 7
    assert rows[2001].los_prev_mean == 3
    for row in risk_report(whole, OPTIONS).where("encounter_nbr = 2001").collect():
        # Two cohort rows: 2 * 7 over 2 stays, the total doubled before the division.
        assert row.los_prev == 14 and row.los_prev_mean == 7


def test_exposures_need_a_known_patient(tables):
    fewer = dict(tables)
    fewer["patients"] = tables["patients"].where("patient_id <> 'P1'")
    (row,) = risk_report(fewer, EACH).where("encounter_nbr = 1001").collect()
    assert (row.prev_dot, row.prev_blactam) == (0, 0)


def test_cohort_row_without_patient_has_no_index(tables):
    more = dict(tables)
    lost = tables["encounters"].where("encounter_id = 1001").withColumns(
        {"patient_id": F.lit(None).cast("string"), "encounter_id": F.lit(7777).cast("bigint")}
    )
    more["encounters"] = tables["encounters"].union(lost.select(tables["encounters"].columns))
    (row,) = risk_report(more, EACH).where("encounter_nbr = 7777").collect()
    assert row.cci_score is None and row.score is None and row.prior_hosp == 0


@pytest.mark.parametrize("seconds, flag", [(2 * 86400, "YES"), (2 * 86400 - 1, "NO")])
def test_problems_with_a_time_of_day_are_compared_as_instants(tables, seconds, flag):
    """Noted two days before the admission counts, a second later does not."""
    timed = dict(tables)
    admitted = tables["encounters"].where("encounter_id = 1001").first().admitted_at
    problems = tables["problems"].where("patient_id = 'P1'").limit(1)
    moment = F.lit(admitted).cast("timestamp_ntz") - F.expr(f"INTERVAL {seconds} SECONDS")
    timed["problems"] = problems.withColumns(
        {
            "dx_id": F.lit(3).cast("bigint"),
            "noted_on": moment,
            "ended_on": F.lit(None).cast("timestamp_ntz"),
        }
    )
    (row,) = risk_report(timed, EACH).where("encounter_nbr = 1001").collect()
    assert row.inf_prev == flag


def test_empty_tables_give_an_empty_report(spark):
    assert risk_report(empty_tables(spark), OPTIONS).count() == 0


def test_one_patient_may_hold_most_rows(tables, one_row):
    """Many copies of one patient's events change no distinct feature."""
    copies = F.explode(F.sequence(F.lit(1), F.lit(400)))
    heavy = dict(tables)
    for role in ("problems", "seen_diagnoses", "administrations", "vent_episodes", "infections"):
        df = tables[role]
        heavy[role] = df.withColumn("copy", copies).select(*df.columns)
    again = {r.encounter_nbr: r.asDict() for r in risk_report(heavy, EACH).collect()}
    assert again == one_row
