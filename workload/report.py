"""The whole risk report over the retail tables."""

from __future__ import annotations

from dataclasses import replace
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardlens.codes import models
from wardlens.codes.codebook import CodeBook, code_table
from wardlens.operators.cohort import copies_per_key
from wardlens.operators.exposure import ExposureRules, OrderRules, merged
from wardlens.plans.risk_report import (
    ReportOptions,
    cohort_encounters,
    drug_exposures,
    drug_sets,
    procedure_feature,
    risk_report,
)
from workload.registry import query
from workload.retail import AS_OF, COHORT_DAYS, PRIOR_DAYS, Retail
from workload.scores import linear_sql

CATEGORIES = (
    ("w", 7, ("red bolt", "blue bolt", "hot gear")),
    ("x", -4, ("blue bolt", "old plate", "red ring")),
    ("y", 3, ("new gizmo", "cold ring", "small widget")),
    ("z", 12, ("red anvil",)),
)

CODES = CodeBook(
    immune_codes=("Brand#3", "Brand#9"),
    immune_ranges=(("Brand#10", "Brand#14"),),
    infection_set="PROMO",
    registry_kind="1-URGENT",
    registry_status_left_out=("P", "F"),
    status_component=64,
    organism_record_type="PROMO",
    organism_name_part="GEAR",
    antibiotic_family="PROMO 1",
    antibiotic_class_codes=("12",),
    excluded_prefixes=("OLD", "RED"),
    beta_lactam_classes=("Brand#3", "Brand#9"),
    beta_lactam_parts=("gear", "rod"),
    diabetes_parents=("hot bolt", "red gear"),
    comorbidities=CATEGORIES,
    order_rules=OrderRules(
        excluded_classes=(3,), routes=(4, 5, 6, 7, 11, 12, 15, 17), route_titles=("nation_2",)
    ),
    antibiotic_rules=ExposureRules(excluded_actions=(2, 3, 4), order_patient_in_cohort=True),
    beta_lactam_rules=ExposureRules(from_stay=True, unknown_route_counts=True),
)

OPTIONS = ReportOptions(
    as_of=AS_OF,
    cohort_first_day=COHORT_DAYS[0],
    cohort_last_day=COHORT_DAYS[1],
    prior_first_day=PRIOR_DAYS[0],
    prior_last_day=PRIOR_DAYS[1],
    codes=CODES,
)


def clinical_tables(r: Retail, whole_days: bool = False) -> dict[str, DataFrame]:
    """Every input table of the report as a projection of the retail tables.

    Some customers are no patients, and every second line of an order is ordered for the
    next customer. With ``whole_days`` stay lengths are whole numbers.
    """
    col = F.col
    lines = r.lineitem
    sold = lines.join(r.orders, col("l_orderkey") == col("o_orderkey"))
    grade = F.substring("o_orderpriority", 1, 1).cast("int")
    line_id = col("l_orderkey") * 8 + col("l_linenumber")
    sign = F.when(col("l_returnflag") == "A", -1).otherwise(1)
    left = F.timestamp_add("DAY", sign * col("l_quantity").cast("int"), col("l_shipdate"))
    final = col("l_linestatus") == "F"

    def pick(df: DataFrame, **columns) -> DataFrame:
        return df.select(
            *[(col(c) if isinstance(c, str) else c).alias(name) for name, c in columns.items()]
        )

    stay_days = col("l_quantity").cast("int") if whole_days else col("l_quantity")
    status = F.when(col("o_orderstatus") == "F", 2).when(col("o_orderstatus") == "P", 6)
    return {
        "encounters": pick(
            r.orders,
            patient_id="o_custkey",
            encounter_id="o_orderkey",
            admitted_at="o_orderdate",
            status=status.otherwise(1),
            class_id=grade,
            department_id=grade,
            admit_source_id=grade,
            account_id="o_orderkey",
            stay_id="o_orderkey",
        ),
        "patients": pick(
            r.customer.where(col("c_custkey") % 10 != 3),
            patient_id="c_custkey",
            first_name="c_name",
            last_name="c_mktsegment",
            birth_date=F.date_add(F.lit(date(1940, 1, 1)), F.floor("c_acctbal").cast("int")),
            sex_id="c_nationkey",
            record_number="c_name",
        ),
        "sexes": pick(r.nation, sex_id="n_nationkey", sex="n_name"),
        "departments": pick(
            r.nation,
            department_id="n_nationkey",
            facility="n_name",
            unit=col("n_regionkey").cast("string"),
        ),
        "admit_sources": pick(r.region, admit_source_id="r_regionkey", admit_source="r_name"),
        "stay_lengths": pick(lines, encounter_id="l_orderkey", stay_days=stay_days),
        "accounts": pick(r.orders, account_id="o_orderkey", financial_class_id=grade),
        "financial_classes": pick(
            r.region, financial_class_id="r_regionkey", financial_class="r_name"
        ),
        "icu_stays": pick(
            lines,
            encounter_id="l_orderkey",
            entered_at="l_shipdate",
            left_at=F.when(final, left),
        ),
        "class_map": pick(r.nation, class_id="n_nationkey", base_class="n_regionkey"),
        "problems": pick(
            sold,
            patient_id="o_custkey",
            dx_id="l_partkey",
            noted_on=F.to_date("o_orderdate"),
            ended_on=F.when(final, F.to_date("l_shipdate")),
        ),
        "diagnoses": pick(
            r.part,
            dx_id="p_partkey",
            icd_list="p_brand",
            parent_dx_id=col("p_size").cast("bigint"),
        ),
        "value_sets": pick(r.part, dx_id="p_partkey", set_id="p_type"),
        "vent_episodes": pick(
            r.orders.where(col("o_orderpriority") == "1-URGENT"),
            patient_id="o_custkey",
            vent_id=F.when(col("o_totalprice") > 250000, col("o_orderkey")),
            stay_id="o_orderkey",
        ),
        "drug_catalog": pick(
            r.part,
            medication_id="p_partkey",
            medication_name="p_name",
            therapeutic_class=F.concat_ws(" ", "p_type", "p_size"),
            pharmaceutical_class="p_brand",
        ),
        "drug_names": pick(
            r.part,
            medication_id="p_partkey",
            short_name=F.substring_index("p_name", " ", 1),
            full_name="p_name",
        ),
        "drug_classes": pick(
            r.part, medication_id="p_partkey", class_code=col("p_size").cast("string")
        ),
        "drug_orders": pick(
            sold,
            order_id=line_id,
            encounter_id="l_orderkey",
            patient_id=col("o_custkey") + F.when(col("l_linenumber") == 2, 1).otherwise(0),
            medication_id="l_partkey",
            ordered_at="o_orderdate",
            ordering_mode=F.when(final, 2).otherwise(1),
            order_class="l_linenumber",
            provider_type=F.when(col("l_discount") > 0.015, 1).otherwise(2),
            order_route=F.when(col("l_returnflag") != "N", col("l_suppkey").cast("int")),
        ),
        "administrations": pick(
            lines,
            order_id=line_id,
            taken_at=F.when(col("l_tax") > 0.005, col("l_shipdate")),
            action_id=col("l_quantity").cast("int"),
            route_id=F.nullif(col("l_linenumber"), F.lit(7)),
        ),
        "routes": pick(r.nation, route_id="n_nationkey", title="n_name"),
        "seen_diagnoses": pick(
            sold,
            patient_id="o_custkey",
            dx_id="l_partkey",
            last_seen_on=F.to_date("l_shipdate"),
        ),
        "diagnosis_codes": pick(
            r.part, dx_id="p_partkey", code=F.when(col("p_type") != "SMALL", col("p_name"))
        ),
        "lab_orders": pick(
            r.orders, order_id="o_orderkey", patient_id="o_custkey", order_type=grade
        ),
        "specimens": pick(r.orders, order_id="o_orderkey", taken_at="o_orderdate"),
        "results": pick(r.orders, result_id="o_orderkey", order_id="o_orderkey"),
        "result_lines": pick(
            lines, result_id="l_orderkey", component_id="l_suppkey", line="l_linenumber"
        ),
        "result_values": pick(
            lines,
            order_id="l_orderkey",
            component_id="l_suppkey",
            value=F.when(col("l_returnflag") == "R", col("l_linestatus")),
        ),
        "cultures": pick(
            lines, result_id="l_orderkey", line="l_linenumber", organism_id="l_partkey"
        ),
        "organisms": pick(
            r.part, organism_id="p_partkey", record_type="p_type", organism="p_name"
        ),
        "infections": pick(
            r.orders,
            patient_id="o_custkey",
            infection_type="o_orderpriority",
            infection_status="o_orderstatus",
        ),
    }


# The cohort's encounters, and what its customers were given with the flags of each line.
ENCOUNTERS_SQL = """
enc AS (
  SELECT o_custkey AS pid, o_orderkey AS eid, o_orderdate AS adm, o_orderstatus AS st,
         CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS grade
  FROM orders
),
cohort AS (
  SELECT pid, eid, adm, grade FROM enc
  WHERE adm >= TIMESTAMP '1998-12-17' AND adm < TIMESTAMP '1999-01-16' AND st = 'F'
)
"""

DRUGS_SQL = """
family AS (
  SELECT DISTINCT upper(split_part(p_name, ' ', 1)) AS word FROM part
  WHERE p_type = 'PROMO' AND p_size = 1
),
drug AS (
  SELECT p_partkey, upper(split_part(p_name, ' ', 1)) AS word,
         (p_size = 12 OR upper(split_part(p_name, ' ', 1)) IN (SELECT word FROM family))
           AND p_name NOT LIKE 'old%' AND p_name NOT LIKE 'red%' AS antibiotic,
         p_brand IN ('Brand#3', 'Brand#9') OR p_name LIKE '%gear%' OR p_name LIKE '%rod%'
           AS beta_lactam
  FROM part
),
given AS (
  SELECT o_custkey AS pid, o_orderkey AS eid, o_orderdate AS ordered, a.l_shipdate AS day, word, antibiotic,
         beta_lactam, CAST(a.l_quantity AS INTEGER) AS action,
         coalesce(o.l_returnflag <> 'N' AND o.l_suppkey IN (4, 5, 6, 7, 11, 12, 15, 17), false)
           OR a.l_linenumber = 2 AS routed,
         o.l_returnflag = 'N' AND a.l_linenumber = 7 AS no_route,
         o_custkey % 10 <> 3 AS known,
         CASE WHEN o.l_linenumber = 2 THEN o_custkey + 1 ELSE o_custkey END AS order_pid
  FROM orders
  JOIN lineitem o ON o.l_orderkey = o_orderkey
  JOIN drug ON p_partkey = o.l_partkey
  JOIN lineitem a ON a.l_orderkey = o.l_orderkey AND a.l_linenumber = o.l_linenumber
  WHERE o_custkey IN (SELECT pid FROM cohort) AND o.l_linestatus = 'F'
    AND o.l_linenumber <> 3 AND o.l_discount > 0.015 AND a.l_tax > 0.005
    AND o_orderdate <= TIMESTAMP '1999-01-14'
)
"""

# The report said directly: every cohort row meets every event of its customer, and the
# result is grouped at the end. {copies} is the cohort, or one row per customer.
REPORT_SQL = """
WITH {cohort},
copy AS ({copies}),
inpatient AS (
  SELECT copy.pid, enc.eid
  FROM copy JOIN enc USING (pid) JOIN nation ON n_nationkey = enc.grade AND n_regionkey = 1
  WHERE st <> 'P' AND enc.adm >= TIMESTAMP '1998-01-14' AND enc.adm < TIMESTAMP '1998-12-17'
),
stays AS (SELECT pid, count(eid) AS prior_hosp FROM inpatient GROUP BY pid),
lengths AS (
  SELECT pid, sum({days}) AS total, sum({days}) {over} count(DISTINCT eid) AS mean
  FROM inpatient LEFT JOIN lineitem ON l_orderkey = eid GROUP BY pid
),
icu AS (
  SELECT l_orderkey AS eid, l_shipdate AS t_in,
         CASE WHEN l_linestatus = 'F' THEN l_shipdate + to_days(CAST(l_quantity AS INTEGER)
              * CASE WHEN l_returnflag = 'A' THEN -1 ELSE 1 END) END AS t_out
  FROM lineitem
),
icu_days AS (
  SELECT copy.pid, sum(abs(date_diff('day', t_in, t_out))) AS days
  FROM copy JOIN inpatient USING (pid) JOIN icu USING (eid)
  WHERE CAST(t_in AS DATE) >= CAST(copy.adm - INTERVAL 367 DAY AS DATE) GROUP BY copy.pid
),
icu_24h AS (
  SELECT cohort.eid, coalesce(date_diff('day', t_out, t_in) > 0, false) AS swapped
  FROM cohort JOIN icu USING (eid)
  WHERE t_in BETWEEN adm AND adm + INTERVAL 24 HOUR
),
active AS (
  SELECT cohort.pid, p_brand, p_type
  FROM cohort JOIN orders ON o_custkey = pid JOIN lineitem ON l_orderkey = o_orderkey
  JOIN part ON p_partkey = l_partkey
  WHERE CAST(o_orderdate AS DATE) <= adm - INTERVAL 2 DAY
    AND (l_linestatus <> 'F' OR CAST(l_shipdate AS DATE) >= adm - INTERVAL 367 DAY)
),
infection AS (SELECT DISTINCT pid FROM active WHERE p_type = 'PROMO'),
vent AS (
  SELECT DISTINCT o_custkey AS pid, o_totalprice > 250000 AS started
  FROM orders
  WHERE o_orderpriority = '1-URGENT' AND o_custkey IN (SELECT pid FROM cohort)
    AND o_orderdate >= TIMESTAMP '1998-01-14' AND o_orderdate < TIMESTAMP '1998-12-17'
),
{drugs},
dot AS (
  SELECT pid, count(DISTINCT strftime(day, '%m/%d/%y') || word) AS days FROM given
  WHERE antibiotic AND routed AND action NOT IN (2, 3, 4) AND ordered >= TIMESTAMP '1998-01-14'
    AND order_pid % 10 <> 3 AND order_pid IN (SELECT pid FROM cohort)
  GROUP BY pid
),
lactam AS (
  SELECT pid, count(DISTINCT strftime(day, '%m/%d/%y') || word) AS days FROM given
  WHERE beta_lactam AND (routed OR no_route) AND known GROUP BY pid
),
parent AS (
  SELECT DISTINCT o_custkey AS pid, up.p_name AS code
  FROM orders JOIN lineitem ON l_orderkey = o_orderkey
  JOIN part dx ON dx.p_partkey = l_partkey
  JOIN part twin ON twin.p_brand = dx.p_brand
  JOIN part up ON up.p_partkey = twin.p_size
  WHERE l_shipdate >= TIMESTAMP '1998-01-16' AND up.p_type <> 'SMALL'
    AND o_custkey IN (SELECT pid FROM cohort)
),
category AS (
  SELECT DISTINCT pid, CASE
    WHEN code IN ('red bolt', 'blue bolt', 'hot gear') THEN 7
    WHEN code IN ('blue bolt', 'old plate', 'red ring') THEN -4
    WHEN code IN ('new gizmo', 'cold ring', 'small widget') THEN 3
    WHEN code = 'red anvil' THEN 12 ELSE 0 END AS weight
  FROM parent
),
cci AS (SELECT pid, sum(weight) AS total FROM category GROUP BY pid),
grown AS (
  SELECT DISTINCT o_custkey AS pid
  FROM orders JOIN lineitem g ON g.l_orderkey = o_orderkey
  JOIN part ON p_partkey = g.l_partkey AND p_type = 'PROMO' AND p_name LIKE '%gear%'
  JOIN lineitem c ON c.l_orderkey = o_orderkey AND c.l_linenumber = g.l_linenumber
  JOIN lineitem v ON v.l_orderkey = o_orderkey AND v.l_suppkey = c.l_suppkey
                 AND v.l_returnflag = 'R' AND v.l_suppkey <> 64
  WHERE substr(o_orderpriority, 1, 1) = '3'
),
rows AS (
  SELECT DISTINCT cohort.pid AS patient_id, cohort.eid AS encounter_nbr,
    c_name AS medical_record_number, c_name AS patient_first_name,
    c_mktsegment AS patient_last_name,
    CAST(floor(date_diff('day', DATE '1940-01-01' + CAST(floor(c_acctbal) AS INTEGER),
                         DATE '1999-01-16') / 365.25) AS INTEGER) AS patient_age_at_visit,
    sex.n_name AS gender, CAST(dep.n_regionkey AS VARCHAR) AS unit, dep.n_name AS facility,
    r_name AS admit_type, strftime(cohort.adm, '%Y%m%d') AS admit_day,
    cohort.adm AS admit_timestamp, r_name AS financial_class_desc,
    CAST(coalesce(stays.prior_hosp, 0) AS BIGINT) AS prior_hosp,
    coalesce(lengths.total, 0) AS los_prev, coalesce(lengths.mean, 0) AS los_prev_mean,
    CASE WHEN icu_days.days > 0 THEN 1 ELSE 0 END AS icu_prev_num,
    CASE WHEN infection.pid IS NOT NULL THEN 1 ELSE 0 END AS inf_prev_num,
    CASE WHEN {vent} THEN 'YES' ELSE 'NO' END AS vent_prev,
    CAST(coalesce(dot.days, 0) AS BIGINT) AS prev_dot,
    CASE WHEN dot.days IS NULL THEN 0 ELSE ln(dot.days) END AS prev_dot_log,
    CAST(coalesce(lactam.days, 0) AS BIGINT) AS prev_blactam,
    CASE WHEN cohort.pid IN (SELECT pid FROM parent WHERE code IN ('hot bolt', 'red gear'))
         THEN 1 ELSE 0 END AS diabetes_num,
    CASE WHEN cohort.pid IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT'
                             AND o_orderstatus NOT IN ('P', 'F')) THEN 1 END AS cre_prev,
    CASE WHEN cohort.pid IN (SELECT pid FROM grown) THEN 1 END AS cre_lab_prev,
    CAST(coalesce(cci.total, 0) AS BIGINT) AS cci_score,
    {unread}
  FROM cohort
  LEFT JOIN customer ON c_custkey = cohort.pid AND c_custkey % 10 <> 3
  LEFT JOIN nation sex ON sex.n_nationkey = c_nationkey
  LEFT JOIN nation dep ON dep.n_nationkey = cohort.grade
  LEFT JOIN region ON r_regionkey = cohort.grade
  LEFT JOIN stays ON stays.pid = cohort.pid
  LEFT JOIN lengths ON lengths.pid = cohort.pid
  LEFT JOIN icu_days ON icu_days.pid = cohort.pid
  LEFT JOIN infection ON infection.pid = cohort.pid
  LEFT JOIN dot ON dot.pid = cohort.pid
  LEFT JOIN lactam ON lactam.pid = cohort.pid
  LEFT JOIN cci ON cci.pid = cohort.pid
  {fan_out}
),
scored AS (SELECT *, {score} AS score FROM rows)
SELECT patient_id, encounter_nbr, medical_record_number, patient_first_name, patient_last_name,
  patient_age_at_visit, gender, unit, facility, admit_type, admit_day, admit_timestamp,
  financial_class_desc, prior_hosp, los_prev, los_prev_mean,
  CASE icu_prev_num WHEN 1 THEN 'YES' ELSE 'NO' END AS icu_prev,
  CASE inf_prev_num WHEN 1 THEN 'YES' ELSE 'NO' END AS inf_prev,
  vent_prev, prev_dot, prev_blactam,
  CASE diabetes_num WHEN 1 THEN 'YES' ELSE 'NO' END AS diabetes_present,
  cre_prev, cre_lab_prev, cci_score, score,
  CAST(round(100 * exp(CAST(score AS DOUBLE)) / (1 + exp(CAST(score AS DOUBLE))), 2)
       AS DECIMAL(10, 2)) AS risk_score_pct
FROM scored
"""

AS_WRITTEN = {
    "copies": "SELECT pid, adm FROM cohort",
    "vent": "vent.started",
    "days": "l_quantity",
    "over": "/",
    "unread": "l_quantity AS stay_days, coalesce(icu_24h.swapped, false) AS swapped",
    "fan_out": """
  LEFT JOIN vent ON vent.pid = cohort.pid
  LEFT JOIN lineitem ON l_orderkey = cohort.eid
  LEFT JOIN icu_24h ON icu_24h.eid = cohort.eid""",
}

ONE_ROW = {
    "copies": "SELECT pid, min(adm) AS adm FROM cohort GROUP BY pid",
    "vent": "cohort.pid IN (SELECT pid FROM vent WHERE started)",
    "days": "l_quantity",
    "over": "/",
    "unread": "NULL AS stay_days, NULL AS swapped",
    "fan_out": "",
}


def report_sql(parts: dict[str, str]) -> str:
    return REPORT_SQL.format(
        **parts, cohort=ENCOUNTERS_SQL, drugs=DRUGS_SQL, score=linear_sql(models.CURRENT)
    )


def report(r: Retail, options: ReportOptions, whole_days: bool = False) -> DataFrame:
    rows = risk_report(clinical_tables(r, whole_days), options, r.stage)
    return rows.withColumn(options.pct_name, F.col(options.pct_name).cast("decimal(10,2)"))


@query("q33_risk_report", report_sql(AS_WRITTEN))
def as_written(r):
    return report(r, OPTIONS)


@query("q34_risk_report_one_row", report_sql(ONE_ROW))
def one_row(r):
    return report(r, replace(OPTIONS, per_patient=True, one_row=True))


@query(
    "q35_drug_exposures",
    f"""
    WITH {ENCOUNTERS_SQL}, {DRUGS_SQL},
    flagged AS (
      SELECT pid, eid, CAST(day AS DATE) AS day, word,
             antibiotic AND routed AND action NOT IN (2, 3, 4)
               AND ordered >= TIMESTAMP '1998-01-14' AND order_pid % 10 <> 3
               AND order_pid IN (SELECT pid FROM cohort) AS antibiotic,
             beta_lactam AND (routed OR no_route) AND known AS beta_lactam
      FROM given
    )
    SELECT pid AS patient_id, eid AS encounter_id, day, word AS drug,
           bool_or(antibiotic) AS antibiotic, bool_or(beta_lactam) AS beta_lactam
    FROM flagged WHERE antibiotic OR beta_lactam GROUP BY pid, eid, day, word
    """,
)
def given_drugs(r):
    tables = clinical_tables(r)
    cohort = cohort_encounters(tables, OPTIONS)
    keys = r.stage.keep(copies_per_key(cohort, "patient_id"), "patients")
    stays = tables["encounters"].join(keys.select("patient_id"), "patient_id", "left_semi")
    stays = r.stage.keep(stays.select("patient_id", "encounter_id", "admitted_at"), "stays")
    rows = drug_exposures(tables, stays, drug_sets(tables, OPTIONS), keys, OPTIONS, r.stage)
    return merged(
        rows, ["patient_id", "encounter_id", "day", "drug"], ["antibiotic", "beta_lactam"]
    )


WHOLE_DAYS = AS_WRITTEN | {
    "days": "CAST(l_quantity AS INTEGER)",
    "over": "//",
    "unread": "CAST(l_quantity AS INTEGER) AS stay_days, coalesce(icu_24h.swapped, false) AS swapped",
}


@query("q36_risk_report_whole_days", report_sql(WHOLE_DAYS))
def whole_days(r):
    return report(r, OPTIONS, whole_days=True)


PROCEDURE_CODES = ["Brand#1", "Brand#2", "Brand#3"]


@query(
    "q37_procedure_feature",
    f"""
    WITH {ENCOUNTERS_SQL}
    SELECT DISTINCT pid AS patient_id,
           CASE WHEN p_brand IN ('Brand#1', 'Brand#2', 'Brand#3') THEN 'YES' ELSE 'NO' END AS prev_gi
    FROM cohort JOIN lineitem ON l_orderkey = eid JOIN part ON p_partkey = l_partkey
    WHERE DATE '1997-12-20' + CAST(p_size * 10 AS INTEGER) BETWEEN adm - INTERVAL 367 DAY AND adm
    """,
)
def procedures(r):
    """Lines as procedures of their order, parts with a date of their own."""
    contact = F.date_add(F.lit(date(1997, 12, 20)), F.col("p_size") * 10)
    tables = clinical_tables(r) | {
        "lab_orders": r.lineitem.select(
            F.col("l_orderkey").alias("encounter_id"), F.col("l_partkey").alias("procedure_id")
        ),
        "procedures": r.part.select(
            F.col("p_partkey").alias("procedure_id"), F.col("p_brand").alias("procedure_code")
        ),
        "procedure_dates": r.part.select(
            F.col("p_partkey").alias("procedure_id"), contact.alias("contact_on")
        ),
    }
    cohort = r.stage.keep(cohort_encounters(tables, OPTIONS), "cohort")
    codes = code_table(r.spark, PROCEDURE_CODES, "procedure_code")
    return procedure_feature(tables, cohort, codes, OPTIONS)
