"""The whole report: cohort, look-back features, one row per encounter, risk score."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardlens.codes import models
from wardlens.codes.codebook import CodeBook, category_map, category_weights
from wardlens.functions.text import contains_any
from wardlens.functions.numeric import is_integral, ratio
from wardlens.functions.times import (
    compact_day,
    compact_minute,
    day_diff,
    midnight,
    moment_literal,
    on_days,
)
from wardlens.operators import assemble, comorbid, exposure, flags, lookback
from wardlens.operators.cohort import (
    Lookup,
    anchors_per_day,
    copies_per_key,
    demographics,
    enrich,
    keep_cohort_keys,
    select_cohort,
)
from wardlens.operators.prefilter import reduce_by_ids
from wardlens.operators.score import ScoreModel, score
from wardlens.sources.staging import Stage

Tables = Mapping[str, DataFrame]


@dataclass(frozen=True)
class ReportOptions:
    """When, for whom and how the report runs.

    ``as_of`` replaces the clock. A patient with several cohort encounters has prior
    stays, stay days and ICU days counted once per encounter unless ``per_patient``.
    A patient or encounter with contradicting flags or several stay lengths gives
    several rows unless ``one_row``.
    """

    as_of: datetime
    cohort_first_day: int = -1
    cohort_last_day: int = -1
    prior_first_day: int = -367
    prior_last_day: int = -2
    dx_first_day: int = -365
    icu_reach: int = 367
    noted_days: int = 2
    ended_days: int = 367
    procedure_days: int = 367
    per_patient: bool = False
    one_row: bool = False
    codes: CodeBook = field(default_factory=CodeBook)
    model: ScoreModel = models.CURRENT
    pct_name: str = "risk_score_pct"


REPORT_COLUMNS = (
    "patient_id",
    "encounter_nbr",
    "medical_record_number",
    "patient_first_name",
    "patient_last_name",
    "patient_age_at_visit",
    "gender",
    "unit",
    "facility",
    "admit_type",
    "admit_day",
    "admit_timestamp",
    "financial_class_desc",
    "prior_hosp",
    "los_prev",
    "los_prev_mean",
    "icu_prev",
    "inf_prev",
    "vent_prev",
    "prev_dot",
    "prev_blactam",
    "diabetes_present",
    "cre_prev",
    "cre_lab_prev",
    "cci_score",
)


def cohort_encounters(tables: Tables, options: ReportOptions) -> DataFrame:
    """Encounters admitted in the cohort window with the cohort's status."""
    return select_cohort(
        tables["encounters"],
        as_of=options.as_of,
        encounter="encounter_id",
        admitted="admitted_at",
        first_day=options.cohort_first_day,
        last_day=options.cohort_last_day,
        where=F.col("status") == options.codes.cohort_status,
    )


def cohort_span(options: ReportOptions) -> tuple[datetime, datetime]:
    """The first instant of the cohort's days, and the first one after them."""
    first = midnight(options.as_of, options.cohort_first_day)
    return first, midnight(options.as_of, options.cohort_last_day + 1)


def from_instant(df: DataFrame, column: str, moment: datetime) -> Column:
    """A lower bound on a raw column, for the scan."""
    return F.col(column) >= moment_literal(moment, df.schema[column].dataType)


def before_instant(df: DataFrame, column: str, moment: datetime) -> Column:
    """An upper bound on a raw column, for the scan."""
    return F.col(column) < moment_literal(moment, df.schema[column].dataType)


def prior_inpatient(stays: DataFrame, tables: Tables, options: ReportOptions) -> DataFrame:
    """Inpatient stays of the look-back window."""
    base_class = options.codes.inpatient_base_class
    inpatient = tables["class_map"].where(F.col("base_class") == base_class).select("class_id")
    prior = lookback.prior_events(
        stays,
        ts="admitted_at",
        as_of=options.as_of,
        first_day=options.prior_first_day,
        last_day=options.prior_last_day,
        where=F.col("status") != options.codes.outpatient_status,
    )
    return prior.join(inpatient, "class_id").select("patient_id", "encounter_id")


def stay_features(
    prior: DataFrame,
    tables: Tables,
    anchors: DataFrame,
    options: ReportOptions,
    stays: DataFrame | None = None,
) -> list[DataFrame]:
    """Prior stays, total length and number of stays, ICU days; each for one cohort row.

    With staged ``stays``, stay lengths are filtered by their ids where those are too many to
    broadcast.
    """
    lengths = tables["stay_lengths"]
    if stays is not None:
        lengths = reduce_by_ids(lengths, "encounter_id", stays.select("encounter_id"))
    icu = tables["icu_stays"]
    first, _ = cohort_span(options)
    icu = icu.where(from_instant(icu, "entered_at", first - timedelta(days=options.icu_reach)))
    return [
        lookback.count_per_key(prior, "patient_id", "encounter_id", "prior_hosp"),
        lookback.total_and_items(
            prior,
            lengths,
            key="patient_id",
            item="encounter_id",
            amount="stay_days",
            total_name="los_prev",
            items_name="los_items",
        ),
        lookback.episode_days(
            prior,
            icu,
            anchors,
            key="patient_id",
            item="encounter_id",
            start="entered_at",
            end="left_at",
            name="icu_days",
            reach=options.icu_reach,
            as_written=False,
        ),
    ]


# Counted once per cohort row of the patient.
PER_COHORT_ROW = ("prior_hosp", "los_prev", "icu_days")


def coded_conditions(tables: Tables, options: ReportOptions) -> DataFrame:
    """(dx_id) with the flags ``immune`` and ``infection``."""
    codes = options.codes
    immune = tables["diagnoses"].where(
        flags.code_in(F.col("icd_list"), codes.immune_codes, codes.immune_ranges)
    )
    in_set = tables["value_sets"].where(F.col("set_id") == codes.infection_set)
    infectious = tables["diagnoses"].join(in_set, "dx_id", "left_semi")
    return flags.stack_flags({"immune": immune, "infection": infectious}, "dx_id")


def condition_features(
    tables: Tables,
    coded: DataFrame,
    anchors: DataFrame,
    cohort: DataFrame,
    options: ReportOptions,
) -> DataFrame:
    """Immune compromise and infection from the problem list, read once for both.

    The cohort's days bound both dates before any admission is known.
    """
    problems = tables["problems"]
    first, end = cohort_span(options)
    noted = before_instant(problems, "noted_on", end - timedelta(days=options.noted_days))
    ended = from_instant(problems, "ended_on", first - timedelta(days=options.ended_days))
    admissions = cohort.select("patient_id", F.col("admitted_at").alias("admitted")).distinct()
    if options.per_patient:
        admissions = admissions.groupBy("patient_id").agg(F.min("admitted").alias("admitted"))
    return flags.active_flags(
        problems.where(noted & (F.col("ended_on").isNull() | ended)),
        coded,
        anchors,
        key="patient_id",
        code_id="dx_id",
        noted="noted_on",
        ended="ended_on",
        flags=["immune", "infection"],
        noted_days=options.noted_days,
        ended_days=options.ended_days,
        admissions=admissions,
    )


def ventilation_feature(
    stays: DataFrame, tables: Tables, options: ReportOptions
) -> DataFrame:
    """Whether a patient's look-back stays have ventilation with and without a start."""
    window = lookback.prior_events(
        stays,
        ts="admitted_at",
        as_of=options.as_of,
        first_day=options.prior_first_day,
        last_day=options.prior_last_day,
    )
    episodes = flags.composite_episodes(
        tables["vent_episodes"], window, on=["patient_id", "stay_id"]
    )
    return assemble.flag_values(
        episodes, ["patient_id"], F.col("vent_id").isNotNull(), "vent_prev"
    )


def drug_sets(tables: Tables, options: ReportOptions) -> DataFrame:
    """(medication_id, drug) with the flags ``antibiotic`` and ``beta_lactam``."""
    codes = options.codes
    family = exposure.family_catalog(
        tables["drug_catalog"], tables["drug_names"], family=codes.antibiotic_family
    )
    return exposure.drug_flags(
        tables["drug_classes"],
        tables["drug_catalog"],
        tables["drug_names"],
        family,
        class_codes=codes.antibiotic_class_codes,
        excluded_prefixes=codes.excluded_prefixes,
        pharm_classes=codes.beta_lactam_classes,
        parts=codes.beta_lactam_parts,
    )


def drug_exposures(
    tables: Tables,
    stays: DataFrame,
    drugs: DataFrame,
    keys: DataFrame,
    options: ReportOptions,
    stage: Stage | None = None,
) -> DataFrame:
    """Drugs given to the cohort's patients, by day, flagged by drug set.

    With a stage, the first admission of ``stays`` bounds the orders, and the wanted orders
    are staged before the administrations join.
    """
    codes = options.codes
    earliest = stays.agg(F.min("admitted_at")).first()[0] if stage else None
    return exposure.exposures(
        tables["drug_orders"],
        tables["administrations"],
        stays,
        tables["routes"],
        drugs,
        keys,
        as_of=options.as_of,
        order_rules=codes.order_rules,
        rules={
            "antibiotic": codes.antibiotic_rules,
            "beta_lactam": codes.beta_lactam_rules,
        },
        patients=tables["patients"],
        earliest=earliest,
        keep=stage.keep if stage else None,
    )


def diagnosis_labels(tables: Tables, options: ReportOptions) -> DataFrame:
    """(dx_id, category, weight, diabetic) over the parents of each diagnosis's code list.

    Worked out on the diagnosis tables alone, so that patients' diagnoses join once, on
    the diagnosis, and never on a code list many diagnoses share.
    """
    codes = options.codes
    spark = tables["diagnoses"].sparkSession
    parents = comorbid.parent_codes(
        tables["diagnoses"],
        tables["diagnosis_codes"],
        group="icd_list",
        parent="parent_dx_id",
        code_id="dx_id",
        code="code",
    )
    categories = comorbid.first_match(category_map(spark, codes.comorbidities))
    weighed = comorbid.weigh(
        comorbid.categorize(parents, categories, "parent_code"),
        category_weights(spark, codes.comorbidities),
    )
    diabetic = F.col("parent_code").isin(list(codes.diabetes_parents)).cast("int")
    lists = weighed.groupBy("icd_list", "category", "weight").agg(
        F.max(diabetic).alias("diabetic")
    )
    return (
        tables["diagnoses"]
        .select("dx_id", "icd_list")
        .join(lists, "icd_list")
        .select("dx_id", "category", "weight", "diabetic")
    )


def comorbidity_feature(
    tables: Tables, keys: DataFrame, labels: DataFrame, options: ReportOptions
) -> DataFrame:
    """Weighted comorbidity index and diabetes flag per patient, in one pass.

    A category counts once per patient, whichever of its codes it came from.
    """
    seen = tables["seen_diagnoses"]
    recent = (
        seen.where(on_days(seen, "last_seen_on", options.as_of, options.dx_first_day))
        .select("patient_id", "dx_id")
        .distinct()
    )
    once = (
        keep_cohort_keys(recent, keys, "patient_id")
        .join(labels, "dx_id")
        .groupBy("patient_id", "category", "weight")
        .agg(F.max("diabetic").alias("diabetic"))
    )
    return once.groupBy("patient_id").agg(
        F.sum("weight").alias("cci_score"),
        F.nullif(F.max("diabetic"), F.lit(0)).alias("diabetes"),
    )


def procedure_feature(
    tables: Tables, cohort: DataFrame, codes: DataFrame, options: ReportOptions
) -> DataFrame:
    """(patient_id, prev_gi): 'YES' or 'NO' for the codes of procedures of cohort encounters.

    A procedure counts by its contact date, up to ``procedure_days`` before the admission and
    not after it. ``codes`` has one column, ``procedure_code``. Not part of the report.
    """
    dates = tables["procedure_dates"]
    first, end = cohort_span(options)
    reach = timedelta(days=options.procedure_days)
    dates = dates.where(
        from_instant(dates, "contact_on", midnight(first - reach))
        & before_instant(dates, "contact_on", end)
    )
    contact = F.col("contact_on").cast("timestamp_ntz")
    oldest = F.col("admitted_at") - F.expr(f"INTERVAL {int(options.procedure_days)} DAYS")
    rows = (
        cohort.select("patient_id", "encounter_id", "admitted_at")
        .join(tables["lab_orders"].select("encounter_id", "procedure_id"), "encounter_id")
        .join(dates.distinct(), "procedure_id")
        .where(contact.between(oldest, F.col("admitted_at")))
        .join(tables["procedures"], "procedure_id", "left")
    )
    flagged = flags.code_case_flag(rows, codes, code="procedure_code", name="prev_gi")
    return flagged.select("patient_id", "prev_gi").distinct()


def resistance_features(
    tables: Tables, keys: DataFrame, options: ReportOptions, stage: Stage | None = None
) -> list[DataFrame]:
    """Resistant organisms in the registry and in the laboratory."""
    codes = options.codes
    registered = flags.registry_keys(
        tables["infections"],
        key="patient_id",
        kind="infection_type",
        kind_is=codes.registry_kind,
        status="infection_status",
        status_not=codes.registry_status_left_out,
    )
    grown = lab_hits(tables, options, keys, stage).select("patient_id").distinct()
    return [
        keep_cohort_keys(rows, keys, "patient_id").withColumn(name, F.lit(1))
        for name, rows in (("cre_prev", registered), ("cre_lab_prev", grown))
    ]


def lab_hits(
    tables: Tables,
    options: ReportOptions,
    keys: DataFrame | None = None,
    stage: Stage | None = None,
) -> DataFrame:
    """Culture orders that grew a resistant organism, with the specimen's minute.

    ``keys`` restricts the patients before any result is looked at.
    """
    codes = options.codes
    orders = tables["lab_orders"].where(F.col("order_type") == codes.culture_order_type)
    if keys is not None:
        orders = orders.join(keys.select("patient_id"), "patient_id", "left_semi")
    organisms = tables["organisms"].where(
        (F.col("record_type") == codes.organism_record_type)
        & contains_any(F.col("organism"), [codes.organism_name_part])
    )
    values = tables["result_values"].where(
        F.col("value").isNotNull() & (F.col("component_id") != codes.status_component)
    )
    hits = flags.positive_cultures(
        orders,
        tables["specimens"],
        tables["results"],
        tables["result_lines"],
        values,
        tables["cultures"],
        organisms,
        stage.keep if stage else None,
    )
    return hits.withColumn("collected_at", compact_minute(F.col("taken_at")))


def patient_rows(
    tables: Tables, copies: DataFrame, features: list[DataFrame], options: ReportOptions
) -> DataFrame:
    """One row per cohort patient: demographics and all patient-level features."""
    patients = tables["patients"].distinct()
    people = demographics(
        keep_cohort_keys(patients, copies, "patient_id"),
        birth="birth_date",
        as_of=options.as_of,
        lookups=[Lookup("sex_id", tables["sexes"], "sex_id", {"sex": "sex"})],
    )
    wide = assemble.stack_features(features, "patient_id")
    rows = copies.join(people, "patient_id", "left").join(wide, "patient_id", "left")
    rows = rows.withColumns({name: F.col(name) * F.col("copies") for name in PER_COHORT_ROW})
    # The total is taken once per cohort row before the division, stays stay distinct.
    integral = is_integral(tables["stay_lengths"].schema["stay_days"].dataType)
    mean = ratio(F.col("los_prev"), F.col("los_items"), integral)
    # Every patient has an index; a cohort row without a patient has none.
    return rows.withColumns(
        {"los_prev_mean": mean, "cci_score": F.coalesce("cci_score", F.lit(0))}
    ).drop("copies", "los_items")


def encounter_rows(cohort: DataFrame, tables: Tables, options: ReportOptions) -> DataFrame:
    """Cohort encounters with their looked-up labels.

    Stay lengths and the ICU flag of the first day are not part of the report; they
    only decide how many rows an encounter has, and are left out with ``one_row``.
    """
    rows = enrich(
        cohort,
        [
            Lookup(
                "department_id",
                tables["departments"],
                "department_id",
                {"facility": "facility", "unit": "unit"},
            ),
            Lookup(
                "admit_source_id",
                tables["admit_sources"],
                "admit_source_id",
                {"admit_source": "admit_source"},
            ),
            Lookup(
                "account_id",
                tables["accounts"],
                "account_id",
                {"financial_class_id": "financial_class_id"},
            ),
            Lookup(
                "financial_class_id",
                tables["financial_classes"],
                "financial_class_id",
                {"financial_class": "financial_class"},
            ),
        ],
    )
    if options.one_row:
        unread = F.lit(None).cast("string")
        return rows.withColumn("stay_days", unread).withColumn("icu_24h", unread)
    lengths = tables["stay_lengths"].select("encounter_id", "stay_days").distinct()
    lengths = keep_cohort_keys(lengths, cohort, "encounter_id")
    # Days are taken from leaving to entering, as the report has it: positive only
    # where a stay's times are swapped. Merged per entry time before the join.
    swapped = day_diff(F.col("left_at"), F.col("entered_at")) > 0
    icu_stays = tables["icu_stays"]
    start, end = cohort_span(options)
    in_reach = from_instant(icu_stays, "entered_at", start) & before_instant(
        icu_stays, "entered_at", end + timedelta(hours=24)
    )
    entries = assemble.flag_values(
        icu_stays.where(in_reach), ["encounter_id", "entered_at"], swapped, "icu_24h"
    )
    entries = keep_cohort_keys(entries, cohort, "encounter_id")
    first_day = lookback.within_hours(
        cohort.select("encounter_id", "admitted_at"),
        entries,
        on="encounter_id",
        anchor="admitted_at",
        start="entered_at",
    )
    icu = exposure.merged(first_day, ["encounter_id"], ["icu_24h_yes", "icu_24h_no"])
    rows = rows.join(lengths, "encounter_id", "left").join(icu, "encounter_id", "left")
    return assemble.each_flag_value(rows, "icu_24h", one_row=False)


def assembled(
    encounters: DataFrame, people: DataFrame, options: ReportOptions
) -> DataFrame:
    """The report's feature rows, equal rows merged.

    Encounter rows are merged before the join: the patient side has no equal rows, so
    nothing is left to merge after it, and a patient with many encounters can be split
    over tasks.
    """
    distinct = encounters.select(
        "patient_id",
        "encounter_id",
        "admitted_at",
        "unit",
        "facility",
        "admit_source",
        "financial_class_id",
        "financial_class",
        "stay_days",
        "icu_24h",
    ).distinct()
    rows = distinct.join(people, "patient_id", "left")
    rows = assemble.each_flag_value(rows, "vent_prev", options.one_row)
    icu = F.col("icu_days") > 0
    infection = F.col("infection") == 1
    diabetes = F.col("diabetes") == 1
    return rows.select(
        "patient_id",
        F.col("encounter_id").alias("encounter_nbr"),
        F.col("record_number").alias("medical_record_number"),
        F.col("first_name").alias("patient_first_name"),
        F.col("last_name").alias("patient_last_name"),
        F.col("age").alias("patient_age_at_visit"),
        F.col("sex").alias("gender"),
        "unit",
        "facility",
        F.col("admit_source").alias("admit_type"),
        compact_day(F.col("admitted_at")).alias("admit_day"),
        F.col("admitted_at").alias("admit_timestamp"),
        "financial_class_id",
        F.col("financial_class").alias("financial_class_desc"),
        assemble.or_zero("prior_hosp"),
        assemble.or_zero("los_prev"),
        assemble.or_zero("los_prev_mean"),
        assemble.yes_no(icu).alias("icu_prev"),
        assemble.one_zero(icu).alias("icu_prev_num"),
        assemble.yes_no(F.col("immune") == 1).alias("imm_comp_prev"),
        assemble.yes_no(infection).alias("inf_prev"),
        assemble.one_zero(infection).alias("inf_prev_num"),
        "vent_prev",
        assemble.or_zero("prev_dot"),
        assemble.log_or_zero(F.col("prev_dot")).alias("prev_dot_log"),
        assemble.or_zero("prev_blactam"),
        assemble.yes_no(diabetes).alias("diabetes_present"),
        assemble.one_zero(diabetes).alias("diabetes_num"),
        "cre_prev",
        "cre_lab_prev",
        "cci_score",
        "stay_days",
        "icu_24h",
    )


def feature_rows(
    tables: Tables, options: ReportOptions, stage: Stage | None = None
) -> DataFrame:
    """All features of the cohort's encounters, before scoring.

    The cohort, its patients' encounters, code and drug sets and the patients' features
    are staged. Their real size then decides whether they are broadcast, and where they
    are not, adaptive execution can split a heavy key on the other side of the join: it
    does so only for sides that come straight out of a shuffle.
    """
    spark = tables["encounters"].sparkSession
    stage = stage or Stage(spark)
    cohort = cohort_encounters(tables, options).select(
        "patient_id",
        "encounter_id",
        "admitted_at",
        "department_id",
        "admit_source_id",
        "account_id",
    )
    kept = stage.keep_all(
        {
            "cohort": cohort,
            "drugs": drug_sets(tables, options),
            "labels": diagnosis_labels(tables, options),
            "coded": coded_conditions(tables, options),
        }
    )
    cohort, drugs, labels = kept["cohort"], kept["drugs"], kept["labels"]
    copies = stage.keep(copies_per_key(cohort, "patient_id", options.per_patient), "patients")
    anchors = anchors_per_day(cohort, "patient_id", "admitted_at", options.per_patient)
    stays = tables["encounters"].join(copies.select("patient_id"), "patient_id", "left_semi")
    stays = stage.keep(
        stays.select(
            "patient_id", "encounter_id", "admitted_at", "status", "class_id", "stay_id"
        ),
        "stays",
    )

    given = drug_exposures(tables, stays, drugs, copies, options, stage)
    therapy = exposure.days_of_therapy(
        given,
        key="patient_id",
        day="day",
        drug="drug",
        flags={"antibiotic": "prev_dot", "beta_lactam": "prev_blactam"},
    )
    features = [
        *stay_features(prior_inpatient(stays, tables, options), tables, anchors, options, stays),
        condition_features(tables, kept["coded"], anchors, cohort, options),
        ventilation_feature(stays, tables, options),
        therapy,
        comorbidity_feature(tables, copies, labels, options),
        *resistance_features(tables, copies, options, stage),
    ]
    people = stage.keep(patient_rows(tables, copies, features, options), "features")
    return assembled(encounter_rows(cohort, tables, options), people, options)


def risk_report(
    tables: Tables, options: ReportOptions, stage: Stage | None = None
) -> DataFrame:
    """The scored report: one row per cohort encounter, see :class:`ReportOptions`.

    Staging jobs run before this returns, and the result reads what they wrote: give a
    ``stage`` of your own, write the result, then remove the stage.
    """
    rows = feature_rows(tables, options, stage)
    scored = score(rows, options.model, score_name="score", pct_name=options.pct_name)
    return scored.select(*REPORT_COLUMNS, "score", options.pct_name)
