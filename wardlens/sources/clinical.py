"""The clinical input tables: their names and columns in the source database and the
names the report uses for them.

Only columns a result depends on are read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlens.sources.tables import catalog_table, parquet_table

# --- fixed values: source tables and columns with the types the report expects ---
# role: (source table, {report column: (source column, type)})
LAYOUT: dict[str, tuple[str, dict[str, tuple[str, str]]]] = {
    "encounters": (
        "PAT_ENC_HSP",
        {
            "patient_id": ("PAT_ID", "string"),
            "encounter_id": ("PAT_ENC_CSN_ID", "bigint"),
            "admitted_at": ("HOSP_ADMSN_TIME", "timestamp_ntz"),
            "status": ("ADT_PATIENT_STAT_C", "int"),
            "class_id": ("ADT_PAT_CLASS_C", "int"),
            "service_id": ("HOSP_SERV_C", "int"),
            "department_id": ("DEPARTMENT_ID", "bigint"),
            "admit_source_id": ("ADMIT_SOURCE_C", "int"),
            "discharge_id": ("DISCH_DISP_C", "int"),
            "account_id": ("HSP_ACCOUNT_ID", "bigint"),
            "stay_id": ("INPATIENT_DATA_ID", "bigint"),
        },
    ),
    "patients": (
        "PATIENT",
        {
            "patient_id": ("PAT_ID", "string"),
            "first_name": ("PAT_FIRST_NAME", "string"),
            "last_name": ("PAT_LAST_NAME", "string"),
            "birth_date": ("BIRTH_DATE", "date"),
            "sex_id": ("SEX_C", "int"),
            "record_number": ("PAT_MRN_ID", "string"),
        },
    ),
    "sexes": ("ZC_SEX", {"sex_id": ("RCPT_MEM_SEX_C", "int"), "sex": ("NAME", "string")}),
    "services": (
        "ZC_PAT_SERVICE",
        {"service_id": ("HOSP_SERV_C", "int"), "service": ("NAME", "string")},
    ),
    "departments": (
        "CLARITY_DEP",
        {
            "department_id": ("DEPARTMENT_ID", "bigint"),
            "facility": ("EXTERNAL_NAME", "string"),
            "unit": ("DEPARTMENT_NAME", "string"),
        },
    ),
    "admit_sources": (
        "ZC_ADM_SOURCE",
        {"admit_source_id": ("ADMIT_SOURCE_C", "int"), "admit_source": ("NAME", "string")},
    ),
    "stay_lengths": (
        "LENGTH_OF_STAY",
        {
            "encounter_id": ("PAT_ENC_CSN_ID", "bigint"),
            "stay_days": ("LENGTH_OF_STAY_DAYS", "keep"),
        },
    ),
    "discharges": (
        "ZC_DISCH_DISP",
        {"discharge_id": ("DISCH_DISP_C", "int"), "discharge": ("NAME", "string")},
    ),
    "accounts": (
        "HSP_ACCOUNT",
        {
            "account_id": ("HSP_ACCOUNT_ID", "bigint"),
            "financial_class_id": ("ACCT_FIN_CLASS_C", "int"),
        },
    ),
    "financial_classes": (
        "ZC_FINANCIAL_CLASS",
        {
            "financial_class_id": ("FINANCIAL_CLASS", "int"),
            "financial_class": ("NAME", "string"),
        },
    ),
    "icu_stays": (
        "F_PAT_ICU_LOCATION",
        {
            "encounter_id": ("PAT_ENC_CSN_ID", "bigint"),
            "entered_at": ("IN_DTTM", "timestamp_ntz"),
            "left_at": ("OUT_DTTM", "timestamp_ntz"),
        },
    ),
    "class_map": (
        "HSD_BASE_CLASS_MAP",
        {
            "class_id": ("ACCT_CLASS_MAP_C", "int"),
            "base_class": ("BASE_CLASS_MAP_C", "int"),
        },
    ),
    "problems": (
        "PROBLEM_LIST",
        {
            "patient_id": ("PAT_ID", "string"),
            "dx_id": ("DX_ID", "bigint"),
            "noted_on": ("NOTED_DATE", "keep"),
            "ended_on": ("NOTED_END_DATE", "keep"),
        },
    ),
    "diagnoses": (
        "CLARITY_EDG",
        {
            "dx_id": ("DX_ID", "bigint"),
            "icd_list": ("CURRENT_ICD10_LIST", "string"),
            "dx_code": ("REF_BILL_CODE", "string"),
            "dx_name": ("DX_NAME", "string"),
            "parent_dx_id": ("PARENT_DX_ID", "bigint"),
        },
    ),
    "value_sets": (
        "GROUPER_DX_RECORDS",
        {"dx_id": ("CMPL_DX_RECS_ID", "bigint"), "set_id": ("GROUPER_ID", "string")},
    ),
    "vent_episodes": (
        "F_VENT_EPISODES",
        {
            "patient_id": ("PAT_ID", "string"),
            "vent_id": ("VENT_START_FSD_ID", "bigint"),
            "stay_id": ("INPATIENT_DATA_ID", "bigint"),
        },
    ),
    "drug_catalog": (
        "V_CUBE_D_MEDICATION",
        {
            "medication_id": ("MEDICATION_ID", "bigint"),
            "medication_name": ("MEDICATION_NAME", "string"),
            "therapeutic_class": ("THERAPEUTIC_CLASS", "string"),
            "pharmaceutical_class": ("PHARMACEUTICAL_CLASS", "string"),
        },
    ),
    "drug_names": (
        "RX_MED_THREE",
        {
            "medication_id": ("MEDICATION_ID", "bigint"),
            "short_name": ("IMPORTED_SHORT_NAME", "string"),
            "full_name": ("MEDICATION_NAME", "string"),
        },
    ),
    "drug_classes": (
        "CLARITY_MEDICATION",
        {
            "medication_id": ("MEDICATION_ID", "bigint"),
            "class_code": ("THERA_CLASS_C", "string"),
        },
    ),
    "drug_orders": (
        "ORDER_MED",
        {
            "order_id": ("ORDER_MED_ID", "bigint"),
            "encounter_id": ("PAT_ENC_CSN_ID", "bigint"),
            "patient_id": ("PAT_ID", "string"),
            "medication_id": ("MEDICATION_ID", "bigint"),
            "ordered_at": ("ORDER_INST", "timestamp_ntz"),
            "ordering_mode": ("ORDERING_MODE_C", "int"),
            "order_class": ("ORDER_CLASS_C", "int"),
            "provider_type": ("PROVIDER_TYPE_C", "int"),
            "order_route": ("MED_ROUTE_C", "int"),
        },
    ),
    "administrations": (
        "MAR_ADMIN_INFO",
        {
            "order_id": ("ORDER_MED_ID", "bigint"),
            "taken_at": ("TAKEN_TIME", "timestamp_ntz"),
            "action_id": ("MAR_ACTION_C", "int"),
            "route_id": ("ROUTE_C", "int"),
        },
    ),
    "routes": (
        "ZC_ADMIN_ROUTE",
        {"route_id": ("MED_ROUTE_C", "int"), "title": ("TITLE", "string")},
    ),
    "lab_orders": (
        "ORDER_PROC",
        {
            "order_id": ("ORDER_PROC_ID", "bigint"),
            "encounter_id": ("PAT_ENC_CSN_ID", "bigint"),
            "patient_id": ("PAT_ID", "string"),
            "procedure_id": ("PROC_ID", "bigint"),
            "order_type": ("ORDER_TYPE_C", "int"),
        },
    ),
    "specimens": (
        "ORDER_PROC_2",
        {
            "order_id": ("ORDER_PROC_ID", "bigint"),
            "taken_at": ("SPECIMN_TAKEN_TIME", "timestamp_ntz"),
        },
    ),
    "procedures": (
        "CLARITY_EAP",
        {"procedure_id": ("PROC_ID", "bigint"), "procedure_code": ("PROC_CODE", "string")},
    ),
    "procedure_dates": (
        "CLARITY_EAP_OT",
        {"procedure_id": ("PROC_ID", "bigint"), "contact_on": ("CONTACT_DATE", "keep")},
    ),
    "seen_diagnoses": (
        "F_DIAGNOSIS_INFO",
        {
            "patient_id": ("PAT_ID", "string"),
            "dx_id": ("DX_ID", "bigint"),
            "last_seen_on": ("LAST_DATE_ENC_DX", "date"),
        },
    ),
    "diagnosis_codes": (
        "V_CUBE_D_DIAGNOSIS",
        {"dx_id": ("DIAGNOSIS_ID", "bigint"), "code": ("DIAGNOSIS_CODE", "string")},
    ),
    "results": (
        "RES_DB_MAIN",
        {"result_id": ("RESULT_ID", "bigint"), "order_id": ("RES_ORDER_ID", "bigint")},
    ),
    "result_lines": (
        "RES_COMPONENTS",
        {
            "result_id": ("RESULT_ID", "bigint"),
            "component_id": ("COMPONENT_ID", "bigint"),
            "line": ("LINE", "int"),
        },
    ),
    "result_values": (
        "ORDER_RESULTS",
        {
            "order_id": ("ORDER_PROC_ID", "bigint"),
            "component_id": ("COMPONENT_ID", "bigint"),
            "value": ("ORD_VALUE", "string"),
        },
    ),
    "cultures": (
        "RES_MICRO_CULTURE",
        {
            "result_id": ("RESULT_ID", "bigint"),
            "line": ("LINE", "int"),
            "organism_id": ("CULT_ORG_ID", "bigint"),
        },
    ),
    "organisms": (
        "CLARITY_ORGANISM",
        {
            "organism_id": ("ORGANISM_ID", "bigint"),
            "record_type": ("RECORD_TYPE_C", "string"),
            "organism": ("EXTERNAL_NAME", "string"),
        },
    ),
    "infections": (
        "INFECTIONS",
        {
            "patient_id": ("PAT_ID", "string"),
            "infection_type": ("INFECTION_TYPE_C", "string"),
            "infection_status": ("INF_STATUS_C", "string"),
        },
    ),
}


#: Types of columns that keep their source's, where there is no source.
KEPT = {"noted_on": "date", "ended_on": "date", "contact_on": "date"}


def report_columns(df: DataFrame, role: str) -> DataFrame:
    """A source table with the report's column names and types.

    A column that already has its type stays untouched, so filters on it still reach
    the scan.
    """
    present = {field.name.lower(): field.dataType for field in df.schema.fields}
    columns = []
    for name, (source, kind) in LAYOUT[role][1].items():
        column = F.col(source)
        if kind != "keep" and present[source.lower()].simpleString() != kind:
            column = column.cast(kind)
        columns.append(column.alias(name))
    return df.select(*columns)


class Opened(Mapping[str, DataFrame]):
    """The report tables by role, each opened when it is first asked for.

    A site without a table that no wanted feature reads does not need it.
    """

    def __init__(self, open_table: Callable[[str], DataFrame]):
        self.open_table = open_table
        self.tables: dict[str, DataFrame] = {}

    def __getitem__(self, role: str) -> DataFrame:
        if role not in self.tables:
            self.tables[role] = report_columns(self.open_table(LAYOUT[role][0]), role)
        return self.tables[role]

    def __iter__(self) -> Iterator[str]:
        return iter(LAYOUT)

    def __len__(self) -> int:
        return len(LAYOUT)


def load(open_table: Callable[[str], DataFrame]) -> Mapping[str, DataFrame]:
    """All report tables, each source table opened by name with ``open_table``."""
    return Opened(open_table)


def load_catalog(spark: SparkSession, schema: str | None = None) -> Mapping[str, DataFrame]:
    """Report tables from the catalog, ``schema`` being ``catalog.schema``."""
    return load(lambda table: catalog_table(spark, table, schema))


def load_parquet(spark: SparkSession, folder: str) -> Mapping[str, DataFrame]:
    """Report tables from a folder of Parquet files named after the source tables."""
    return load(lambda table: parquet_table(spark, folder, table))


def empty_tables(spark: SparkSession, roles: Iterable[str] = tuple(LAYOUT)) -> dict[str, DataFrame]:
    """Empty report tables, to stand in for sources a site does not have."""
    return {
        role: spark.range(0).select(
            *[
                F.lit(None).cast(KEPT.get(name, "double") if kind == "keep" else kind).alias(name)
                for name, (_, kind) in LAYOUT[role][1].items()
            ]
        )
        for role in roles
    }
