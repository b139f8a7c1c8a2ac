"""The code sets a report runs with, as small tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from wardlens.codes import clinical
from wardlens.operators.exposure import ExposureRules, OrderRules


@dataclass(frozen=True)
class CodeBook:
    """Every code, range, name part and category a report depends on."""

    immune_codes: Sequence[str] = clinical.IMMUNE_CODES
    immune_ranges: Sequence[tuple[str, str]] = clinical.IMMUNE_RANGES
    infection_set: str = clinical.INFECTION_VALUE_SET
    registry_kind: str = clinical.REGISTRY_KIND
    registry_status_left_out: Sequence[str] = clinical.REGISTRY_STATUS_LEFT_OUT
    culture_order_type: int = clinical.CULTURE_ORDER_TYPE
    status_component: int = clinical.STATUS_COMPONENT
    organism_record_type: str = clinical.ORGANISM_RECORD_TYPE
    organism_name_part: str = clinical.ORGANISM_NAME_PART
    antibiotic_family: str = clinical.ANTIBIOTIC_FAMILY
    antibiotic_class_codes: Sequence[str] = clinical.ANTIBIOTIC_CLASS_CODES
    excluded_prefixes: Sequence[str] = clinical.EXCLUDED_DRUG_PREFIXES
    beta_lactam_classes: Sequence[str] = clinical.BETA_LACTAM_CLASSES
    beta_lactam_parts: Sequence[str] = clinical.BETA_LACTAM_NAME_PARTS
    diabetes_parents: Sequence[str] = clinical.DIABETES_PARENTS
    comorbidities: Sequence[tuple[str, int, Sequence[str]]] = clinical.COMORBIDITIES
    procedure_codes: Sequence[str] = ()
    cohort_status: int = clinical.ADMITTED_STATUS
    outpatient_status: int = clinical.OUTPATIENT_STATUS
    inpatient_base_class: int = clinical.INPATIENT_BASE_CLASS
    order_rules: OrderRules = field(
        default_factory=lambda: OrderRules(
            ordering_mode=clinical.ORDERING_MODE_INPATIENT,
            provider_type=clinical.PROVIDER_AUTHORIZING,
            excluded_classes=clinical.EXCLUDED_ORDER_CLASSES,
            routes=clinical.SYSTEMIC_ROUTES,
            route_titles=clinical.SYSTEMIC_ROUTE_TITLES,
        )
    )
    antibiotic_rules: ExposureRules = field(
        default_factory=lambda: ExposureRules(
            excluded_actions=clinical.NOT_GIVEN_ACTIONS, order_patient_in_cohort=True
        )
    )
    beta_lactam_rules: ExposureRules = field(
        default_factory=lambda: ExposureRules(from_stay=True, unknown_route_counts=True)
    )


def category_map(
    spark: SparkSession, categories: Sequence[tuple[str, int, Sequence[str]]]
) -> DataFrame:
    """(priority, category, code) rows, categories in order of precedence."""
    rows = [
        (priority, name, code)
        for priority, (name, _, codes) in enumerate(categories)
        for code in codes
    ]
    return small_table(
        spark,
        {"priority": pa.int32(), "category": pa.string(), "code": pa.string()},
        rows,
    )


def category_weights(
    spark: SparkSession, categories: Sequence[tuple[str, int, Sequence[str]]]
) -> DataFrame:
    """(category, weight) rows."""
    return small_table(
        spark,
        {"category": pa.string(), "weight": pa.int32()},
        [(name, weight) for name, weight, _ in categories],
    )


def code_table(spark: SparkSession, codes: Sequence[str], name: str = "code") -> DataFrame:
    """One column of codes."""
    return small_table(spark, {name: pa.string()}, [(code,) for code in codes])


def small_table(
    spark: SparkSession, columns: dict[str, pa.DataType], rows: Sequence[tuple]
) -> DataFrame:
    """A literal table whose size Spark knows, so joins with it can choose a broadcast."""
    schema = pa.schema(list(columns.items()))
    arrays = [
        pa.array([row[i] for row in rows], type=kind)
        for i, kind in enumerate(columns.values())
    ]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, schema=schema))
