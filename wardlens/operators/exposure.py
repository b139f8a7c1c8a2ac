"""Drug catalogs, drug administrations and days of therapy."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardlens.functions.text import contains_any, first_token, name_key, same_name, starts_with_any
from wardlens.functions.times import day_not_after, day_not_before
from wardlens.operators.prefilter import reduce_by_ids


# ---- catalogs -------------------------------------------------------------


def catalog_terms(catalog: DataFrame, term: Column, where: Column) -> DataFrame:
    """Distinct names in ``term`` of the catalog rows that satisfy ``where``."""
    return catalog.where(where).select(name_key(term).alias("term")).distinct()


def match_first_token(
    catalog: DataFrame, terms: DataFrame, name: str, trim: bool = True
) -> DataFrame:
    """Catalog rows whose first word is one of ``terms``."""
    return catalog.join(
        terms, first_token(F.col(name), trim) == F.col("term"), "left_semi"
    )


def union_distinct(first: DataFrame, *rest: DataFrame) -> DataFrame:
    """Distinct rows of all inputs, matched by position."""
    for other in rest:
        first = first.union(other)
    return first.distinct()


def in_or(df: DataFrame, column: str, keys: DataFrame, key: str, other: Column) -> DataFrame:
    """Rows whose ``column`` is among ``keys`` or for which ``other`` holds.

    One pass over ``df``: the distinct keys bring a mark, and the filter looks at both.
    """
    mark = "is_member"
    while mark in df.columns:
        mark = f"_{mark}"
    members = keys.select(F.col(key).alias(column)).distinct().withColumn(mark, F.lit(True))
    kept = F.coalesce(other, F.lit(False)) | F.coalesce(F.col(mark), F.lit(False))
    return df.join(members, column, "left").where(kept).select(*df.columns)


def family_catalog(
    catalog: DataFrame, short_names: DataFrame, *, family: str
) -> DataFrame:
    """Drugs named like a member of a therapeutic family.

    A drug belongs when its first word is a short name of a family member, or when
    its untrimmed first word is also that of a family member.
    """
    members = same_name(F.col("therapeutic_class"), family)
    drugs = catalog.select("medication_id", "medication_name")
    by_short_name = match_first_token(
        drugs,
        catalog_terms(
            catalog.join(short_names.select("medication_id", "short_name"), "medication_id"),
            F.col("short_name"),
            members,
        ),
        "medication_name",
    )
    by_first_word = match_first_token(
        drugs,
        catalog_terms(catalog, first_token(F.col("medication_name"), trim=False), members),
        "medication_name",
        trim=False,
    )
    return union_distinct(by_short_name, by_first_word)


def named_like(catalog: DataFrame, name: str, parts: Sequence[str]) -> DataFrame:
    """Catalog rows whose name holds any of ``parts``."""
    return catalog.where(contains_any(F.col(name), parts))


def drug_flags(
    classes: DataFrame,
    catalog: DataFrame,
    names: DataFrame,
    family: DataFrame,
    *,
    class_codes: Sequence[str],
    excluded_prefixes: Sequence[str],
    pharm_classes: Sequence[str],
    parts: Sequence[str],
) -> DataFrame:
    """(medication_id, drug) with the flags ``antibiotic`` and ``beta_lactam``.

    An antibiotic is in ``family`` or has a therapy class code, and its name starts
    with none of the prefixes. A beta-lactam has a pharmaceutical class or a name part,
    the name taken from the name table or from ``family``. ``drug`` is the first word
    of the catalog name, empty for a drug missing from the catalog.
    """
    marks = (
        family.select(
            "medication_id",
            F.lit(True).alias("in_family"),
            contains_any(F.col("medication_name"), parts).alias("named"),
        )
        .union(
            names.select("medication_id", F.lit(False), contains_any(F.col("full_name"), parts))
        )
        .groupBy("medication_id")
        .agg(F.max("in_family").alias("in_family"), F.max("named").alias("named"))
    )
    known = classes.select("medication_id", "class_code").join(
        catalog.select("medication_id", "medication_name", "pharmaceutical_class"),
        "medication_id",
    )
    name = F.col("medication_name")
    member = F.col("in_family") | F.col("class_code").isin(list(class_codes))
    antibiotic = member & ~starts_with_any(name, excluded_prefixes)
    beta_lactam = F.col("named") | same_name(F.col("pharmaceutical_class"), *pharm_classes)
    no = F.lit(False)
    return (
        known.join(marks, "medication_id", "full_outer")
        .select(
            "medication_id",
            F.coalesce(first_token(name), F.lit("")).alias("drug"),
            F.coalesce(antibiotic, no).alias("antibiotic"),
            F.coalesce(beta_lactam, no).alias("beta_lactam"),
        )
        .where("antibiotic OR beta_lactam")
        .groupBy("medication_id", "drug")
        .agg(
            F.max("antibiotic").alias("antibiotic"), F.max("beta_lactam").alias("beta_lactam")
        )
    )


# ---- administrations ------------------------------------------------------


@dataclass(frozen=True)
class OrderRules:
    """Which orders count, whatever the drug set."""

    ordering_mode: int = 2
    provider_type: int = 1
    excluded_classes: tuple[int, ...] = ()
    routes: tuple[int, ...] = ()
    route_titles: tuple[str, ...] = ()


@dataclass(frozen=True)
class ExposureRules:
    """What one drug set adds to the order rules.

    ``oldest_day`` bounds the order day: days back from ``as_of``, or from the
    admission of the stay the order belongs to with ``from_stay``.
    """

    oldest_day: int = 367
    newest_day: int = 2
    from_stay: bool = False
    excluded_actions: tuple[int, ...] = ()
    unknown_route_counts: bool = False
    order_patient_in_cohort: bool = False


def exposures(
    orders: DataFrame,
    administrations: DataFrame,
    stays: DataFrame,
    routes: DataFrame,
    drugs: DataFrame,
    cohort_keys: DataFrame,
    *,
    as_of: datetime,
    order_rules: OrderRules,
    rules: Mapping[str, ExposureRules],
    patients: DataFrame | None = None,
    earliest: datetime | None = None,
    keep: Callable[[DataFrame, str], DataFrame] | None = None,
) -> DataFrame:
    """(patient, encounter, day, drug) given to the patients of ``stays``, unmerged.

    ``stays`` are the cohort patients' encounters, ``drugs`` has a boolean column per rule
    set for each (medication_id, drug). One boolean column per rule set tells which sets a
    row counts for, so that orders and administrations are read and joined once for all.

    With ``patients``, the patient a rule goes by (the order's, with
    ``order_patient_in_cohort``, else the stay's) must be one of them. ``earliest`` is the
    first admission of ``stays``, which bounds the orders; ``keep`` stages the wanted orders,
    so that their real size decides how the administrations are joined, and filters them by
    the orders' ids where those are too many to broadcast.
    """
    newest = max(as_of - timedelta(days=rule.newest_day) for rule in rules.values())
    wanted = orders.where(
        (F.col("ordering_mode") == order_rules.ordering_mode)
        & ~F.col("order_class").isin(list(order_rules.excluded_classes))
        & (F.col("provider_type") == order_rules.provider_type)
        & day_not_after(orders, "ordered_at", newest)
    )
    starts = [(earliest if rule.from_stay else as_of, rule.oldest_day) for rule in rules.values()]
    if all(start for start, _ in starts):
        oldest = min(start - timedelta(days=days) for start, days in starts)
        wanted = wanted.where(day_not_before(orders, "ordered_at", oldest))
    wanted = wanted.withColumnRenamed("patient_id", "order_patient")
    own = stays.select("encounter_id", "patient_id", "admitted_at")
    members = cohort_keys.select("patient_id")
    if patients is None:
        own = own.withColumn("known", F.lit(True))
    else:
        known = patients.select("patient_id").distinct()
        own = own.join(known.withColumn("known", F.lit(True)), "patient_id", "left")
        members = members.join(known, "patient_id", "left_semi")
    wanted = wanted.join(drugs, "medication_id").join(own, "encounter_id")
    if any(rule.order_patient_in_cohort for rule in rules.values()):
        members = members.select(
            F.col("patient_id").alias("order_patient"), F.lit(True).alias("in_cohort")
        )
        wanted = wanted.join(members, "order_patient", "left")
    if keep:
        wanted = keep(wanted, "wanted-orders")
    if keep:
        administrations = reduce_by_ids(administrations, "order_id", wanted.select("order_id"))
    given = (
        administrations.where(F.col("taken_at").isNotNull())
        .select("order_id", "taken_at", "action_id", "route_id")
        .join(routes.select("route_id", "title"), "route_id", "left")
    )
    rows = wanted.join(given, "order_id")

    named_route = same_name(F.col("title"), *order_rules.route_titles)
    known_route = F.col("order_route").isin(list(order_rules.routes)) | named_route
    unknown_route = F.col("title").isNull() & F.col("order_route").isNull()
    order_day = F.to_date("ordered_at").cast("timestamp_ntz")

    flags = []
    for name, rule in rules.items():
        test = F.col(name)
        if rule.from_stay:
            floor = F.col("admitted_at") - F.expr(f"INTERVAL {int(rule.oldest_day)} DAYS")
        else:
            moment = as_of - timedelta(days=rule.oldest_day)
            floor = F.expr(f"timestamp_ntz'{moment.isoformat(sep=' ')}'")
        last = as_of - timedelta(days=rule.newest_day)
        ceiling = F.expr(f"timestamp_ntz'{last.isoformat(sep=' ')}'")
        test = test & (order_day >= floor) & (order_day <= ceiling)
        route = known_route | unknown_route if rule.unknown_route_counts else known_route
        test = test & route
        if rule.excluded_actions:
            test = test & ~F.col("action_id").isin(list(rule.excluded_actions))
        test = test & F.col("in_cohort" if rule.order_patient_in_cohort else "known")
        flags.append(F.coalesce(test, F.lit(False)).alias(name))
    kept = reduce(or_, (F.col(name) for name in rules))
    return rows.select(
        "patient_id", "encounter_id", F.to_date("taken_at").alias("day"), "drug", *flags
    ).where(kept)


def merged(rows: DataFrame, keys: Sequence[str], flags: Sequence[str]) -> DataFrame:
    """One row per ``keys`` with each flag true where it is on some row."""
    return rows.groupBy(*keys).agg(*[F.max(flag).alias(flag) for flag in flags])


# ---- days of therapy ------------------------------------------------------


def exposure_days(rows: DataFrame, *columns: str) -> DataFrame:
    """Distinct exposure days: one row per combination of ``columns``."""
    return rows.select(*columns).distinct()


def days_of_therapy(
    rows: DataFrame, *, key: str, day: str, drug: str, flags: Mapping[str, str]
) -> DataFrame:
    """Distinct (day, drug) pairs per key, one count per flag column.

    ``flags`` maps a boolean column to the name of its count; a count without any
    day is null. Pairs are merged on (key, day, drug) first, which spreads a key
    with many rows over its days and drugs.
    """
    named = rows.withColumn(drug, F.coalesce(drug, F.lit("")))
    pairs = merged(named, [key, day, drug], list(flags))
    counts = [F.count_if(F.col(flag)) for flag in flags]
    return pairs.groupBy(key).agg(
        *[
            F.when(count > 0, count).alias(name)
            for count, name in zip(counts, flags.values(), strict=True)
        ]
    )


def current_stay_days(rows: DataFrame, cohort: DataFrame, *, encounter: str, day: str) -> DataFrame:
    """Distinct exposure days that belong to a cohort encounter."""
    return exposure_days(rows, encounter, day).join(
        cohort.select(encounter), encounter, "left_semi"
    )
