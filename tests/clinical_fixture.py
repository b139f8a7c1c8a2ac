"""Invented patients with the edge cases of every report input.

The report runs at 2024-02-23 08:30: the cohort day is 2024-02-22, prior stays lie on
2023-02-21 .. 2024-02-21.
"""

from __future__ import annotations

from datetime import date, datetime

import pyarrow as pa

from wardlens.sources.clinical import KEPT, LAYOUT, load

AS_OF = datetime(2024, 2, 23, 8, 30)

TYPES = {
    "string": pa.string(),
    "bigint": pa.int64(),
    "int": pa.int32(),
    "timestamp_ntz": pa.timestamp("us"),
    "date": pa.date32(),
    "keep": pa.float64(),
}


def at(text: str) -> datetime:
    return datetime.fromisoformat(text)


def day(text: str) -> date:
    return date.fromisoformat(text)


INPATIENT, OUTPATIENT = 101, 102


def encounter(patient, eid, moment, status=2, kind=INPATIENT, **more):
    return {
        "patient_id": patient,
        "encounter_id": eid,
        "admitted_at": at(moment) if moment else None,
        "status": status,
        "class_id": kind,
        "stay_id": None if eid is None else eid + 50000,
        **more,
    }


ENCOUNTERS = [
    # Cohort: any time of 2024-02-22, status 2, with an id.
    encounter("P1", 1001, "2024-02-22 10:00", department_id=7, admit_source_id=1, account_id=901),
    encounter("P2", 2001, "2024-02-22 00:00:00", account_id=902),
    encounter("P2", 2002, "2024-02-22 23:59:59", department_id=99, account_id=999),
    encounter("P3", 3001, "2024-02-22 08:00"),
    encounter("P4", 4001, "2024-02-22 12:00"),
    encounter("P5", 5001, "2024-02-22 12:00"),
    # Not in the cohort.
    encounter("P6", 6001, "2024-02-21 23:59:59"),
    encounter("P6", 6002, "2024-02-23 00:00:00"),
    encounter("P6", 6003, "2024-02-22 09:00", status=6),
    encounter("P6", 6004, "2024-02-22 09:00", status=None),
    encounter("P6", None, "2024-02-22 09:00"),
    # Prior stays of P1: both window edges count, the others do not.
    encounter("P1", 1101, "2023-02-21 00:00:00", status=3),
    encounter("P1", 1102, "2024-02-21 23:59:59", status=3),
    encounter("P1", 1103, "2023-02-20 23:59:59", status=3),
    encounter("P1", 1105, "2023-06-01 10:00", status=6),
    encounter("P1", 1106, "2023-06-02 10:00", status=3, kind=OUTPATIENT),
    encounter("P1", 1107, "2023-06-03 10:00", status=None),
    encounter("P2", 2101, "2023-06-01 10:00", status=3),
    encounter("P2", 2102, "2023-07-01 10:00", status=3),
    encounter("P4", 4101, "2023-02-20 23:59:59", status=3),
    encounter("P5", 5101, "2023-06-01 10:00", status=3),
]

PATIENTS = [
    ("P1", "Ada", "One", day("1960-02-23"), 1, "M1"),  # 64 today
    ("P2", "Ben", "Two", day("1990-02-24"), 2, "M2"),  # 34 tomorrow
    ("P3", "Cy", "Three", None, 9, "M3"),  # unknown birth and sex
    ("P4", "Di", "Four", day("2000-01-01"), 1, "M4"),
    ("P5", "Ed", "Five", day("1950-06-30"), 2, "M5"),
    ("P6", "Flo", "Six", day("1950-06-30"), 2, "M6"),
]

DIAGNOSES = [
    # dx_id, icd_list, dx_code, dx_name, parent_dx_id
    (1, "D70", "D70", "listed for immune", 1),
    (2, "B24.1", "B241", "outside B20..B24", None),
    (3, "A41.9", "A419", "in the infection set", None),
    (4, "K72.0", "K720", "liver", 14),
    (5, "E11.9", "E119", "diabetes", 15),
    (6, "I42.6", "I426", "two categories", 16),
    (7, "F31.5", "F315", "two categories", 17),
    (8, "C7A", "C7A", "inside C22..C80", None),
    (9, "K72.0", "K729", "same list, parent of its own", 19),
    (10, "Z00", "Z00", "no parent", None),
]

DIAGNOSIS_CODES = [(14, "K72"), (15, "E11"), (16, "I426"), (17, "F315"), (19, "K73"), (1, None)]

DRUGS = [
    # id, catalog name, therapeutic class, pharmaceutical class
    (1, "Cefazolin 1g", "ANTIBIOTICS", "OTHER"),
    (2, " amoxicillin 500", "OTHER", None),  # leading blank, matched by short name
    (3, "AMOXICILLIN-CLAV", "ANTIBIOTICS", None),
    (4, "METHENAMINE HIPP", "ANTIBIOTICS", None),  # excluded prefix
    (5, "Vancomycin", "ANTIBIOTICS", None),
    (6, "Heparin", "ANTICOAGULANTS", None),
    (8, "Zzz 5", "OTHER", "CARBAPENEM ANTIBIOTICS (THIENAMYCINS)"),
    (9, "Linezolid", "OTHER", None),  # by class code only
    (10, "", "OTHER", None),
]

DRUG_NAMES = [
    # id, short name, full name
    (1, "CEFAZOLIN", "Cefazolin 1g"),
    (2, None, " amoxicillin 500"),
    (3, "amoxicillin", "AMOXICILLIN-CLAV"),
    (5, "VANCOMYCIN", "Vancomycin"),
    (6, "HEPARIN", "Heparin"),
    (7, "PEN", "Pen g benzathine"),  # name table only
]

DRUG_CLASSES = [
    (1, "12"), (2, "99"), (3, "12"), (4, "12"), (5, "12"), (6, "20"), (8, "50"), (9, "12"),
    (10, None),
]


def order(oid, drug, moment, encounter=1101, patient="P1", mode=2, kind=1, provider=1, route=4):
    return (oid, encounter, patient, drug, at(moment), mode, kind, provider, route)


DRUG_ORDERS = [
    order(1, 1, "2023-02-22 00:05"),  # first order day that counts
    order(2, 5, "2024-02-21 23:59"),  # last one
    order(3, 2, "2023-05-01 09:00", route=999),  # counts by route title
    order(4, 9, "2023-05-01 09:00"),
    order(5, 1, "2023-02-21 23:59"),  # too old for antibiotics only
    order(6, 1, "2024-02-22 00:01"),  # too new
    order(7, 4, "2023-05-02 09:00"),
    order(8, 1, "2023-06-01 09:00"),  # action 2: not given
    order(9, 1, "2023-06-02 09:00"),  # no time taken
    order(10, 1, "2023-06-03 09:00", mode=1),
    order(11, 1, "2023-06-04 09:00", kind=3),
    order(12, 1, "2023-06-05 09:00", provider=2),
    order(13, 1, "2023-07-01 09:00", route=None),  # route unknown
    order(14, 7, "2023-08-01 09:00"),
    order(15, 8, "2023-08-01 09:00"),
    order(16, 1, "2023-08-02 09:00", route=999),  # oral
    order(17, 1, "2023-09-01 09:00", patient="PX"),  # another patient's name on the order
    order(18, 1, "2023-10-01 09:00"),  # unknown action
    order(19, 6, "2023-10-02 09:00"),  # no antibiotic
    order(20, 1, "2023-05-01 09:00", encounter=6001, patient="P6"),
    order(21, 1, "2023-05-01 09:00", encounter=2101, patient="P2"),  # one day: ln 1 = 0
]

ADMINISTRATIONS = [
    # order, taken, action, route
    (1, at("2023-02-22 01:00"), 1, 1),
    (1, at("2023-02-22 13:00"), 1, 1),
    (1, at("2023-02-23 01:00"), 1, 1),
    (2, at("2024-02-21 23:59"), 1, 1),
    (3, at("2023-05-01 10:00"), 1, 2),
    (4, at("2023-05-01 11:00"), 1, None),
    (5, at("2023-02-21 23:59"), 1, 1),
    (6, at("2024-02-22 01:00"), 1, 1),
    (7, at("2023-05-02 10:00"), 1, 1),
    (8, at("2023-06-01 10:00"), 2, 1),
    (9, None, 1, 1),
    (10, at("2023-06-03 10:00"), 1, 1),
    (11, at("2023-06-04 10:00"), 1, 1),
    (12, at("2023-06-05 10:00"), 1, 1),
    (13, at("2023-07-01 10:00"), 1, None),
    (14, at("2023-08-01 10:00"), 1, 1),
    (15, at("2023-08-01 10:00"), 1, 1),
    (16, at("2023-08-02 10:00"), 1, 3),
    (17, at("2023-09-01 10:00"), 1, 1),
    (18, at("2023-10-01 10:00"), None, 1),
    (19, at("2023-10-02 10:00"), 1, 1),
    (20, at("2023-05-01 10:00"), 1, 1),
    (21, at("2023-05-01 10:00"), 1, 1),
]


def lab(n, patient, **change):
    """One complete culture chain numbered ``n``; ``change`` breaks one link."""
    link = {
        "order_type": 3,
        "component": 10,
        "value_component": 10,
        "value": "POS",
        "culture_line": 1,
        "organism": 1,
        **change,
    }
    return {
        "lab_orders": (n, n, patient, n, link["order_type"]),
        "specimens": (n, at("2020-01-01 07:05")),
        "results": (n + 100, n),
        "result_lines": (n + 100, link["component"], 1),
        "result_values": (n, link["value_component"], link["value"]),
        "cultures": (n + 100, link["culture_line"], link["organism"]),
    }


LABS = [
    lab(1, "P1"),
    lab(2, "P2", component=164, value_component=164),
    lab(3, "P3", value=None),
    lab(4, "P4", organism=None),
    lab(5, "P5", organism=2),
    lab(6, "P2", culture_line=2),
    lab(7, "P3", order_type=1),
    lab(8, "P4", organism=3),
    lab(9, "P6"),
]

DATA = {
    "encounters": ENCOUNTERS,
    "patients": PATIENTS,
    "sexes": [(1, "Female"), (2, "Male")],
    "services": [(1, "Medicine")],
    "departments": [(7, "North Hospital", "Ward 7")],
    "admit_sources": [(1, "Emergency")],
    "stay_lengths": [
        (1101, 15.8), (1103, 100.0), (2101, 3.0), (2102, 4.0), (5001, 2.0), (5001, 3.0),
    ],
    "discharges": [(1, "Home")],
    "accounts": [(901, 3), (902, None)],
    "financial_classes": [(3, "Medicare")],
    "icu_stays": [
        (1101, at("2023-02-21 23:00"), at("2023-02-22 01:00")),  # one day
        (1102, at("2024-02-21 23:59"), None),  # still in
        (2101, at("2023-06-01 11:00"), at("2023-06-03 09:00")),  # two days
        (5101, at("2023-06-01 11:00"), at("2023-06-01 23:00")),  # zero days: NO
        (4001, at("2024-02-22 12:00"), at("2024-02-23 06:00")),  # at admission
        (4001, at("2024-02-23 12:00"), None),  # exactly 24 h later
        (4001, at("2024-02-23 12:00:01"), None),  # too late
    ],
    "class_map": [(INPATIENT, 1), (OUTPATIENT, 2)],
    "problems": [
        ("P1", 1, day("2024-02-20"), None),
        ("P1", 3, day("2020-01-01"), day("2023-02-21")),
        ("P4", 1, day("2024-02-21"), None),  # noted too late
        ("P4", 3, day("2020-01-01"), day("2023-02-20")),  # ended 367 d ago at 00:00, admitted 12:00
        ("P5", 8, day("2020-01-01"), None),
        ("P2", 2, day("2020-01-01"), None),
        ("P2", 3, day("2020-01-01"), day("2023-02-20")),  # admitted at 00:00: just in
        ("P6", 3, day("2020-01-01"), None),
    ],
    "diagnoses": DIAGNOSES,
    "value_sets": [(3, "1138015"), (1, "999")],
    "vent_episodes": [
        ("P1", 70, 1101 + 50000),
        ("P4", 71, 1101 + 50000),  # another patient's stay
        ("P4", 72, 4101 + 50000),  # stay out of window
        ("P5", 73, 5101 + 50000),
        ("P5", None, 5101 + 50000),
        ("P2", None, 2101 + 50000),
    ],
    "drug_catalog": DRUGS,
    "drug_names": DRUG_NAMES,
    "drug_classes": DRUG_CLASSES,
    "drug_orders": DRUG_ORDERS,
    "administrations": ADMINISTRATIONS,
    "routes": [(1, None), (2, "Intravenous"), (3, "ORAL")],
    "procedures": [(1, "GI47")],
    "procedure_dates": [(1, day("2024-01-01"))],
    "seen_diagnoses": [
        ("P1", 4, day("2024-01-01")),
        ("P1", 5, day("2024-01-01")),
        ("P1", 10, day("2024-01-01")),
        ("P4", 6, day("2023-02-23")),  # first day that counts
        ("P4", 7, day("2024-02-23")),
        ("P4", 4, day("2023-02-22")),  # one day too old
        ("P6", 4, day("2024-01-01")),
    ],
    "diagnosis_codes": DIAGNOSIS_CODES,
    "organisms": [(1, "4", "cre E. coli"), (2, "3", "CRE K. pneumoniae"), (3, "4", "E. coli")],
    "infections": [
        ("P1", "85", "1"),
        ("P2", "85", "2"),
        ("P3", "85", "4"),
        ("P4", "85", None),
        ("P5", "12", "1"),
        ("PX", "85", "1"),
    ],
    **{role: [chain[role] for chain in LABS] for role in LABS[0]},
}


def source_table(spark, role):
    """A fixture table under the names and types of the source database."""
    columns = LAYOUT[role][1]
    records = DATA[role]
    arrays, names = [], []
    for position, (name, (source, kind)) in enumerate(columns.items()):
        values = [r.get(name) if isinstance(r, dict) else r[position] for r in records]
        arrays.append(pa.array(values, type=TYPES[KEPT.get(name, kind)]))
        names.append(source)
    return spark.createDataFrame(pa.Table.from_arrays(arrays, names=names))


def clinical_tables(spark):
    roles = {table: role for role, (table, _) in LAYOUT.items()}
    return load(lambda table: source_table(spark, roles[table]))
