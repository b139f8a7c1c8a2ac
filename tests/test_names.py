"""Names by one rule, and many parts in one search."""

import random

import pytest
from pyspark.sql import functions as F

from wardlens.functions.text import FEW, contains_any, name_key, prefix_pattern, same_name


def test_case_and_blanks_behind_do_not_count(spark):
    names = ["Oral", "ORAL  ", "oral", " oral", "or al", "", "  ", None]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    found = [r[0] for r in df.select(same_name(F.col("n"), "orAL ", "X")).collect()]
    assert found == [True, True, True, False, False, False, False, None]
    assert [r[0] for r in df.select(name_key(F.col("n"))).collect()][:3] == ["ORAL"] * 3
    assert [r[0] for r in df.select(same_name(F.col("n"), " ")).collect()][5:] == [True, True, None]


@pytest.mark.parametrize("count", [1, FEW, FEW + 1, 42, 300])
def test_parts_in_one_search_equal_one_by_one(spark, count):
    draw = random.Random(count)
    letters = "abAB.*+?()[]{}|\\^$-&# \n\t'\"/é🙂1_"
    text = lambda most: "".join(draw.choice(letters) for _ in range(draw.randint(1, most)))
    parts = [text(3 if count < 100 else 5) for _ in range(count)]
    names = [text(12) for _ in range(400)] + [None, ""]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    found = [r[0] for r in df.select(contains_any(F.col("n"), parts)).collect()]
    expected = [None if n is None else any(p.lower() in n.lower() for p in parts) for n in names]
    assert found == expected


def test_an_empty_part_is_in_every_name(spark):
    df = spark.createDataFrame([("a",), ("",), (None,)], "n string")
    parts = ["", *(f"part{i}" for i in range(FEW))]
    assert [r[0] for r in df.select(contains_any(F.col("n"), parts)).collect()] == [True, True, None]


def test_common_beginnings_are_shared_and_longer_parts_left_out():
    assert prefix_pattern(["cefa", "cefi", "cef-b"]) == "cef(?:\\-b|a|i)"
    assert prefix_pattern(["penicillin", "pen", "pencil"]) == "pen"


def test_thousands_of_parts_compile(spark):
    draw = random.Random(5)
    parts = ["".join(draw.choice("abcdefghij") for _ in range(draw.randint(5, 40))) for _ in range(2000)]
    names = [f"x{parts[i]}y" if i % 2 else parts[i][:4] for i in range(100)]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    test = contains_any(F.col("n"), parts)
    assert [r[0] for r in df.select(test).collect()] == [any(p in n for p in parts) for n in names]
    plan = df.where(test)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("RLIKE") == 1 and "contains" not in plan.lower()


def test_padded_names_and_classes_make_the_same_drugs(spark):
    from wardlens.operators.exposure import drug_flags, family_catalog

    def drugs(pad):
        catalog = spark.createDataFrame(
            [(1, "Cefa 1 g", pad("Anti"), pad("beta")), (2, "dry mix", pad("other"), pad("Beta")), (3, "cefa oral", pad("other"), None)],
            "medication_id int, medication_name string, therapeutic_class string, pharmaceutical_class string",
        )
        classes = spark.createDataFrame([(i, "c") for i in (1, 2, 3)], "medication_id int, class_code string")
        short = spark.createDataFrame([(1, pad("Cefa"))], "medication_id int, short_name string")
        names = spark.createDataFrame([(2, pad("Dry Mix"))], "medication_id int, full_name string")
        family = family_catalog(catalog, short, family="ANTI")
        flags = drug_flags(
            classes, catalog, names, family, class_codes=["z"], excluded_prefixes=["dry"], pharm_classes=["BETA"], parts=["mix"]
        )
        return sorted(map(tuple, flags.collect()))

    plain = drugs(lambda name: name)
    assert plain == [(1, "CEFA", True, True), (2, "DRY", False, True), (3, "CEFA", True, False)]
    assert drugs(lambda name: name.upper() + "   ") == plain
