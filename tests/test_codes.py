from wardlens.codes import clinical
from wardlens.codes.codebook import CodeBook, category_map, category_weights
from wardlens.operators import comorbid


def test_sizes_of_the_sets():
    listed = [code for _, _, codes in CodeBook().comorbidities for code in codes]
    assert len(listed) == 399 and len(set(listed)) == 397
    assert len(CodeBook().comorbidities) == 31
    assert len(clinical.IMMUNE_CODES) == 54 and len(clinical.IMMUNE_RANGES) == 8
    assert len(clinical.BETA_LACTAM_NAME_PARTS) == 42
    assert len(clinical.SYSTEMIC_ROUTES) == 34
    assert len(set(clinical.NOT_GIVEN_ACTIONS)) == 38 and clinical.NOT_GIVEN_ACTIONS[-1] == 99
    assert len(clinical.EXCLUDED_DRUG_PREFIXES) == 33
    assert len(clinical.BETA_LACTAM_CLASSES) == 8
    assert clinical.DIABETES_PARENTS == tuple(f"E{n}" for n in range(10, 17))


def test_first_category_wins_like_a_search_in_order(spark):
    categories = CodeBook().comorbidities
    resolved = {
        r.code: r.category for r in comorbid.first_match(category_map(spark, categories)).collect()
    }
    every_code = {code for _, _, codes in categories for code in codes}
    expected = {
        code: next(name for name, _, codes in categories if code in codes) for code in every_code
    }
    assert resolved == expected
    assert resolved["I426"] == "chf" and resolved["F315"] == "psy"


def test_index_counts_a_category_once(spark, rows):
    categories = CodeBook().comorbidities
    codes = rows("patient string, code string", [
        ("a", "I50"), ("a", "I43"), ("a", "E66"), ("b", "zzz"), ("b", None), ("c", "C77"),
    ])
    tagged = comorbid.categorize(codes, comorbid.first_match(category_map(spark, categories)), "code")
    once = tagged.select("patient", "category").distinct()
    index = comorbid.weighted_index(
        comorbid.weigh(once, category_weights(spark, categories)), "patient", "cci"
    )
    assert dict(map(tuple, index.collect())) == {"a": 3, "b": 0, "c": 12}
