"""Operators against brute force, with one key holding much of the rows."""

import random
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from wardlens.codes import models
from wardlens.operators import assemble, comorbid, exposure, flags, lookback
from wardlens.operators.cohort import anchors_per_day, copies_per_key, keep_cohort_keys
from wardlens.operators.score import score, score_versions

START = datetime(2024, 1, 1)


def random_key(rng):
    """A third of all rows belong to one key."""
    return "hot" if rng.random() < 1 / 3 else f"k{rng.randrange(8)}"


@pytest.fixture(scope="module")
def record(spark):
    """A random cohort, prior items, amounts, episodes and conditions."""
    rng = random.Random(7)
    cohort = [
        (random_key(rng), START + timedelta(hours=rng.randrange(24 * 12))) for _ in range(40)
    ]
    prior = [(random_key(rng), rng.randrange(60)) for _ in range(90)]
    amounts = [(rng.randrange(70), float(rng.randrange(9))) for _ in range(120)]
    episodes = []
    for _ in range(120):
        begin = START - timedelta(hours=rng.randrange(24 * 400))
        end = begin + timedelta(hours=rng.randrange(90)) if rng.random() < 0.9 else None
        episodes.append((rng.randrange(70), begin, end))
    conditions = []
    for _ in range(300):
        noted = date(2024, 1, 10) - timedelta(days=rng.randrange(500))
        ended = noted + timedelta(days=rng.randrange(-500, 300)) if rng.random() < 0.8 else None
        conditions.append((random_key(rng), rng.randrange(12), noted, ended))
    data = {
        "cohort": (cohort, "key string, admitted timestamp_ntz"),
        "prior": (prior, "key string, item int"),
        "amounts": (amounts, "item int, amount double"),
        "episodes": (episodes, "item int, begin timestamp_ntz, finish timestamp_ntz"),
        "conditions": (conditions, "key string, code int, noted date, ended date"),
    }
    frames = {name: spark.createDataFrame(rows, schema) for name, (rows, schema) in data.items()}
    return {name: rows for name, (rows, _) in data.items()}, frames


def as_dict(df):
    return {row[0]: tuple(row)[1:] for row in df.collect()}


def test_prior_count(record):
    data, df = record
    copies = copies_per_key(df["cohort"], "key")
    counts = lookback.count_per_key(df["prior"], "key", "item", "n")
    found = lookback.times_copies(keep_cohort_keys(counts, copies, "key"), copies, "key", ["n"])
    expected = {}
    for key, _ in data["cohort"]:
        for other, _ in data["prior"]:
            if key == other:
                expected[key] = (expected.get(key, (0,))[0] + 1,)
    assert as_dict(found) == expected


@pytest.mark.parametrize("with_copies", [True, False])
def test_total_and_mean(record, with_copies):
    data, df = record
    copies = copies_per_key(df["cohort"], "key")
    found = lookback.total_and_mean(
        df["prior"],
        df["amounts"],
        key="key",
        item="item",
        amount="amount",
        total_name="total",
        mean_name="mean",
        copies=copies if with_copies else None,
    )
    outer = [key for key, _ in data["cohort"]] if with_copies else sorted({k for k, _ in data["prior"]})
    totals, items = {}, {}
    for key in outer:
        for other, item in data["prior"]:
            if key == other:
                items.setdefault(key, set()).add(item)
                totals[key] = totals.get(key, 0) + sum(a for i, a in data["amounts"] if i == item)
    assert as_dict(found) == {k: (totals[k], totals[k] / len(items[k])) for k in totals}


def test_total_of_nothing_is_zero(rows):
    found = lookback.total_and_mean(
        rows("key string, item int", [("a", 1), ("b", 2)]),
        rows("item int, amount double", [(2, None), (3, 1.0)]),
        key="key",
        item="item",
        amount="amount",
        total_name="total",
        mean_name="mean",
    )
    assert as_dict(found) == {"a": (0.0, 0.0), "b": (0.0, 0.0)}


def test_episode_days(record):
    data, df = record
    anchors = anchors_per_day(df["cohort"], "key", "admitted")
    found = lookback.episode_days(
        df["prior"], df["episodes"], anchors,
        key="key", item="item", start="begin", end="finish", name="days",
    )
    expected = {}
    again = [(k, i) for k, _ in data["cohort"] for other, i in data["prior"] if k == other]
    for key, admitted in data["cohort"]:
        for other, item in again:
            for i, begin, finish in data["episodes"]:
                if key == other and item == i:
                    if begin.date() >= (admitted - timedelta(days=367)).date():
                        days = abs((finish.date() - begin.date()).days) if finish else None
                        seen = expected.get(key)
                        expected[key] = seen if days is None else (seen or 0) + days
    assert as_dict(found) == {key: (days,) for key, days in expected.items()}


def test_active_flags(record):
    data, df = record
    spark = df["cohort"].sparkSession
    coded = spark.createDataFrame(
        [(1, True, False), (2, True, True), (3, False, True)], "code int, first boolean, second boolean"
    )
    anchors = anchors_per_day(df["cohort"], "key", "admitted")
    found = flags.active_flags(
        df["conditions"], coded, anchors,
        key="key", code_id="code", noted="noted", ended="ended", flags=["first", "second"],
    )

    def midnight(d):
        return datetime(d.year, d.month, d.day)

    expected = {}
    for key, admitted in data["cohort"]:
        for other, code, noted, ended in data["conditions"]:
            active = midnight(noted) <= admitted - timedelta(days=2) and (
                ended is None or midnight(ended) >= admitted - timedelta(days=367)
            )
            if key == other and active:
                one, two = expected.get(key, (None, None))
                if code in (1, 2, 3):
                    expected[key] = (
                        1 if code in (1, 2) else one,
                        1 if code in (2, 3) else two,
                    )
    assert as_dict(found) == expected


def test_stack_flags(rows):
    first, second = rows("id int", [(1,), (1,), (2,)]), rows("id int", [(2,), (3,)])
    stacked = flags.stack_flags({"a": first, "b": second}, "id")
    assert as_dict(stacked) == {1: (True, False), 2: (True, True), 3: (False, True)}


def test_code_ranges_are_text_ranges(rows):
    codes = rows("code string", [(c,) for c in ("B20", "B24", "B24.1", "C7A", "C80", "C80.1")])
    kept = codes.where(flags.code_in(F.col("code"), [], [("B20", "B24"), ("C22", "C80")]))
    assert [r.code for r in kept.collect()] == ["B20", "B24", "C7A", "C80"]


def test_registry_leaves_out_unknown_status(rows):
    registry = rows(
        "key string, kind string, status string",
        [("a", "85", "1"), ("a", "85", "1"), ("b", "85", None), ("c", "85", "2"), ("d", "9", "1")],
    )
    found = flags.registry_keys(
        registry, key="key", kind="kind", kind_is="85", status="status", status_not=["2", "4"]
    )
    assert [r.key for r in found.collect()] == ["a"]


def test_days_of_therapy_counts_pairs_and_null_drugs_once(rows):
    given = rows(
        "key string, day date, drug string, a boolean, b boolean",
        [
            ("x", date(2024, 1, 1), "D", True, False),
            ("x", date(2024, 1, 1), "D", False, True),
            ("x", date(2024, 1, 1), None, True, False),
            ("x", date(2024, 1, 1), "", True, False),
            ("x", date(2024, 1, 2), "D", True, False),
            ("y", date(2024, 1, 1), "D", False, True),
        ],
    )
    found = exposure.days_of_therapy(
        given, key="key", day="day", drug="drug", flags={"a": "n_a", "b": "n_b"}
    )
    assert as_dict(found) == {"x": (3, 1), "y": (None, 1)}


def test_in_or_keeps_repeats_of_rows_not_of_keys(rows):
    df = rows("id int, flag string", [(1, "n"), (1, "n"), (2, "R"), (3, "n"), (None, "R"), (None, "n")])
    keys = rows("k int", [(1,), (1,)])
    kept = exposure.in_or(df, "id", keys, "k", F.col("flag") == "R")
    assert sorted(map(tuple, kept.collect()), key=str) == [(1, "n"), (1, "n"), (2, "R"), (None, "R")]


def test_parents_are_shared_within_a_group(rows):
    diagnoses = rows(
        "dx int, icd string, parent int", [(1, "A", 10), (2, "A", 11), (3, "B", None), (4, "C", 12)]
    )
    codes = rows("dx int, code string", [(10, "P"), (11, "Q"), (12, None)])
    parents = comorbid.parent_codes(
        diagnoses, codes, group="icd", parent="parent", code_id="dx", code="code"
    )
    assert sorted(map(tuple, parents.collect())) == [("A", "P"), ("A", "Q")]
    seen = rows("patient string, dx int", [("x", 1), ("x", 1), ("x", 3), ("y", 4)])
    rolled = comorbid.rollup_to_parent(
        seen, diagnoses.select("dx", "icd"), parents, code_id="dx", group="icd"
    ).select("patient", "dx", "parent_code")
    assert sorted(map(tuple, rolled.collect())) == [("x", 1, "P"), ("x", 1, "Q")]


def test_stacked_features_keep_every_key(rows):
    wide = assemble.stack_features(
        [rows("k string, a int", [("x", 1)]), rows("k string, b string", [("x", "B"), ("y", "C")])],
        "k",
    )
    assert as_dict(wide) == {"x": (1, "B"), "y": (None, "C")}


def test_flag_values_and_rows(rows):
    events = rows("k string, v int", [("x", 1), ("x", None), ("y", 2), ("z", None)])
    keys = rows("k string", [("x",), ("y",), ("z",), ("none",)])
    values = assemble.flag_values(events, ["k"], F.col("v") > 0, "flag")
    joined = keys.join(values, "k", "left")
    both = assemble.each_flag_value(joined, "flag", one_row=False)
    assert sorted(map(tuple, both.collect())) == [
        ("none", "NO"), ("x", "NO"), ("x", "YES"), ("y", "YES"), ("z", "NO"),
    ]
    single = assemble.each_flag_value(joined, "flag", one_row=True)
    assert as_dict(single) == {"none": ("NO",), "x": ("YES",), "y": ("YES",), "z": ("NO",)}


FEATURES = {
    "inf_prev_num": 1,
    "icu_prev_num": 1,
    "patient_age_at_visit": 64,
    "cci_score": 11,
    "los_prev_mean": 7.9,
    "prev_dot_log": 1.6094379124341003,
    "diabetes_num": 1,
    "prior_hosp": 2,
    "prev_blactam": 3,
}


def feature_row(rows, **change):
    values = {**FEATURES, **change}
    schema = ", ".join(
        f"{name} {'double' if isinstance(v, float) else 'int'}" for name, v in FEATURES.items()
    )
    return rows(schema, [tuple(values[name] for name in FEATURES)])


def test_worked_score(rows):
    row = score(feature_row(rows), models.CURRENT, score_name="s", pct_name="p").first()
    assert row.s == Decimal("-6.3708") and row.p == 0.17


def test_score_versions(rows):
    found = score_versions(feature_row(rows), models.ALL, score_name="s", pct_name="p")
    scores = {r.model_version: r.s for r in found.collect()}
    logarithm = Decimal("0.3348")
    assert scores["current"] == Decimal("-6.3708")
    assert scores["2024-02-15"] == Decimal("-6.3708") - logarithm  # cut to 1, not rounded to 2
    # -10.1571 + 1.4302 + 0.8062 + 2 * 0.0209 + 11 * 0.2153 + 7 * 0.0146 + 3 * 0.0214
    assert scores["undated"] == Decimal("-5.3442")
    # -9.8147 + 1.4157 + 0.8817 + 2 * 0.0245 + 11 * 0.0387 + 7 * 0.0151 + 3 * 0.0197 + 0.549
    assert scores["2024-01-16"] == Decimal("-6.3288")


def test_score_grows_with_each_feature(rows):
    base = score(feature_row(rows), models.CURRENT, score_name="s", pct_name="p").first().s
    for term in models.CURRENT.terms:
        more = feature_row(rows, **{term.feature: FEATURES[term.feature] + 1})
        assert score(more, models.CURRENT, score_name="s", pct_name="p").first().s > base


def test_missing_feature_gives_no_score(rows):
    row = score(
        feature_row(rows, patient_age_at_visit=None), models.CURRENT, score_name="s", pct_name="p"
    ).first()
    assert row.s is None and row.p is None


TIMED = "key string, code int, noted timestamp_ntz, ended timestamp_ntz"


def timed_flags(spark, conditions, cohort):
    coded = spark.createDataFrame([(1, True)], "code int, first boolean")
    admissions = spark.createDataFrame(cohort, "key string, admitted timestamp_ntz").distinct()
    return flags.active_flags(
        spark.createDataFrame(conditions, TIMED), coded, admissions,
        key="key", code_id="code", noted="noted", ended="ended", flags=["first"], admissions=admissions,
    )


def test_timed_conditions_meet_the_next_admission(spark):
    rng = random.Random(11)

    def moment(days):
        # Few different instants, so that many meet exactly.
        return START + timedelta(hours=12 * rng.randrange(2 * days))

    cohort = [(random_key(rng), moment(500)) for _ in range(40)] + [(None, START), ("k1", None)]
    conditions = []
    for _ in range(200):
        noted = moment(500)
        ended = noted + timedelta(hours=12 * rng.randrange(-900, 300)) if rng.random() < 0.9 else None
        conditions.append((random_key(rng), rng.randrange(1, 3), noted, ended))
    conditions += [("k2", 1, None, None), (None, 1, START, None), ("k9", 1, START, None)]
    expected = set()
    for key, admitted in cohort:
        for other, code, noted, ended in conditions:
            if key == other and key and code == 1 and noted and admitted and noted <= admitted - timedelta(days=2):
                if ended is None or ended >= admitted - timedelta(days=367):
                    expected.add(key)
    assert as_dict(timed_flags(spark, conditions, cohort)) == {key: (1,) for key in expected}
    assert expected


def test_a_heavy_patient_s_timed_conditions_make_no_product(spark):
    count = 20_000
    minutes = F.expr("make_dt_interval(0, 0, cast(id * 7 AS int))")
    start = F.lit("2020-01-01").cast("timestamp_ntz")
    base = spark.range(count).withColumn("key", F.lit("hot"))
    conditions = base.select(
        "key", F.lit(1).alias("code"), (start + minutes).alias("noted"),
        (start + minutes - F.expr("INTERVAL 400 DAYS")).alias("ended"),
    )
    admissions = base.select("key", (start + minutes).alias("admitted"))
    coded = spark.createDataFrame([(1, True)], "code int, first boolean")
    settings = {"key": "key", "code_id": "code", "noted": "noted", "ended": "ended", "flags": ["first"]}
    found = flags.active_flags(conditions, coded, admissions, admissions=admissions, **settings)
    assert found.collect() == []
    spans = conditions.withColumn("due", F.col("noted")).select("key", "due")
    plan = flags.next_admission(spans, admissions, "key", "due")._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan
    assert flags.next_admission(spans, admissions, "key", "due").count() == count


def test_many_code_ranges_are_searched(spark):
    rng = random.Random(3)
    ranges = []
    for _ in range(5000):
        low = f"{rng.choice('ABCDEFGH')}{rng.randrange(100_000):05d}"
        ranges.append((low, low[:-1] + rng.choice("0459é")))
    ranges += [("B2", "B1"), ("Z", "Z")]
    codes = [f"{rng.choice('ABCDEFGHZ')}{rng.randrange(100_000):05d}"[: rng.choice([1, 4, 6, 6, 6])] for _ in range(3000)]
    codes += ["Z", "Z1", "", "é", ranges[7][0], ranges[7][1], f"{ranges[9][1]}x"]
    df = spark.createDataFrame([(c,) for c in codes] + [(None,)], "code string")
    merged = flags.merged_ranges(ranges)
    assert len(merged) >= flags.SEARCHED and all(a[1] < b[0] for a, b in zip(merged, merged[1:], strict=False))
    got = sorted(row.code for row in df.where(flags.code_in(F.col("code"), ["A1"], ranges)).collect())
    want = sorted(c for c in codes if c == "A1" or any(low <= c <= high for low, high in ranges))
    assert got == want and 0 < len(got) < len(codes)


@pytest.mark.parametrize("count", [16, 17, 31, 32, 33, 100])
def test_every_place_of_a_range_table_is_found(spark, count):
    ranges = [(f"{i:04d}b", f"{i:04d}d") for i in range(count)]
    codes = [f"{i:04d}{end}" for i in range(count) for end in "abcde"] + ["", "~"]
    df = spark.createDataFrame([(c,) for c in codes], "code string")
    got = sorted(row.code for row in df.where(flags.code_in(F.col("code"), [], ranges)).collect())
    assert got == sorted(c for c in codes if c[-1:] in ("b", "c", "d"))


def test_few_merged_ranges_are_pushed_as_filters(rows):
    assert flags.merged_ranges([("C", "D"), ("A", "B"), ("B", "BB"), ("CC", "CD"), ("X", "W")]) == [("A", "BB"), ("C", "D")]
    none = rows("code string", [("A",), (None,)]).where(flags.code_in(F.col("code"), [], [("X", "W")]))
    assert none.collect() == []


def test_episodes_within_hours_meet_by_bins(spark):
    rng = random.Random(2)
    cohort = [(rng.randrange(5), START + timedelta(minutes=rng.randrange(4000))) for _ in range(30)]
    # A third of all episodes are one encounter's; some sit exactly on the bounds.
    episodes = [(0 if rng.random() < 1 / 3 else rng.randrange(7), START + timedelta(minutes=rng.randrange(9000))) for _ in range(300)]
    episodes += [(key, at + timedelta(hours=h)) for key, at in cohort for h in (0, 24)] + [(1, None), (None, START)]
    left = spark.createDataFrame(cohort, "visit int, admitted timestamp_ntz")
    right = spark.createDataFrame(episodes, "visit int, entered timestamp_ntz")
    found = lookback.within_hours(left, right, on="visit", anchor="admitted", start="entered")
    want = [
        (key, at, entered) for key, at in cohort for other, entered in episodes
        if key == other and entered and at <= entered <= at + timedelta(hours=24)
    ]
    assert sorted(tuple(r) for r in found.collect()) == sorted(want)
    assert found.columns == ["visit", "admitted", "entered"]
    join = next(line for line in found._jdf.queryExecution().optimizedPlan().toString().split("\n") if "Join Inner" in line)
    assert "bin" in join
