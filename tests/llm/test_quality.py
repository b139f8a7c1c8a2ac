"""Quality statistics against brute force, learned rules, and the ordinal classifier."""

import itertools
import math
import random
import re

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from llm_documents import FOLDER, LONG, TEXTS, by_id, documents, labels, random_texts
from pyspark.sql import functions as F

from wardlens.llm import decision_list, ordinal, queries
from wardlens.llm.common import repeats, smallest_chances
from wardlens.sources import staging

WORD = r"[^\x20\x09-\x0D]+"


def brute_counts(text):
    words = re.findall(WORD, text)
    lines = [line for line in text.split("\n") if re.search(WORD, line)]
    at = {}
    for i in range(len(words) - 4):
        at.setdefault(tuple(words[i : i + 5]), []).append(i)
    repeated = {i + k for starts in at.values() if len(starts) > 1 for i in starts for k in range(5)}
    symbols = sum(text.count(c) for c in "#*$%&|<>")
    return (len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(repeated))


def test_counts():
    alphabet = ["a ", "b ", "a b c d e ", "e ", "\n", "\t", "é ", "#", "<", "x\x0b", "\xa0"]
    texts = random_texts(alphabet, 1500, 40) + [text or "" for text in TEXTS]
    for text in texts:
        assert decision_list.text_counts(text)[:5] == brute_counts(text), text[:200]


def test_counts_of_very_many_words():
    words = [b"w%d" % (i % 70_000) for i in range(140_000)]
    assert decision_list.repeated_words(words) == (140_000, 70_000)


def test_covering_learns_the_conjunction_that_made_the_labels():
    draw = np.random.default_rng(1)
    values = {name: draw.random(4000) for name in ("a", "b", "c")}
    bad = (values["a"] > 0.7) & (values["b"] < 0.4)
    rules = decision_list.learn(values, bad, draw.random(4000) < 0.67)
    kept = np.ones(4000, bool)
    for rule in rules:
        kept &= ~decision_list.covers(rule, values, 4000)
    assert 1 <= len(rules) <= 4 and (kept == ~bad).mean() > 0.98
    assert decision_list.learn(values, np.zeros(4000, bool), draw.random(4000) < 0.67) == []


def test_list_as_a_conditional_expression(spark):
    rule = decision_list.Condition
    rules = [
        (rule("words", True, 100.0), rule("upper_share", True, 0.5)),
        (rule("symbols_per_word", True, 1.0),),
    ]
    names = {c: c for c in decision_list.COUNTS}
    draw = random.Random(3)
    rows = [tuple(draw.randrange(300) for _ in names) for _ in range(200)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} long" for c in names))
    found = df.select("*", decision_list.verdict(rules, names).alias("ok")).collect()
    for r in found:
        shouting = r.n_words > 100 and r.n_upper / max(r.word_chars, 1) > 0.5
        assert r.ok == (not shouting and not r.n_symbols / max(r.n_words, 1) > 1)
    assert df.select(decision_list.verdict([], names).alias("ok")).distinct().collect() == [(True,)]


def test_report_on_awkward_documents(spark):
    docs = documents(spark)
    known = labels(spark, [(5, 1, 0), (5, None, 0), (None, 0, 0), (99, 0, 1)])
    for given in (known, labels(spark)):
        rows = by_id(decision_list.quality_report(docs, given))
        for i, text in enumerate(TEXTS):
            row, want = rows[i or None], brute_counts(text or "")
            assert tuple(row)[1:6] == want
            assert row.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0])
            assert row.kept == (not row.base_failed)
    kept = decision_list.passing(docs, known)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i or None for i in range(len(TEXTS)) if rows[i or None].kept}
    assert decision_list.passing(docs.limit(0), known).count() == 0


def test_rules_on_the_labelled_table(spark):
    folder = "/root/testdata/sf0.01"
    rows = queries.QUERIES["op5_decision_list"](spark, folder)
    marked = rows.join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").where("not base_failed")
    kept = {r.quality: r.kept for r in marked.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect()}
    assert kept[1] > 0.97 and kept[0] < 0.2


def test_ordinal_fit_on_held_out_documents():
    docs = pq.read_table("/root/testdata/sf0.1/documents.parquet", columns=["doc_id", "text"])
    marks = pq.read_table("/root/testdata/sf0.1/labels.parquet").to_pandas()
    both = docs.to_pandas().merge(marks, on="doc_id")
    grades = np.where(both.quality == 0, 0, np.where(both.toxic != 0, 1, 2))
    training = np.random.default_rng(0).random(len(both)) < 0.7

    def places(rows):
        return ordinal.hashed(pa.array(both.text[rows].tolist()))

    model = ordinal.fit_model(*places(training), grades[training], 2)
    assert np.all(np.diff(model.thresholds) >= 0)
    tails = model.tails(model.scores(*places(~training)))
    best, grade = tails[:, 1] >= 0.5, grades[~training]
    assert best[grade == 2].mean() > 0.98
    assert best[grade == 1].mean() < 0.35 and best[grade == 0].mean() < 0.05
    expected = tails.sum(axis=1)
    assert expected[grade == 0].mean() < expected[grade == 1].mean() < expected[grade == 2].mean()


def test_hashed_places_do_not_depend_on_the_batch():
    texts = [text or "" for text in TEXTS if text != LONG]
    starts, places = ordinal.hashed(pa.array(texts))
    for text, a, b in zip(texts, starts, starts[1:]):
        one = ordinal.hashed(pa.array([text]))
        assert one[1].tolist() == places[a:b].tolist()
        words = set(text.lower().split())
        assert len(places[a:b]) <= 2 * len(words) + 3


def test_ordinal_scores_of_awkward_documents(spark):
    docs = documents(spark)
    known = labels(spark, [(i, i % 2, 0) for i in range(1, 12)] + [(3, 1, 1), (4, 1, None), (None, 0, 0)])
    rows = by_id(ordinal.quality_report(docs, known))
    assert len(rows) == len(TEXTS)
    assert all(0 <= r.p_top <= 1 and 0 <= r.expected_grade <= 2 for r in rows.values())
    assert rows[5].p_top == rows[6].p_top or rows[5].doc_id != rows[6].doc_id
    unrated = by_id(ordinal.quality_report(docs, labels(spark)))
    assert len({r.p_top for r in unrated.values()}) == 1
    assert ordinal.quality_report(docs.limit(0), known).count() == 0


def test_ordinal_query(spark):
    rows = queries.QUERIES["op1_ordinal_quality"](spark, FOLDER)
    assert rows.columns == ["doc_id", "expected_grade", "p_top", "kept"]
    assert rows.count() == spark.read.parquet(f"{FOLDER}/documents.parquet").count()


def test_smallest_chances(spark):
    df = spark.range(9000).select("id", F.xxhash64("id").alias("chance"))
    found = smallest_chances(df, F.col("chance"), 700, "id")
    least = sorted((r.chance & ((1 << 63) - 1), r.id) for r in df.collect())[:700]
    assert sorted(r.id for r in found.collect()) == sorted(i for _, i in least)


def test_smallest_chances_of_repeated_ids(spark):
    """Few ids with very many rows: as many rows as there are are found."""
    df = spark.range(9000).select(F.col("id"), (F.col("id") % 3).alias("doc_id"))
    df = df.withColumn("chance", F.lit(1 << 62) + F.col("doc_id"))
    for size in (700, 3500):
        found = [r.id for r in smallest_chances(df, F.col("chance"), size, "id").collect()]
        assert found == sorted(range(9000), key=lambda i: (i % 3, i))[:size]


def test_ordinal_sample_is_of_rated_documents(spark, monkeypatch):
    """Ratings without a document take no place; repeated ids fill the sample, always alike."""
    docs = spark.range(400).selectExpr("id % 40 AS doc_id", "concat('word ', id, ' and more') AS text")
    ratings = spark.range(5000).selectExpr("id AS doc_id", "cast(id % 3 AS int) AS grade")
    seen = []
    monkeypatch.setattr(ordinal, "fit_model", lambda *found: seen.append(found))
    for parts in (1, 7):
        ordinal.fit(docs.repartition(parts), ratings, 2, 30)
    ordinal.fit(docs.unionByName(docs), ratings.where("doc_id < 40").unionByName(ratings.where("doc_id = 3")), 2, 10_000)
    assert [len(found[2]) for found in seen] == [30, 30, 820]
    for left, right in zip(seen[0], seen[1], strict=True):
        assert np.array_equal(left, right)


def brute_likelihood(texts, weights, cuts):
    """(likelihood) of texts given as (features, grade, weight), word for word."""
    total = 0.0
    for features, grade, balance in texts:
        score = sum(weights[p] * v for p, v in features)
        above = [1.0, *(1 / (1 + math.exp(cut - score)) for cut in cuts), 0.0]
        total += balance * math.log(above[grade] - above[grade + 1])
    return total - ordinal.SHRINK / 2 * sum(w * w for w in weights)


def test_likelihood_and_slopes_against_brute_force():
    draw = random.Random(7)
    for top in (1, 2, 4):
        texts = [
            ([(draw.randrange(9), draw.uniform(-1, 2)) for _ in range(draw.randrange(6))], i % (top + 1), draw.random())
            for i in range(40)
        ]
        cells = [(i, p, v) for i, (found, _, _) in enumerate(texts) for p, v in found]
        row, place, value = (np.array(x) for x in zip(*cells, strict=True))
        rated = ordinal.Ratings(row, place, value, np.array([t[1] for t in texts]), np.array([t[2] for t in texts]))
        at = [draw.uniform(-1, 1) for _ in range(9)] + sorted(draw.uniform(-2, 2) for _ in range(top))
        total, by_weight, by_cut = rated.likelihood(np.array(at[:9]), np.array(at[9:]))
        assert abs(total - brute_likelihood(texts, at[:9], at[9:])) < 1e-9
        for i, slope in enumerate([*by_weight, *by_cut]):
            more, less = list(at), list(at)
            more[i], less[i] = at[i] + 1e-5, at[i] - 1e-5
            step = brute_likelihood(texts, more[:9], more[9:]) - brute_likelihood(texts, less[:9], less[9:])
            assert abs(step / 2e-5 - slope) < 1e-5


def test_thresholds_never_meet():
    """A grade hardly ever given, one never given, and grades that words tell apart."""
    texts = ["good fine words here"] * 60 + ["bad poor words there"] * 60 + ["other odd words"]
    starts, places = ordinal.hashed(pa.array(texts))
    for middle in (1, 2):
        grades = np.array([3] * 60 + [0] * 60 + [middle])
        model = ordinal.fit_model(starts, places, grades, 3)
        assert np.all(np.diff(model.thresholds) > 0) and np.isfinite(model.weights).all()
        scores = model.scores(starts, places)
        assert scores[0] > scores[120] > scores[60]
        assert np.all(np.diff(model.tails(scores), axis=1) <= 0)
        assert 0 < model.slope < 0.1


def test_repeats():
    for counts, size in (([3, 1, 5], 6), ([3, 1, 5], 100), ([10**18] * 30, 40), ([7], 3), ([], 5), ([1, 1, 1], 2)):
        want = list(itertools.islice((i for i, n in enumerate(counts) for _ in range(min(n, size))), size))
        assert repeats(np.array(counts, dtype=np.int64), size).tolist() == want


def test_samples_write_no_pairs_of_a_repeated_id(spark, monkeypatch):
    """A thousand labels of an id with a thousand documents: a million pairs, none written."""
    words = "concat('text ', id % 20, ' of a dozen words that are not said twice in here') AS text"
    docs = spark.range(2000).selectExpr("if(id < 1000, 7, id) AS doc_id", words)
    known = spark.range(3000).selectExpr("if(id < 1000, 7, id) AS doc_id", "cast(id % 2 AS int) AS quality", "0 AS toxic")
    written, seen = [], []

    def keep(self, df, name):
        kept = plain(self, df, name)
        written.append(kept.count())
        return kept

    plain = staging.Stage.keep
    monkeypatch.setattr(staging.Stage, "keep", keep)
    monkeypatch.setattr(ordinal, "fit_model", lambda *found: seen.append(len(found[2])) or ordinal.Model(np.zeros(ordinal.PLACES), np.zeros(2)))
    monkeypatch.setattr(decision_list, "learn", lambda values, bad, growing: seen.append(len(bad)) or [])
    for report in (ordinal.quality_report, decision_list.quality_report):
        report(docs, known)
    assert seen == [ordinal.SAMPLE, decision_list.SAMPLE] and max(written) <= 4000
