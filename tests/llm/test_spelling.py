"""Spelling variants against brute force."""

import random
import re
import zlib
from collections import Counter

from llm_documents import FOLDER, LONG, TEXTS, documents
from pyspark.sql import functions as F

from wardlens.llm import queries, spelling

LOWER = str.maketrans(spelling.UPPER, spelling.UPPER.lower())


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    start = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), len(a))
    return a != b and (a[start + 1 :] if len(a) == len(b) else a[start:]) == b[start + 1 :] and len(b) - len(a) < 2


def brute_variants(counts, times=5):
    """The result rows of a word count, comparing all words with all."""
    rows = {}
    for word, n in counts.items():
        close = sorted((-counts[w], w) for w in counts if abs(len(w) - len(word)) < 2 and near(w, word))
        form = close[0][1] if close and -close[0][0] >= times * n else None
        rows[word] = [word, form, None, n, len(close), counts[form] if form else None]
    for row in rows.values():
        root = row[0]
        while rows[root][1]:
            root = rows[root][1]
        row[2] = root
    return sorted(tuple(row) for row in rows.values())


def brute_counts(docs, every=199):
    found = Counter()
    for doc_id, text in docs:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            slip = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if slip % every == 0:
                place = slip % len(run)
                run = run[:place] + run[place + 1 :]
            found[run] += 1
    return {word: n for word, n in found.items() if len(word) >= 6 and n >= 5}


def made(df):
    assert df.columns[:6] == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted((tuple(row)[:6] for row in df.collect()), key=str)


def by_counts(spark, counts):
    return made(spelling.spelling_variants(spark.createDataFrame(list(counts.items()), "word string, n long")))


def test_random_words_of_few_letters(spark):
    draw = random.Random(5)
    counts = {}
    for letters in ("ab", "aéÿ", "zÀ"):
        for _ in range(300):
            word = "".join(draw.choice(letters) for _ in range(draw.randint(1, 9)))
            counts[word] = draw.choice([5, 5, 30, 200, 2000, 20_000])
    assert by_counts(spark, counts) == sorted(brute_variants(counts), key=str)


def test_long_words_chains_and_common_stems(spark):
    long = "lengthened" * 2000
    counts = {long: 3000, long[:-1]: 5, long[1:]: 6, long + "x": 7, long[:9000] + long[9001:]: 8}
    counts |= {f"common{chr(97 + i)}{chr(97 + j)}": 5 ** (1 + (i + j) % 4) for i in range(12) for j in range(12)}
    counts |= {"aaaaaaaa": 5, "aaaaaaa": 25, "aaaaaa": 125, "aaaaab": 625, "aaaabb": 3125}
    got = by_counts(spark, counts)
    assert got == sorted(brute_variants(counts), key=str)
    assert ("aaaaaaaa", "aaaaaaa", "aaaabb", 5, 1, 25) in got


def test_odd_documents(spark):
    words = "spelling speling spellinng spellimg Größeren größeren ÀÉÎÕÜÿ×÷ àéîõü".split()
    texts = [*TEXTS, None, *(" ".join(words[: 3 + i % 5]) for i in range(60)), "w" * 20_000]
    docs = documents(spark, texts, repeats=40)
    docs = docs.withColumns({n: F.lit("own") for n in ("word", "n", "run", "id", "heads", "whole")})
    pairs = [(row.doc_id, row.text) for row in docs.select("doc_id", "text").collect()]
    want = brute_variants(brute_counts(pairs))
    assert made(spelling.variant_report(docs)) == sorted(want, key=str)
    assert any(len(row[0]) == 20_000 for row in want)
    assert len(LONG) > 100_000


def test_a_null_id_on_a_third_of_all_rows(spark):
    texts = ["frequent words recur recurrently"] * 900
    docs = documents(spark, texts).withColumn("doc_id", F.when(F.col("doc_id") % 3 > 0, F.col("doc_id")))
    pairs = [(row.doc_id, row.text) for row in docs.collect()]
    assert made(spelling.variant_report(docs)) == sorted(brute_variants(brute_counts(pairs)), key=str)


def test_empty_table(spark):
    assert made(spelling.variant_report(documents(spark, []).limit(0))) == []


def test_numbers_keep_the_words_apart_and_in_order():
    words = sorted({"".join(random.Random(i).choices("abÿ", k=1 + i % 9)) for i in range(900)})
    numbers, ids = {}, []
    for word, path in zip(words, spelling.node_numbers(words), strict=True):
        assert len(path) == len(word) + 1
        ids.append(path[-1])
        for depth, number in enumerate(path):
            assert numbers.setdefault(number, word[:depth]) == word[:depth]
    assert ids == sorted(ids)


def test_query_counts_the_whole_table(spark):
    found = queries.QUERIES["op12_spelling_variants"](spark, FOLDER)
    pairs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    assert made(found) == sorted(brute_variants(brute_counts(pairs)), key=str)
