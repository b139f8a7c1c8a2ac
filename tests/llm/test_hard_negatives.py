"""Hard negatives against brute force."""

import math
import random

import numpy as np
import pytest
from llm_documents import CLASHING
from pyspark.sql import functions as F

from wardlens.llm import hard_negatives, queries

SCHEMA = "vec_id long, label int, embedding array<double>"


def brute(rows, positives=5, negatives=10):
    used = [
        (i, label, [math.floor(256 * x) for x in vector])
        for i, label, vector in rows
        if i is not None and label is not None and vector is not None
        and all(x is not None and math.isfinite(x) for x in vector)
    ]

    def score(a, b):
        return sum(x * y for x, y in zip(a, b, strict=False))

    found = []
    for place, (anchor, label, vector) in enumerate(used):
        if anchor % 100:
            continue
        scored = [(-score(vector, v), i, l) for k, (i, l, v) in enumerate(used) if k != place]
        scored.sort(key=lambda x: x[:2])
        for p, positive, _ in [x for x in scored if x[2] == label][:positives]:
            near = [x for x in scored if x[2] != label and 30 * -p <= 100 * -x[0] <= 90 * -p]
            found += [(anchor, positive, r, i, -p, -s) for r, (s, i, _) in enumerate(near[:negatives], 1)]
    return sorted(found)


def mined(df):
    made = hard_negatives.hard_negatives(df, anchor=F.col("vec_id") % 100 == 0)
    assert made.columns[:6] == "anchor_id positive_id rank negative_id positive_score negative_score".split()
    assert dict(made.dtypes)["rank"] == "int"
    return sorted(tuple(row) for row in made.collect())


def vectors(count, width=6, seed=3, labels=3):
    draw = random.Random(seed)
    return [
        (i, draw.randrange(labels), [draw.uniform(0, 1) if draw.random() < 0.8 else -0.2 for _ in range(width)])
        for i in range(count)
    ]


def test_equals_brute_force_with_odd_rows(spark):
    rows = vectors(420)
    rows += [(500, 1, None), (600, None, [1.0] * 6), (None, 1, [1.0] * 6), (700, 1, [])]
    rows += [(800, 1, [1.0, None]), (900, 2, [math.nan] * 6), (1000, 2, [math.inf, 0.0]), (1100, 0, [0.5, 0.5])]
    rows += rows[100:103] * 2
    df = spark.createDataFrame(rows, SCHEMA).withColumns({n: F.lit(n) for n in CLASHING.split()})
    found = mined(df.withColumns({"row": F.lit("x"), "parts": F.lit("y"), "anchor": F.lit(0)}))
    assert found == brute(rows)
    assert found


def test_third_of_all_rows_with_one_vector(spark):
    rows = vectors(200) + [(1000 + i, i % 2, [0.5] * 6) for i in range(100)]
    assert mined(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


def test_several_blocks_and_tiles(spark, monkeypatch):
    rows = vectors(300, labels=2)
    for name, value in {"BLOCK_ROWS": 40, "BLOCK_ANCHORS": 1}.items():
        monkeypatch.setattr(hard_negatives, name, value)
    assert hard_negatives.block_counts(300, 3, 1) == (3, 8)
    assert mined(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


@pytest.mark.parametrize("large", [1.0, 3e4, 1e6])
def test_wide_components(spark, large):
    rows = [(i, label, [x * large for x in v]) for i, label, v in vectors(120, labels=2)]
    assert mined(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


def test_scores_beyond_64_bits_are_cut(spark):
    rows = [(i, i % 2, [1e300 * (1 + i), -1e300]) for i in range(0, 300, 50)]
    for row in mined(spark.createDataFrame(rows, SCHEMA)):
        assert abs(row[4]) <= hard_negatives.MOST


def test_empty_table(spark):
    assert mined(spark.createDataFrame([], SCHEMA)) == []


@pytest.mark.parametrize("most", [1, 100, 1 << 18, 1 << 30])
def test_packed_products_are_exact(most):
    draw = np.random.default_rng(1)
    rows = draw.integers(-most, most, (37, 9), endpoint=True)
    anchors = draw.integers(-most, most, (5, 9), endpoint=True)
    packed = hard_negatives.Packed(rows, most)
    assert packed.fields > 1 or most == 1 << 18
    want = anchors.astype(object) @ rows.T.astype(object)
    want = np.clip(want, hard_negatives.LEAST, hard_negatives.MOST)
    assert (packed.scores(anchors) == want).all()


def test_first_of_rows_with_many_ties():
    scores = np.array([[5] * 50 + [6], [1, 2] * 25 + [0], [9] * 51])
    allowed = np.ones(scores.shape, dtype=bool)
    allowed[2] = False
    row, column = hard_negatives.first_of_rows(scores, allowed, 3)
    assert row.tolist() == [0] * 3 + [1] * 3
    assert column.tolist() == [50, 0, 1, 1, 3, 5]


def test_query_reads_the_whole_table(spark):
    name = "op11_kronecker_negatives"
    found = queries.QUERIES[name](spark, "/root/testdata/sf0.001").collect()
    table = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").collect()
    rows = [
        (r.vec_id, (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label, r.embedding) for r in table if r.label is not None
    ]
    assert sorted(tuple(row) for row in found) == brute(rows)
