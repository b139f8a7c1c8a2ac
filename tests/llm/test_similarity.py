"""SimHash components and MinHash fingerprints against brute force."""

import hashlib
import re
import struct

import numpy as np
import pytest
import xxhash
from llm_documents import CLASHING, FOLDER, LONG, TEXTS, by_id, documents
from pyspark.sql import functions as F

from wardlens.llm import minhash, queries, simhash_trie
from wardlens.llm.common import stage

WORD = r"[^\x20\x09-\x0D]+"


def brute_fingerprint(text):
    words = text.encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [b" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, budget=3):
    """The smallest place of each place's component."""
    root = list(range(len(prints)))

    def of(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(prints)):
        for j in np.flatnonzero(np.bitwise_count(prints[i] ^ prints[i + 1 :]) <= budget):
            a, b = of(i), of(i + 1 + int(j))
            root[max(a, b)] = min(a, b)
    return [of(i) for i in range(len(prints))]


def near_prints(groups=150, seed=1):
    draw = np.random.default_rng(seed)
    found = set()
    for base in draw.integers(0, 1 << 63, groups, dtype=np.uint64).tolist():
        value = base
        for _ in range(int(draw.integers(1, 9))):
            for _ in range(int(draw.integers(0, 4))):
                value ^= 1 << int(draw.integers(64))
            found.add(value)
    return np.array(sorted(found), dtype=np.uint64)


def test_fingerprints():
    for text in TEXTS:
        if text != LONG:
            assert simhash_trie.fingerprint(text or "") == brute_fingerprint(text or "")
    assert simhash_trie.fingerprint("A b C") == simhash_trie.fingerprint("a  B\nc") != 0


def test_walk_over_one_trie_and_two():
    prints = near_prints()
    label = np.arange(len(prints))
    for i, j in simhash_trie.follow(prints, prints, True, 3):
        label = simhash_trie.tie(label, i, j)
    assert label.tolist() == brute_components(prints)
    a, b = prints[::2], prints[1::2]
    found = {(int(x), int(y)) for i, j in simhash_trie.follow(a, b, False, 3) for x, y in zip(i, j)}
    near = np.bitwise_count(a[:, None] ^ b[None, :]) <= 3
    assert found == set(zip(*(axis.tolist() for axis in np.nonzero(near))))


def test_upper_trie_of_small_leaves(spark, monkeypatch):
    monkeypatch.setattr(simhash_trie, "LEAF", 24)
    prints = near_prints(seed=2)
    rows = [(i, v) for i, v in enumerate(prints.view(np.int64).tolist())]
    df = spark.createDataFrame(rows, "doc_id long, fp long")
    found = simhash_trie.near_duplicates(df, keep=stage(spark).keep)
    got = {r.fp: r.component_id for r in found.collect()}
    assert [got[v] for _, v in rows] == brute_components(prints)


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(100, 140)] + [(5, 100)]
    star = [(200, i) for i in range(201, 260)]
    edges = spark.createDataFrame([*chain, *star, *star], "a long, b long")
    roots = {r.node: r.root for r in simhash_trie.components(edges, stage(spark).keep).collect()}
    assert all(roots[n] == 5 for n in range(100, 141)) and all(roots[n] == 200 for n in range(201, 260))
    none = simhash_trie.components(edges.limit(0), stage(spark).keep)
    assert none.count() == 0


def test_components_of_awkward_documents(spark):
    docs = documents(spark)
    rows = by_id(simhash_trie.simhash_components(docs))
    prints = np.array([simhash_trie.fingerprint(text or "") for text in TEXTS], dtype=np.uint64)
    groups = brute_components(prints)
    for i in range(len(TEXTS)):
        row = rows[i or None]
        assert row.fingerprint == f"{int(prints[i]):016x}"
        members = [k for k in range(1, len(TEXTS)) if groups[k] == groups[i]]
        assert row.component_id == min(members)
    assert simhash_trie.simhash_components(docs.limit(0)).count() == 0
    kept = simhash_trie.one_of_each(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(ids) == sorted({rows[i or None].component_id for i in range(len(TEXTS))})
    assert all(kept.first()[name] == f"own {name}" for name in CLASHING.split())
    assert simhash_trie.one_of_each(docs.limit(0)).count() == 0


def test_simhash_query(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").orderBy("doc_id").collect()
    rows = by_id(queries.QUERIES["op6_simhash_trie"](spark, FOLDER))
    prints = np.array([brute_fingerprint(doc.text) for doc in docs], dtype=np.uint64)
    for doc, value, first in zip(docs, prints, brute_components(prints), strict=True):
        assert rows[doc.doc_id].fingerprint == f"{int(value):016x}"
        assert rows[doc.doc_id].component_id == docs[first].doc_id


def signed(value):
    return value - (1 << 64) if value >= 1 << 63 else value


def brute_minhash(text):
    words = [signed(xxhash.xxh64_intdigest(w.encode(), 42)) for w in re.findall(WORD, text)]
    smallest = {}
    for i in range(max(1, len(words) - 4)):
        value = 42
        for word in words[i : i + 5]:
            value = xxhash.xxh64_intdigest(struct.pack("<q", word), value)
        place = value >> 57
        smallest[place] = min(smallest.get(place, signed(value)), signed(value))
    low = []
    for place, order in enumerate(minhash.probes()):
        full = place if place in smallest else next(p for p in order if p in smallest)
        low.append(smallest[full] & 255)
    return bytes(low).hex()


def brute_likeness(a, b):
    same = sum(x == y for x, y in zip(bytes.fromhex(a), bytes.fromhex(b))) / 128
    return max(0.0, (same - 1 / 256) / (1 - 1 / 256))


def check_report(rows, ordered):
    """``ordered``: (doc_id, text) by ascending id."""
    texts = [text or "" for _, text in ordered]
    for k, (doc_id, text) in enumerate(ordered):
        text, following = text or "", texts[(k + 1) % len(texts)]
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        row = rows[doc_id]
        assert row.n_chars == len(text)
        assert row.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert row.fingerprint == brute_minhash(text)
        assert row.edited_fingerprint == brute_minhash(edited)
        assert abs(row.near_edited - brute_likeness(row.fingerprint, row.edited_fingerprint)) < 1e-9
        assert abs(row.near_next - brute_likeness(row.fingerprint, brute_minhash(following))) < 1e-9


def test_minhash_of_awkward_documents(spark):
    docs = documents(spark, repeats=0)
    ordered = [(i or None, text) for i, text in enumerate(TEXTS)]
    check_report(by_id(minhash.fingerprint_report(docs)), ordered)
    assert minhash.fingerprint_report(docs.limit(0)).count() == 0
    one = docs.where("doc_id = 5")
    check_report(by_id(minhash.fingerprint_report(one)), [(5, TEXTS[5])])
    assert minhash.fingerprint_report(documents(spark, repeats=3)).count() == len(TEXTS) + 3


def test_minhash_over_many_stretches(spark, monkeypatch):
    monkeypatch.setattr(minhash, "STRETCH_BYTES", 20_000)
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").orderBy("doc_id").collect()
    rows = by_id(queries.QUERIES["op9_one_permutation_minhash"](spark, FOLDER))
    check_report(rows, [(doc.doc_id, doc.text) for doc in docs])


def test_minhash_estimates_without_bias(spark):
    folder = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = by_id(queries.QUERIES["op9_one_permutation_minhash"](spark, folder))
    ids = sorted(texts)

    def shingles(text):
        words = re.findall(WORD, text)
        return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}

    errors = []
    for k, doc_id in enumerate(ids):
        text, following = texts[doc_id], texts[ids[(k + 1) % len(ids)]]
        half = len(text) // 2
        a, b = shingles(text), shingles(text[: len(text) - half] + following[:half])
        errors.append(rows[doc_id].near_edited - len(a & b) / len(a | b))
    assert abs(np.mean(errors)) < 0.01 and np.sqrt(np.mean(np.square(errors))) < 0.05


def test_native_operators_run_no_python(spark):
    docs = documents(spark)
    plan = minhash.fingerprint_report(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert docs.select(F.col("doc_id")).count()


def test_unfinished_components_are_an_error(spark):
    chain = spark.range(1, 40).selectExpr("id AS a", "id + 1 AS b")
    with pytest.raises(RuntimeError, match="round 2"):
        simhash_trie.components(chain, stage(spark).keep, rounds=2)


def test_kept_texts_are_neither_sorted_nor_ranked(spark):
    texts = ["one two three four", "one two three four", "quite another text of words", None]
    docs = documents(spark, texts, repeats=3).withColumn("place", F.monotonically_increasing_id())
    docs = docs.unionByName(docs.where("doc_id = 2").withColumn("place", F.lit(-1).cast("long")))
    kept = simhash_trie.one_of_each(docs)
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and "Sort" not in plan and "Window" not in plan
    assert kept.columns == docs.columns
    # Repeated rows and rows that differ elsewhere only are kept once.
    assert sorted(row.doc_id for row in kept.collect()) == [1, 2, 3]
