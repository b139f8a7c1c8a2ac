"""The transducer, and encoding and decoding through it, against the tokenizers library."""

import hashlib
import random
import struct

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_documents import FOLDER, LONG, TEXTS, by_id, documents, random_texts
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from wardlens.llm import lexicon_bpe, queries
from wardlens.llm.transducer import Builder, Transducer, compiled

LIBRARY = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
MORE = [
    "a<|endoftext|>b <|endoftext|> c <|endoftext|", "<|endoftext|>", "don't I'LL we've 'tis ''s 's", "x'" * 50,
    "\r\n\r\nnext\r\n  more\t\ttabs\n\n\n", "1234567890 12 345,678.90", "ąćę ŁÓDŹ straße Ünïcödé", "日本語テキスト 한국어",
    "🙂👩‍👩‍👧‍👦🏳️‍🌈", "​﻿­", "\x00\x01\x1c\x7f\x85\xa0", "word" * 3000, "Hello, World!!! (really?)...", " ", "  ", "\n",
    "a\nb\n\nc \nd", "end ", " start", "tab\tin\tside", "İstanbul ǅ ß ﬁ", "é combining", "".join(chr(c) for c in range(1, 0x300)),
]


def ids_of(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def brute_row(text):
    ids = ids_of(text)
    decoded = LIBRARY.decode(ids, skip_special_tokens=False)
    raw = struct.pack(f"<{len(ids)}I", *ids)
    return len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()


def check(docs, **settings):
    found = lexicon_bpe.code_report(docs, **settings)
    assert found.columns[:4] == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    texts = {row.doc_id: row.text for row in docs.select("doc_id", "text").collect()}
    rows = by_id(found)
    assert rows.keys() == texts.keys()
    for doc_id, row in rows.items():
        assert tuple(row)[1:] == brute_row(texts[doc_id]), (doc_id, (texts[doc_id] or "")[:80])
    return found


@pytest.mark.parametrize("most", [0, 5, 1 << 16])
def test_odd_documents(spark, most):
    texts = [*TEXTS, *MORE, *random_texts("ab '\n<|endoftext|>", 40, 60), *random_texts("aé日🙂 \t\n.,'s1", 40, 60)]
    docs = documents(spark, texts, repeats=4).withColumns({"ids": F.lit("x"), "word": F.lit(1), "n": F.lit(2)})
    assert check(docs, most=most).count() == len(texts) + 4
    assert len(LONG) > 100_000


def test_a_null_id_on_a_third_of_all_rows_and_an_empty_table(spark):
    docs = documents(spark, ["the same words again"] * 300)
    docs = docs.withColumn("doc_id", F.when(F.col("doc_id") % 3 > 0, F.col("doc_id")))
    assert check(docs).count() == 301
    assert lexicon_bpe.code_report(docs.limit(0)).collect() == []


def test_ids_and_texts_go_there_and_back(spark):
    docs = documents(spark, MORE)
    coded = lexicon_bpe.encode_texts(docs)
    texts = {row.doc_id: row.text for row in docs.collect()}
    for row in coded.collect():
        assert row.ids == ids_of(texts[row.doc_id])
    for row in lexicon_bpe.decode_ids(coded).collect():
        assert row.text == texts[row.doc_id]


def test_any_ids_decode_as_the_library_does(spark):
    draw = random.Random(2)
    lists = [[draw.randrange(50257) for _ in range(draw.randint(0, 12))] for _ in range(200)]
    lists += [[draw.randrange(256) for _ in range(6)] for _ in range(200)]
    rows = [(i, ids) for i, ids in enumerate(lists)]
    rows += [(1000, None), (1001, [70_000, 5, None, 50_256])]
    found = {r.doc_id: r.text for r in lexicon_bpe.decode_ids(spark.createDataFrame(rows, "doc_id long, ids array<int>")).collect()}
    for i, ids in enumerate(lists):
        assert found[i] == LIBRARY.decode(ids, skip_special_tokens=False)
    assert (found[1000], found[1001]) == ("", LIBRARY.decode([5, 50_256], skip_special_tokens=False))


def test_query_equals_the_library_on_the_whole_table(spark):
    texts = {row.doc_id: row.text for row in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    found = by_id(queries.QUERIES["op13_lexicon_bpe"](spark, FOLDER))
    assert found.keys() == texts.keys()
    for doc_id, row in found.items():
        assert tuple(row)[1:] == brute_row(texts[doc_id])


def test_frequent_words_keep_to_their_bound(spark):
    texts = [" ".join(f"word{chr(97 + i)}" for i in range(20) for _ in range(2 ** (i % 10))) for _ in range(3)]
    docs = documents(spark, texts)
    for most in (0, 1, 7, 1000):
        assert len(lexicon_bpe.frequent_words(docs, most=most)) <= most
    found = lexicon_bpe.frequent_words(docs, most=2)
    assert sorted(found) == [" wordj", " wordt"]


def stored(tmp_path, entries):
    path = tmp_path / "lexicon.bin"
    path.write_bytes(compiled(entries.items()))
    return Transducer(str(path))


def packed(ids):
    return np.array(ids, dtype="<u4").tobytes()


def test_transducer_holds_its_words_and_no_others(tmp_path):
    draw = random.Random(4)
    entries = {}
    for _ in range(2000):
        word = bytes(draw.choice(b"abc\xff\x00") for _ in range(draw.randint(1, 7)))
        entries[word] = [draw.randrange(5) for _ in range(draw.randint(0, 4))]
    made = stored(tmp_path, entries)
    asked = [*entries, b"", *(bytes(draw.choice(b"abcd") for _ in range(draw.randint(1, 9))) for _ in range(2000))]
    want = [packed(entries[word]) if word in entries else None for word in asked]
    assert made.look_up(asked) == want
    assert isinstance(made.key, np.memmap)
    assert made.look_up([]) == []


def test_common_suffixes_are_stored_once(tmp_path):
    builder = Builder()
    for word in sorted(a + b for a in (b"walk", b"talk", b"jump") for b in (b"", b"s", b"ed", b"ing", b"ings")):
        builder.add(word, [word[0], 7])
    builder.finish()
    # Root, three words' own four letters less the ends, one shared tree of suffixes.
    assert len(builder.states) <= 1 + 9 + 7


def test_an_empty_transducer(tmp_path):
    assert stored(tmp_path, {}).look_up([b"a", b""]) == [None, None]


@settings(max_examples=150, deadline=None)
@given(st.dictionaries(st.binary(min_size=1, max_size=6), st.lists(st.integers(0, 3), max_size=4), max_size=30))
def test_transducer_with_any_words(tmp_path_factory, entries):
    made = stored(tmp_path_factory.mktemp("fst"), entries)
    assert made.look_up(list(entries)) == [packed(ids) for ids in entries.values()]


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_pieces_and_merges_equal_the_library(text):
    tokens = lexicon_bpe._tokens("byte_bpe_50k.json")
    if "<|endoftext|>" not in text:
        ids = b"".join(tokens.merge(piece) for piece in tokens.pieces(text))
        assert np.frombuffer(ids, dtype="<u4").tolist() == ids_of(text)
