"""Token files, prefix counts and pieces against the tokenizers' own libraries."""

import os
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from llm_documents import FOLDER, LONG, TEXTS, by_id, documents, random_texts
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from wardlens.llm import pieces, prefix_counts, queries, token_orc
from wardlens.llm.bpe import PrefixBpe, merged

os.environ["TOKENIZERS_PARALLELISM"] = "false"
BPE = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
PIECES = sentencepiece.SentencePieceProcessor(
    model_file=public_tokenizers.path("piece_bpe_32k.model")
)
ALPHABET = [*"ab'slltre  \n\n\t\r12!.é日🙂\xa0\x1c▁", "the ", "ing", "<s>", "<|endoftext|>"]


def ids_of(text):
    return BPE.encode(text or "", add_special_tokens=False).ids


def test_merging_takes_the_lowest_rank_then_the_leftmost():
    ranks = {"aa": 1.0, "aaa": 1.0, "ab": 0.0, "aab": 2.0}
    for text in random_texts("ab", 200, 60):
        short, texts = merged(text[:20], ranks.get), merged(text, ranks.get)
        assert "".join(short) == text[:20] and "".join(texts) == text
    assert merged("aaab", ranks.get) == ["aa", "ab"]
    assert merged("a" * 30, ranks.get) == ["aaa"] * 10


def test_prefix_states_are_encodings_of_prefixes():
    ranks = {c: -1 for c in "abc"} | {"ab": 0, "bc": 1, "abc": 2, "ca": 3, "cab": 4}
    bpe = PrefixBpe(ranks)
    forward = bpe.forward()
    for text in sorted(random_texts("abc", 300, 14)):
        forward.go(text)
        assert forward.tokens() == bpe.encode(text)
        assert [len(bpe.encode(text[:n])) for n in range(len(text) + 1)] == forward.count


@pytest.fixture(scope="module")
def coder():
    return prefix_counts.Coder("byte_bpe_50k.json")


def stored(coder, texts):
    places, data = coder.stores(pa.array(texts))
    return [prefix_counts.prefix_counts(data[a:b]).tolist() for a, b in zip(places, places[1:])]


def test_counts_of_all_prefixes(coder):
    texts = random_texts(ALPHABET, 400, 20)
    for text, counts in zip(texts, stored(coder, texts), strict=True):
        assert counts == [len(ids_of(text[:n])) for n in range(len(text) + 1)], text


def test_steps_of_more_than_a_byte(coder):
    counts = np.array([1, 400, 3])
    assert prefix_counts.packed(counts, 1) is None
    store = bytes([2]) + prefix_counts.packed(counts, 2)
    assert prefix_counts.prefix_counts(store).tolist() == [0, 1, 400, 3]


def test_token_counts_of_documents(spark):
    df = prefix_counts.count_tokens(documents(spark), limit=12)
    rows = by_id(df)
    assert df.count() == len(TEXTS) + 1
    for i, text in enumerate(TEXTS):
        row, n = rows[i or None], len(ids_of(text))
        assert (row.n_bytes, row.n_tokens) == (len((text or "").encode()), n)
        assert row.over_limit == (n > 12)
        if text != LONG:
            fits = [k for k in range(len(text or "") + 1) if len(ids_of((text or "")[:k])) <= 12]
            assert row.fit_chars == fits[-1]


def test_truncation_and_budget_from_the_store(spark):
    df = prefix_counts.count_tokens(documents(spark)).where("doc_id = 8")
    answers = df.select(
        prefix_counts.tokens_of_prefix(F.col("token_steps"), F.lit(9)).alias("tokens"),
        prefix_counts.chars_in_budget(F.col("token_steps"), F.lit(5)).alias("chars"),
    ).first()
    assert answers.tokens == len(ids_of(TEXTS[8][:9]))
    assert len(ids_of(TEXTS[8][: answers.chars])) <= 5 < len(ids_of(TEXTS[8][: answers.chars + 2]))


def test_library_encoder_on_odd_texts():
    encoder = token_orc.LibraryEncoder("byte_bpe_50k.json")
    texts = random_texts(ALPHABET, 400, 30, seed=2)
    end = np.array([2], dtype="<u4").tobytes()
    for _ in range(2):
        places, ids = encoder.encode(pa.array(texts), end)
        for text, a, b in zip(texts, places, places[1:]):
            assert ids[a:b].tolist() == [*ids_of(text), 2], text


def test_words_inside_texts_are_encoded_at_once(monkeypatch):
    encoder = token_orc.LibraryEncoder("byte_bpe_50k.json")
    single, work = [], encoder.memory.work
    monkeypatch.setattr(encoder.memory, "work", lambda chunks: single.extend(chunks) or work(chunks))
    text = "Größer, naïve\nñandú. ĠĊ Ġx 日本語?! don't (a) 12 x1 Straße--- Größer"
    places, ids = encoder.encode(pa.array([text, f"b {text}"]), np.array([2], dtype="<u4").tobytes())
    # Only the heads are left for the list of chunks; all other words go through Arrow.
    assert sorted(single) == ["Größer,", "b"]
    for given, a, b in zip([text, f"b {text}"], places, places[1:]):
        assert ids[a:b].tolist() == [*ids_of(given), 2]


def test_token_files(spark, tmp_path):
    path = f"{tmp_path}/tokens"
    token_orc.write_token_files(documents(spark), path, files=3)
    rows = token_orc.read_token_files(spark, path).orderBy("start").collect()
    order = [None, *range(1, len(TEXTS)), len(TEXTS) - 1]
    assert [row.doc_id for row in rows] == order
    start = 0
    for row in rows:
        assert row.ids == [*ids_of(TEXTS[row.doc_id or 0]), 2]
        assert (row.start, row.n_tokens) == (start, len(row.ids))
        start += row.n_tokens
    checked = token_orc.checked_tokens(spark, path).orderBy("start").collect()
    for row, sums in zip(rows, checked, strict=True):
        crc = zlib.crc32(np.array(row.ids, dtype="<u4").tobytes())
        assert (sums.doc_id, sums.start, sums.ids_crc32) == (row.doc_id, row.start, crc)
    few = token_orc.documents_by_id(spark, path, [3, 5])
    assert sorted(r.doc_id for r in few.collect()) == [3, 5]
    plan = few._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(doc_id" in plan


def test_token_files_of_an_empty_table(spark, tmp_path):
    path = f"{tmp_path}/tokens"
    token_orc.write_token_files(documents(spark).limit(0), path)
    assert token_orc.checked_tokens(spark, path).count() == 0


def test_token_query(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").orderBy("doc_id").collect()
    rows = by_id(queries.QUERIES["op2_token_orc"](spark, FOLDER))
    counts = by_id(queries.QUERIES["op3_prefix_token_counts"](spark, FOLDER))
    start = 0
    for doc in docs:
        ids = [*ids_of(doc.text), 2]
        row = rows[doc.doc_id]
        crc = zlib.crc32(np.array(ids, dtype="<u4").tobytes())
        assert (row.start, row.n_tokens, row.ids_crc32) == (start, len(ids), crc)
        assert counts[doc.doc_id].n_tokens == len(ids) - 1
        start += len(ids)


@pytest.fixture(scope="module")
def piece_coder():
    return pieces.PieceCoder("piece_bpe_32k.model")


def test_pieces_are_the_library_s(piece_coder):
    texts = random_texts(ALPHABET + [" " * 17, " " * 40], 600, 25, seed=3)
    places, ids = piece_coder.encode(pa.array(texts))
    for text, a, b in zip(texts, places, places[1:]):
        assert ids[a:b].tolist() == PIECES.encode(text), text


def test_decoding_any_ids(piece_coder):
    draw = random.Random(4)
    for _ in range(500):
        ids = [draw.randrange(260 if draw.random() < 0.5 else 32000) for _ in range(12)]
        assert piece_coder.decode(ids) == PIECES.decode(ids), ids


def test_encoded_documents_come_back(spark):
    rows = by_id(pieces.encode_and_check(documents(spark)))
    for i, text in enumerate(TEXTS):
        row = rows[i or None]
        assert row.ids == PIECES.encode(text or "") and row.n_ids == len(row.ids)
        assert row.round_trip
    assert pieces.encode_and_check(documents(spark).limit(0)).count() == 0


def test_pieces_are_made_and_decoded_in_one_python_task(spark):
    coded = pieces.encode_and_check(documents(spark))
    # Two of them in a row are two Python workers a core, which is too much for an executor.
    assert coded._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1
    apart = by_id(pieces.decode(pieces.encode(documents(spark))))
    for doc_id, row in by_id(pieces.encode_and_decode(documents(spark))).items():
        assert (row.ids, row.decoded) == (apart[doc_id].ids, apart[doc_id].decoded)
        assert row.decoded == PIECES.decode(row.ids)


def test_piece_query(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").collect()
    rows = by_id(queries.QUERIES["op10_sentencepiece"](spark, FOLDER))
    for doc in docs:
        assert rows[doc.doc_id].ids == PIECES.encode(doc.text) and rows[doc.doc_id].round_trip


@pytest.mark.parametrize("most", [1, 4])
def test_starts_do_not_depend_on_the_session_s_rows_per_file(spark, tmp_path, most):
    docs = documents(spark, [f"text number {i} " * (i % 5) for i in range(40)])
    spark.conf.set("spark.sql.files.maxRecordsPerFile", most)
    try:
        token_orc.write_token_files(docs, f"{tmp_path}/tokens")
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    rows = token_orc.checked_tokens(spark, f"{tmp_path}/tokens").orderBy("start").collect()
    start = 0
    for row in rows:
        assert row.start == start
        start += row.n_tokens
    assert len(rows) == docs.count()


def test_an_id_of_very_many_rows_is_spread_over_parts(spark, tmp_path):
    ids = "case when id % 3 = 0 then null when id % 3 = 1 then 40 else id end AS doc_id"
    docs = spark.range(600).selectExpr(ids, "concat('text ', id % 250) AS text")
    path = f"{tmp_path}/tokens"
    token_orc.write_token_files(docs, path, files=6)
    written = token_orc.token_rows(spark, path)
    for hot in ("doc_id is null", "doc_id = 40"):
        assert written.where(hot).select("part").distinct().count() > 1
    assert written.groupBy("part").count().agg({"count": "max"}).first()[0] < 200
    rows = token_orc.read_token_files(spark, path).orderBy("start").collect()
    assert [r.doc_id for r in rows] == [None] * 200 + sorted([40] * 200 + list(range(2, 600, 3)))
    start = 0
    for row in rows:
        assert row.start == start
        start += row.n_tokens
    texts = [(r.doc_id or -1, tuple([*ids_of(r.text), 2])) for r in docs.collect()]
    assert sorted((r.doc_id or -1, tuple(r.ids)) for r in rows) == sorted(texts)


def test_only_words_with_unusual_ends_are_looked_at_one_by_one():
    encoder = token_orc.LibraryEncoder("byte_bpe_50k.json")
    looked, plain = [], encoder.memory.plain
    encoder.memory.plain = lambda word: looked.append(word) or plain(word)
    texts = ["one two, three!?\nfour it's 12a (five) ... x", "", "é two ß, \x85x \tone\r x\x1c y\n\nz", " one<|endoftext|>, <s>two \n", "日本語, a­b… ǅungla², six"]
    places, ids = encoder.encode(pa.array(texts), np.array([2], "<u4").tobytes())
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for i, text in enumerate(texts):
        want = library.encode(text, add_special_tokens=False).ids
        assert ids[places[i] : places[i + 1]].tolist() == [*want, 2]
    assert {"one", "two,", "three!?", "it's", "(five)", "..."}.isdisjoint(looked) and "\x85x" in looked
