"""Personal data against Python's regular expressions, and the learned contexts."""

import hashlib
import random
import re
import time

import numpy as np
import pytest
from llm_documents import CLASHING, FOLDER, LONG, TEXTS, by_id, documents, random_texts
from pyspark.sql import functions as F

from wardlens.llm import pii, queries
from wardlens.llm.common import stage

FORMS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def is_valid(kind, found):
    digits = re.sub("[^0-9]", "", found)
    if kind == "ip":
        return all(int(part) <= 255 for part in found.split("."))
    if kind == "card":
        total = 0
        for i, digit in enumerate(reversed(digits)):
            value = int(digit) * (1 + i % 2)
            total += value - 9 if value > 9 else value
        return 13 <= len(digits) <= 19 and total % 10 == 0
    return kind != "phone" or 9 <= len(digits) <= 15


def base_spans(text):
    return [
        f"{kind}:{m.start()}:{m.end()}"
        for kind, form in FORMS.items()
        for m in re.finditer(form, text or "")
        if is_valid(kind, m.group())
    ]


def check(row, text):
    spans = base_spans(text)
    assert row.base_sha256 == hashlib.sha256(",".join(spans).encode()).hexdigest(), text
    assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == [
        sum(span.startswith(kind) for span in spans) for kind in FORMS
    ]
    assert set(spans) <= set(row.spans.split(",")) or not spans


def test_base_spans_of_awkward_documents(spark):
    rows = by_id(pii.pii_report(documents(spark)))
    for i, text in enumerate(TEXTS):
        if text != LONG:  # Python's patterns take quadratic time on it
            check(rows[i or None], text)
    assert rows[TEXTS.index(LONG)].spans == ""
    assert pii.pii_report(documents(spark)).count() == len(TEXTS) + 1


def test_base_spans_of_random_texts(spark):
    alphabet = [*"a.@1-+ (é🙂_%", "23", "4", "a@b.c", "1.2.3.4", "255.", "+1 2", "4111 1111 1111 1111", "@@", ".."]
    texts = random_texts(alphabet, 800, 40)
    rows = by_id(pii.pii_report(documents(spark, texts)))
    for i, text in enumerate(texts):
        check(rows[i or None], text)


def test_base_spans_of_the_table(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").collect()
    rows = by_id(queries.QUERIES["op4_bootstrapped_pii"](spark, FOLDER))
    for doc in docs:
        check(rows[doc.doc_id], doc.text)


CONTEXTS = [f"please call me at +1 (441) 555-{1000 + i} now" for i in range(20)] + [
    "please call me at 555-7777 today",
    "nothing here 5555 ok",
    "you can meet me at 12 or so",
]


def test_contexts_find_unseen_identifiers_and_leave_others(spark):
    rows = by_id(pii.pii_report(documents(spark, CONTEXTS)))
    assert rows[20].spans == "phone:18:26" and rows[20].n_added == 1 and rows[20].n_phone == 0
    assert rows[21].spans == rows[22].spans == ""


def test_scores_follow_the_graph(spark):
    """By hand: a pattern's share of good occurrences, and what its instances then get."""
    rows = [("p", i, 0) for i in range(4)] + [("p", 9, None), ("q", 9, None), ("q", 5, None), ("r", 6, None)]
    candidates = spark.createDataFrame(rows, "pattern string, instance long, seed int")
    sure = {r.pattern: r.kind for r in pii.sure_patterns(candidates, stage(spark).keep).collect()}
    assert sure == {"p": 0}


def test_masking(spark):
    docs = documents(spark, [*CONTEXTS, *TEXTS])
    masked = pii.mask(docs)
    assert masked.columns == docs.columns and masked.count() == docs.count()
    rows = by_id(masked)
    assert rows[20].text == "please call me at <PHONE> today"
    assert rows[5].text == "please call me at <PHONE> now"
    at = len(CONTEXTS)
    assert rows[at].text is None and rows[at + 1].text == ""
    mail = rows[at + 10].text
    assert mail.startswith("mail <EMAIL> or <PHONE>, host ") and "555" not in mail
    assert rows[at + 5].text == TEXTS[5] and rows[at + 15].text == LONG
    assert all(rows[3][name] == f"own {name}" for name in CLASHING.split())
    assert pii.mask(docs.limit(0)).count() == 0


def test_running_totals_over_blocks(spark):
    from wardlens.llm.common import add_running_total

    df = spark.range(200).selectExpr("id", "transform(sequence(1, cast(id as int)), x -> cast(x as bigint)) AS v")
    df = df.withColumn("v", df.v).where("id <> 0").unionByName(
        spark.sql("SELECT 0L AS id, cast(array() AS array<bigint>) AS v")
    )
    for row in add_running_total(df, "v", "t").collect():
        assert row.t == [sum(row.v[:i]) for i in range(len(row.v))]


def pieces_of(row, text):
    """What the spans of a report's row cover."""
    return [text[int(a) : int(b)] for _, a, b in (span.split(":") for span in row.spans.split(",") if span)]


ENTRIES = [f"555-{2000 + i}" for i in range(40)]


def test_identifiers_of_many_groups_and_long_lists(spark):
    iban = "FR14 2004 1010 0505 0001 3M02 606"
    texts = [f"please call me at {iban} now"]
    texts += [f"please call me at {blank.join(ENTRIES)} now 1234 so" for blank in (" ", "\n", "\t", "  ", "\r\n\r\n")]
    rows = by_id(pii.pii_report(documents(spark, CONTEXTS[:20] + texts, repeats=0)))
    assert pieces_of(rows[20], texts[0]) == [iban] and rows[20].n_added == 1
    assert pieces_of(rows[21], texts[1]) == [" ".join(ENTRIES)]
    for i, text in enumerate(texts[2:], 22):
        assert pieces_of(rows[i], text) == ENTRIES and rows[i].n_added == len(ENTRIES), text


def test_lists_with_seeds_among_their_entries(spark):
    mixed = " ".join([*ENTRIES[:9], "10.0.0.1", "x10.0.0.2", *ENTRIES[9:12], "a1@b.c"])
    texts = [f"please call me at {mixed} now", "please call me at 10.0.0.3 FR14 2004 12 now", "10.0.0.4 5555 no words"]
    rows = by_id(pii.pii_report(documents(spark, CONTEXTS[:20] + texts, repeats=0)))
    expected = {"10.0.0.1", "10.0.0.2", "a1@b.c", " ".join(ENTRIES[:9]), " ".join(ENTRIES[9:12])}
    assert set(pieces_of(rows[20], texts[0])) == expected and rows[20].n_added == 2
    assert set(pieces_of(rows[21], texts[1])) == {"10.0.0.3", "FR14 2004 12"}
    assert pieces_of(rows[22], texts[2]) == ["10.0.0.4"]


def test_long_lists_leave_their_pattern_sure(spark):
    """A list is one occurrence of its pattern; what cannot be an identifier in it is none."""
    texts = ["please call me at " + "\n".join(f"555-{1000 + i}" for i in range(600)), "please call me at 555-7777 today"]
    texts += [f"please call me at +1 (441) 555-{3000 + i}\n{i}. next" for i in range(20)]
    rows = by_id(pii.pii_report(documents(spark, CONTEXTS[:20] + texts, repeats=0)))
    assert rows[20].n_added == 600 and rows[21].spans == "phone:18:26"
    assert all(rows[22 + i].n_added == 0 for i in range(20))


@pytest.mark.parametrize(("entry", "blank", "count"), [("555-{}", "\n", 2000), ("a{}@b.c", " ", 400)])
def test_a_long_list_takes_no_longer_than_its_length(spark, entry, blank, count):
    texts = ["please call me at " + blank.join(entry.format(1000 + i) for i in range(count))]
    start = time.time()
    rows = by_id(pii.pii_report(documents(spark, CONTEXTS[:20] + texts, repeats=0)))
    assert time.time() - start < 100
    check(rows[20], texts[0])


def test_no_filter_splits_texts_again(spark):
    df = documents(spark, CONTEXTS)
    rows = df.select(*(c.alias(k) for k, c in pii.row_key(df).items()), F.col("text").alias("body"))
    rows = pii.add_chains(pii.add_base_spans(rows, "body", "base"), "body", "chains")
    rows = stage(spark).keep(rows.drop("body"), "rows")
    plan = pii.candidates(rows, "key_id", "key_null", "key_text")._jdf.queryExecution().optimizedPlan().toString()
    filters = [line for line in plan.split("\n") if re.match(r"[\s:+-]*Filter", line)]
    assert filters and not any("split(" in line for line in filters)


def test_any_number_of_blanks_before_an_identifier(spark):
    blanks = [1, 2, 78, 79, 80, 100, 1000]
    texts = [f"please call me at{' ' * n}555-7777 today" for n in blanks] + ["please call me" + "\n" * 500 + "at\t555-7777"]
    rows = by_id(pii.pii_report(documents(spark, CONTEXTS[:20] + texts, repeats=0)))
    for i, text in enumerate(texts, 20):
        assert pieces_of(rows[i], text) == ["555-7777"]


def brute_scores(rows):
    """Scores of (pattern, kind) by solving the equations, and each pattern's support."""
    patterns = sorted({p for p, _, _ in rows})
    seeds = {}
    for _, i, kind in rows:
        if kind is not None:
            seeds[i] = min(kind, seeds.get(i, 9))
    found = {}
    for kind in range(4):
        a, b = np.eye(len(patterns)), np.zeros(len(patterns))
        for at, p in enumerate(patterns):
            own = [i for q, i, _ in rows if q == p]
            for i in own:
                if i in seeds:
                    b[at] += (seeds[i] == kind) / (len(own) + 1)
                    continue
                all_of = [q for q, j, _ in rows if j == i]
                for q in all_of:
                    a[at, patterns.index(q)] -= pii.DAMPING / len(all_of) / (len(own) + 1)
        found |= {(p, kind): x for p, x in zip(patterns, np.linalg.solve(a, b), strict=True)}
    support = {(p, k): len({i for q, i, _ in rows if q == p and seeds.get(i) == k}) for p, k in found}
    return found, support


@pytest.mark.parametrize("seed", range(3))
def test_settled_scores_solve_the_equations(spark, seed):
    draw = random.Random(seed)
    rows = []
    for p in "abcdefgh":
        for _ in range(draw.randint(3, 14)):
            i = draw.randrange(40)
            rows.append((p, i, i % 3 if i < 18 else None))
    # A chain that scores reach one round after the other.
    chain = [("k0", 100 + i, 0) for i in range(9)]
    chain += [(f"k{step + side}", 200 + 9 * step + i, None) for step in range(6) for side in (0, 1) for i in range(9)]
    rows += chain
    steps = []

    def keep(df, name, keep=stage(spark).keep):
        kept = keep(df, name)
        steps.append((name, kept))
        return kept

    candidates = spark.createDataFrame(rows, "pattern string, instance long, seed int")
    sure = {(r.pattern, r.kind) for r in pii.sure_patterns(candidates, keep).collect()}
    last = [kept for name, kept in steps if name.startswith("patterns-")][-1]
    want, support = brute_scores(rows)
    got = {(r.pattern, r.kind): r.score for r in last.collect()}
    assert sum(name.startswith("patterns-") for name, _ in steps) > 4
    for key, score in want.items():
        assert abs(got.get(key, 0.0) - score) < 0.02, key
    assert got["k6", 0] > 0
    sure_ones = {k for k, score in want.items() if score >= pii.SURE + 0.02 and support[k] >= pii.SUPPORT}
    assert sure_ones <= sure


def test_scores_that_do_not_settle_are_an_error(spark, monkeypatch):
    monkeypatch.setattr(pii, "MOST_ROUNDS", 1)
    rows = [("p", i, 0) for i in range(4)] + [("p", 9, None), ("q", 9, None), ("q", 8, None), ("r", 8, None)]
    candidates = spark.createDataFrame(rows, "pattern string, instance long, seed int")
    with pytest.raises(RuntimeError, match="still changed"):
        pii.sure_patterns(candidates, stage(spark).keep)


def test_no_python_on_the_main_path(spark):
    plan = pii.pii_report(documents(spark, CONTEXTS))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
