"""Quality rules: a decision list learned by sequential covering.

Rules are conjunctions of thresholds on statistics of a text and name what to reject. One
rule after another is grown, condition by condition, on part of the labelled rows, cut back
on the rest, and taken if it is precise enough there; the rows it covers leave, and the next
rule is grown on what remains. The list becomes one Spark conditional expression, tried in
order; what no rule covers is kept.

The list is fitted on at most ``SAMPLE`` labelled rows (those with the smallest hashes of
their ids); the statistics and the decisions cover all rows.

Cases: null text has no words. Labels without quality or document do not count; without
labels the list is empty. A doc_id labelled or stored more than once counts as often; its
equal labels meet its documents as one row. Null doc_ids have no label. Repeated rows are judged alike. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardlens.llm.common import by_arrow, free_name, repeats, slices, smallest_chances, stage

#: Most labelled rows the list is fitted on.
SAMPLE = 20_000
#: Thresholds tried for a statistic; conditions of a rule; rules of a list.
CUTS = 64
CONDITIONS = 4
RULES = 16
#: What a rule must reach on the rows it was not grown on.
PRECISION = 0.95
COVERED = 5

COUNTS = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "n_lines",
    "n_upper",
    "n_digits",
    "n_distinct_words",
)
SYMBOLS = b"#*$%&|<>"
WINDOW = 5


def repeated_words(words: list[bytes], window: int = WINDOW) -> tuple[int, int]:
    """Words inside windows of words found more than once, and the distinct words."""
    numbers: dict[bytes, int] = {}
    ids = np.array([numbers.setdefault(word, len(numbers)) for word in words], dtype=np.int64)
    distinct, n = len(numbers), len(words)
    if n <= window or distinct == n:
        return 0, distinct
    code, span = ids[: n - window + 1], distinct
    for i in range(1, window):
        if span > (1 << 62) // distinct:
            _, code = np.unique(code, return_inverse=True)
            span = len(code)
        code = code * distinct + ids[i : n - window + 1 + i]
        span *= distinct
    ordered = np.sort(code)
    again = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(again):
        return 0, distinct
    starts = np.flatnonzero(np.isin(code, again))
    edge = np.zeros(n + 1, dtype=np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + window, -1)
    return int((np.cumsum(edge)[:n] > 0).sum()), distinct


def text_counts(text: str) -> tuple[int, ...]:
    """The COUNTS of a text. Words are what stands between blanks."""
    raw = text.encode()
    words = raw.split()
    letters = np.bincount(np.frombuffer(raw, dtype=np.uint8), minlength=256)
    blanks = int(letters[9:14].sum() + letters[32])
    lines = [line for line in raw.split(b"\n") if line.strip()] if letters[10] else raw.strip() and [raw] or []
    repeated, distinct = repeated_words(words)
    return (
        len(words),
        len(text) - blanks,
        int(letters[list(SYMBOLS)].sum()),
        len(lines) - len(set(lines)),
        repeated,
        len(lines),
        int(letters[65:91].sum()),
        int(letters[48:58].sum()),
        distinct,
    )


def with_counts(docs: DataFrame, names: dict[str, str]) -> DataFrame:
    """``docs`` with the COUNTS of text, under the given names."""
    columns = docs.columns
    fields = docs.schema.fields + [T.StructField(names[c], T.LongType()) for c in COUNTS]

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches):
            counts = np.array([text_counts(text) for text in texts.to_pylist()], dtype=np.int64)
            counts = counts.reshape(len(texts), len(COUNTS))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *(pa.array(counts[:, i]) for i in range(len(COUNTS)))],
                names=[*columns, *(names[c] for c in COUNTS)],
            )

    return by_arrow(docs, work, T.StructType(fields))


def features(names: dict[str, str]) -> dict[str, Column]:
    """The statistics rules look at, from the counts."""
    def share(part: str, whole: str) -> Column:
        return F.col(names[part]) / F.greatest(F.col(names[whole]), F.lit(1))

    return {
        "words": F.col(names["n_words"]).cast("double"),
        "chars_per_word": share("word_chars", "n_words"),
        "symbols_per_word": share("n_symbols", "n_words"),
        "dup_line_share": share("n_dup_lines", "n_lines"),
        "repeat_share": share("n_repeat_words", "n_words"),
        "upper_share": share("n_upper", "word_chars"),
        "digit_share": share("n_digits", "word_chars"),
        "words_per_line": share("n_words", "n_lines"),
        "distinct_share": share("n_distinct_words", "n_words"),
    }


def base_failed(names: dict[str, str]) -> Column:
    words, repeated = F.col(names["n_words"]), F.col(names["n_repeat_words"])
    return (words < 10) | (100 * repeated > 20 * words)


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    cut: float

    def holds(self, rows: dict[str, np.ndarray]) -> np.ndarray:
        values = rows[self.feature]
        return values > self.cut if self.above else values <= self.cut

    def column(self, found: dict[str, Column]) -> Column:
        value = found[self.feature]
        return value > F.lit(self.cut) if self.above else value <= F.lit(self.cut)


Rule = tuple[Condition, ...]


def covers(rule: Rule, rows: dict[str, np.ndarray], size: int) -> np.ndarray:
    found = np.ones(size, dtype=bool)
    for condition in rule:
        found &= condition.holds(rows)
    return found


def grow(rows: dict[str, np.ndarray], bad: np.ndarray, open_: np.ndarray, cuts: dict[str, np.ndarray]) -> Rule:
    """Add the condition with most information gained until only bad rows are covered."""
    rule: Rule = ()
    covered = open_.copy()
    while len(rule) < CONDITIONS:
        p, n = int((covered & bad).sum()), int((covered & ~bad).sum())
        if not p or not n:
            break
        now = np.log2(p / (p + n))
        best, gain = None, 1e-9
        for name, values in rows.items():
            places = np.searchsorted(cuts[name], values[covered])
            size = len(cuts[name]) + 1
            good_at = np.cumsum(np.bincount(places[~bad[covered]], minlength=size))[:-1]
            bad_at = np.cumsum(np.bincount(places[bad[covered]], minlength=size))[:-1]
            for above in (False, True):
                ps, ns = (p - bad_at, n - good_at) if above else (bad_at, good_at)
                with np.errstate(divide="ignore", invalid="ignore"):
                    gains = np.where(ps > 0, ps * (np.log2(ps / np.maximum(ps + ns, 1)) - now), 0.0)
                i = int(np.argmax(gains))
                if len(gains) and gains[i] > gain:
                    best, gain = Condition(name, above, float(cuts[name][i])), gains[i]
        if best is None:
            break
        rule += (best,)
        covered &= best.holds(rows)
    return rule


def prune(rule: Rule, rows: dict[str, np.ndarray], bad: np.ndarray, open_: np.ndarray) -> Rule:
    """The shortest beginning of the rule that does best on other rows."""
    def worth(part: Rule) -> float:
        found = covers(part, rows, len(bad)) & open_
        p, n = int((found & bad).sum()), int((found & ~bad).sum())
        return (p - n) / (p + n) if p + n else -1.0

    return max((rule[:k] for k in range(1, len(rule) + 1)), key=lambda part: (worth(part), -len(part)), default=())


def learn(values: dict[str, np.ndarray], bad: np.ndarray, growing: np.ndarray) -> list[Rule]:
    """The list: sequential covering of the bad rows."""
    if not bad.any() or bad.all():
        return []
    cuts = {}
    for name, column in values.items():
        quantiles = np.unique(np.quantile(column, np.linspace(0, 1, CUTS + 1)))
        cuts[name] = (quantiles[1:] + quantiles[:-1]) / 2
    parts = []
    for chosen in (growing, ~growing):
        parts.append(({name: column[chosen] for name, column in values.items()}, bad[chosen]))
    (grown, grown_bad), (other, other_bad) = parts
    left, left_other = np.ones(len(grown_bad), bool), np.ones(len(other_bad), bool)
    rules: list[Rule] = []
    while len(rules) < RULES:
        rule = prune(grow(grown, grown_bad, left, cuts), other, other_bad, left_other)
        found = covers(rule, other, len(other_bad)) & left_other
        p, n = int((found & other_bad).sum()), int((found & ~other_bad).sum())
        if not rule or p < COVERED or p < PRECISION * (p + n):
            break
        rules.append(rule)
        left &= ~covers(rule, grown, len(grown_bad))
        left_other &= ~found
    return rules


def verdict(rules: list[Rule], names: dict[str, str]) -> Column:
    """The list as one conditional expression: false for what a rule rejects."""
    found = features(names)
    decision = None
    for rule in rules:
        holds = F.lit(True)
        for condition in rule:
            holds = holds & condition.column(found)
        decision = F.when(holds, False) if decision is None else decision.when(holds, False)
    return F.lit(True) if decision is None else decision.otherwise(True)


def fit(counted: DataFrame, labels: DataFrame, names: dict[str, str], sample: int = SAMPLE) -> list[Rule]:
    """Rules from the labelled rows of ``counted`` (doc_id and counts) that pass the base rules."""
    known = labels.where("quality is not null and doc_id is not null")
    # Equal labels of an id are counted, so that its documents meet two rows at most.
    known = known.groupBy("doc_id", (F.col("quality") == 0).alias("bad")).agg(F.count("*").alias("n"))
    chance = F.xxhash64(F.lit(5), "doc_id")
    found = features(names)
    rated = (
        counted.where(~base_failed(names))
        .join(known, "doc_id")
        .select(chance.alias("chance"), "bad", "n", *(c.alias(k) for k, c in found.items()))
    )
    rated = stage(counted.sparkSession).keep(rated, "rated")
    rows = smallest_chances(rated, F.col("chance"), sample, "bad", *found, "n").toPandas()
    if rows.empty:
        return []
    rows = rows.iloc[repeats(rows["n"].to_numpy(), sample)]
    values = {name: rows[name].to_numpy(dtype=np.float64) for name in found}
    growing = (rows["chance"].to_numpy() // 7 % 3) != 0
    return learn(values, rows["bad"].to_numpy(dtype=bool), growing)


def quality_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, counts, base_failed and kept of every document."""
    names = {c: c for c in COUNTS}
    counted = stage(docs.sparkSession).keep(with_counts(docs.select("doc_id", "text"), names).drop("text"), "counts")
    rules = fit(counted, labels, names)
    kept = ~F.col("base_failed") & verdict(rules, names)
    first = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    others = [c for c in COUNTS if c not in first]
    return counted.withColumn("base_failed", base_failed(names)).withColumn("kept", kept).select(*first, *others)


def passing(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that neither the base rules nor the learned list reject."""
    names = {c: c for c in COUNTS}
    slim = docs.select("doc_id", "text")
    counted = stage(docs.sparkSession).keep(with_counts(slim, names).drop("text"), "counts")
    rules = fit(counted, labels, names)
    own = {c: free_name(docs, c) for c in COUNTS}
    judged = with_counts(docs, own).where(~base_failed(own) & verdict(rules, own))
    return judged.select(*(F.col(f"`{c}`") for c in docs.columns))
