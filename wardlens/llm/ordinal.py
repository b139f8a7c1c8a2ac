"""Quality classifier: cumulative-link regression on graded ratings over hashed text.

A text is the set of its words, each hashed to one of 2**18 places, with a few places for
its overall form. One weight per place, shared by all grades, gives a score; ordered
thresholds cut the scores into grades: P(grade > k) = logistic(score - threshold k). So a
grade between others is learned from both sides, and expected grade and tail probability
come from the same score.

The model is fitted on at most ``SAMPLE`` pairs of a document and its rating (those with the
smallest hashes of their ids, then of smallest grade and text hash) by full-batch steps; the
scores cover all documents and whole texts. Equal ratings of an id and its equal documents
are counted before they meet, so repeated ids make no more pairs than documents times grades.

The test tables hold no graded ratings; the query makes grades from quality and toxic.

Cases: null text is the empty text. Ratings that are null count for nothing; a document
rated several times counts as often. Without ratings of two grades every document gets the
same score. Null doc_ids have no rating. Repeated rows are scored alike. An empty table
gives an empty result.
"""

from __future__ import annotations

import string
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardlens.llm.common import by_arrow, repeats, slices, smallest_chances, stage

#: Most rated documents the model is fitted on.
SAMPLE = 20_000
PLACES = 1 << 18
#: Steps of the fit, their size for weights and thresholds, momentum and shrinkage.
STEPS = 150
RATE = 20.0
CUT_RATE = 0.1
MOMENTUM = 0.9
SHRINK = 1e-4
#: Least logarithm of a gap between thresholds.
LEAST_GAP = -10.0


def places_of(word: str) -> tuple[int, int]:
    """Places of a word without marks around it, and of the marks behind it."""
    import xxhash

    core = word.strip(string.punctuation)
    marks = word[len(word.rstrip(string.punctuation)) :]
    digest = xxhash.xxh64_intdigest
    return (
        digest(f"w {core}".encode()) % PLACES if core else -1,
        digest(f"m {marks}".encode()) % PLACES if marks else -1,
    )


def form_places(size: int, distinct: int, chars: int) -> list[int]:
    """Places of a text's form: how often words repeat and how long they are."""
    import xxhash

    repeats = int(np.log2(size / distinct) * 2) if distinct else -1
    length = min(chars // size, 20) if size else -1
    names = (f"r {repeats}", f"l {length}", f"n {int(np.log2(size + 1))}")
    return [xxhash.xxh64_intdigest(name.encode()) % PLACES for name in names]


def hashed(texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
    """Each text's distinct places: where they start and end, and all of them."""
    split = pc.ascii_split_whitespace(pc.utf8_lower(texts))
    ends = split.offsets.to_numpy().astype(np.int64)
    coded = split.values.slice(ends[0], ends[-1] - ends[0]).dictionary_encode()
    ends -= ends[0]
    index = coded.indices.to_numpy(zero_copy_only=False)
    words = coded.dictionary.to_pylist()
    known = np.array([places_of(word) for word in words], dtype=np.int64).reshape(-1, 2)
    sizes = np.array([len(word) for word in words], dtype=np.int64)
    chars = np.concatenate([[0], np.cumsum(sizes[index])])
    rows = np.repeat(np.arange(len(texts)), np.diff(ends))
    keys = np.unique(rows * len(words) + index) if len(words) else np.array([], np.int64)
    distinct = np.bincount(keys // max(1, len(words)), minlength=len(texts))
    pairs = known[keys % max(1, len(words))] if len(words) else known
    row = np.repeat(keys // max(1, len(words)), 2)
    place = pairs.reshape(-1)
    row, place = row[place >= 0], place[place >= 0]
    sizes_of = np.diff(ends)
    form = [
        form_places(int(n), int(d), int(chars[b] - chars[a]))
        for n, d, a, b in zip(sizes_of, distinct, ends, ends[1:], strict=False)
    ]
    form_row = np.repeat(np.arange(len(texts)), 3)
    row = np.concatenate([row, form_row])
    place = np.concatenate([place, np.array(form, dtype=np.int64).reshape(-1)])
    both = np.unique(row * PLACES + place)
    starts = np.searchsorted(both, np.arange(len(texts) + 1) * PLACES)
    return starts, (both % PLACES).astype(np.int32)


@dataclass
class Model:
    """Weights by place, the thresholds between the grades, and what the fit left.

    ``slope`` is the largest slope of the fitted mean log-likelihood at the end, by any weight
    or threshold; it tells how far the steps have settled.
    """

    weights: np.ndarray
    thresholds: np.ndarray
    slope: float = 0.0

    def scores(self, starts: np.ndarray, places: np.ndarray) -> np.ndarray:
        # Every text has places of its form, so no sum is empty.
        sums = np.add.reduceat(self.weights[places], starts[:-1])
        return sums / np.sqrt(np.diff(starts))

    def tails(self, scores: np.ndarray) -> np.ndarray:
        """P(grade > k) by text (rows) and threshold (columns)."""
        return logistic(scores[:, None] - self.thresholds[None, :])


def logistic(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def contrast(starts: np.ndarray, places: np.ndarray, best: np.ndarray) -> np.ndarray:
    """How far each place's share among the best texts is from that among the others.

    The absolute log ratio, counts raised by one, measured from the median of common places;
    it scales the features, so that places that tell grades apart learn fast and the many
    rare ones hardly at all.
    """
    every = np.bincount(places, minlength=PLACES)
    good = np.bincount(places[np.repeat(best, np.diff(starts))], minlength=PLACES)
    other = every - good
    ratio = np.log((good + 1) / (good.sum() + PLACES)) - np.log((other + 1) / (other.sum() + PLACES))
    common = every >= np.quantile(every[every > 0], 0.99)
    return np.abs(ratio - np.median(ratio[common]))


@dataclass
class Ratings:
    """Rated texts: their features as (row, place, value), their grades, what each row weighs."""

    row: np.ndarray
    place: np.ndarray
    value: np.ndarray
    grades: np.ndarray
    balance: np.ndarray

    def likelihood(self, weights: np.ndarray, cuts: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        """The weighed log-likelihood less the shrinkage, its slopes by weight and by threshold."""
        size, top = len(self.grades), len(cuts)
        rows, none = np.arange(size), np.zeros((size, 1))
        scores = np.bincount(self.row, self.value * weights[self.place], minlength=size)
        tails = logistic(scores[:, None] - cuts)
        edges = np.hstack([none + 1, tails, none])
        chance = np.maximum(edges[rows, self.grades] - edges[rows, self.grades + 1], 1e-12)
        slopes = np.hstack([none, tails * (1 - tails), none])
        upper = self.balance * slopes[rows, self.grades] / chance
        lower = self.balance * slopes[rows, self.grades + 1] / chance
        pull = (upper - lower)[self.row] * self.value
        by_weight = np.bincount(self.place, pull, minlength=len(weights)) - SHRINK * weights
        # A threshold is pulled up by the grade that ends at it, down by the one above.
        by_cut = (
            np.bincount(self.grades, lower, minlength=top + 1)[:top]
            - np.bincount(self.grades, upper, minlength=top + 1)[1:]
        )
        total = float(self.balance @ np.log(chance) - SHRINK / 2 * (weights @ weights))
        return total, by_weight, by_cut


def thresholds(gaps: np.ndarray) -> np.ndarray:
    """Thresholds from the first of them and the logarithms of the gaps behind it."""
    return np.cumsum(np.concatenate([gaps[:1], np.exp(gaps[1:])]))


def fit_model(starts: np.ndarray, places: np.ndarray, grades: np.ndarray, top: int) -> Model:
    """Accelerated gradient steps on the mean log-likelihood of grades 0 to ``top``.

    Every grade weighs alike. The steps go over gaps between thresholds, which are positive,
    so thresholds never meet and every grade keeps a chance. A grade without ratings leaves
    the gap before it to shrink towards nothing.
    """
    size = len(grades)
    scale = contrast(starts, places, grades == top)
    row = np.repeat(np.arange(size), np.diff(starts))
    value = scale[places] / np.sqrt(np.maximum(np.diff(starts), 1))[row]
    counts = np.bincount(grades, minlength=top + 1)
    rated = Ratings(row, places, value, grades, 1 / (counts[grades] * (counts > 0).sum()))

    def slopes(weights: np.ndarray, gaps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        _, by_weight, by_cut = rated.likelihood(weights, thresholds(gaps))
        # A gap moves its own threshold and all behind it.
        behind = np.cumsum(by_cut[::-1])[::-1]
        return by_weight, behind * np.concatenate([[1.0], np.exp(gaps[1:])])

    weights, moved = np.zeros(PLACES), np.zeros(PLACES)
    gaps, gaps_moved = np.zeros(top), np.zeros(top)
    gaps[0] = -(top - 1) / 2
    for _ in range(STEPS):
        by_weight, by_gap = slopes(weights + MOMENTUM * moved, gaps + MOMENTUM * gaps_moved)
        moved = MOMENTUM * moved + RATE * by_weight
        gaps_moved = MOMENTUM * gaps_moved + CUT_RATE * by_gap
        weights, gaps = weights + moved, gaps + gaps_moved
        gaps[1:] = np.maximum(gaps[1:], LEAST_GAP)
    left = np.concatenate(slopes(weights, gaps))
    return Model(weights * scale, thresholds(gaps), float(np.abs(left).max()))


def fit(docs: DataFrame, ratings: DataFrame, top: int, sample: int = SAMPLE) -> Model:
    """A model from ``ratings`` (doc_id, grade from 0 to ``top``) of ``docs``."""
    keep = stage(docs.sparkSession).keep
    ids = docs.where("doc_id is not null").select("doc_id").distinct()
    rated = ratings.where("doc_id is not null and grade is not null")
    # Equal ratings, and equal documents further down, are counted and meet as one row each.
    rated = rated.groupBy("doc_id", "grade").agg(F.count("*").alias("n_rated"))
    rated = keep(rated.join(ids, "doc_id", "left_semi"), "rated")
    chance = F.xxhash64(F.lit(3), "doc_id")
    chosen = keep(smallest_chances(rated, chance, sample, "doc_id", "grade"), "chosen")
    # At most ``sample`` rows, a bound that holds for any table. Each has a document at least,
    # so the documents of no other rating can be in the sample.
    hashed_docs = docs.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"))
    counted = hashed_docs.join(F.broadcast(chosen.select("doc_id").distinct()), "doc_id", "left_semi")
    counted = counted.groupBy("doc_id", "text_hash").agg(F.count("*").alias("n_docs"))
    pairs = counted.join(F.broadcast(chosen), "doc_id")
    pairs = keep(pairs.withColumn("n", F.col("n_rated") * F.col("n_docs")).drop("n_rated", "n_docs"), "pairs")
    pairs = keep(smallest_chances(pairs, chance, sample, "doc_id", "grade", "text_hash"), "sample")
    texts = pairs.select("doc_id", "text_hash").distinct()
    few = hashed_docs.join(F.broadcast(texts), ["doc_id", "text_hash"], "left_semi")
    few = few.groupBy("doc_id", "text_hash").agg(F.min("text").alias("text")).join(pairs, ["doc_id", "text_hash"])

    names = ["chance", "key", "grade", "text_hash", "n"]

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches):
            starts, places = hashed(texts)
            lists = pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), pa.array(places))
            columns = [batch.column(name) for name in names]
            yield pa.RecordBatch.from_arrays([*columns, lists], names=[*names, "places"])

    place = chance.bitwiseAND(F.lit((1 << 63) - 1)).alias("chance")
    few = few.select(place, F.col("doc_id").cast("long").alias("key"), F.col("grade").cast("int"), "text_hash", "n", "text")
    rows = by_arrow(few, work, "chance long, key long, grade int, text_hash long, n long, places array<int>").toArrow()
    # In the order of the choice, so that what is left out and sums are the same in every run.
    rows = rows.sort_by([(name, "ascending") for name in names[:-1]])
    rows = rows.take(repeats(rows.column("n").to_numpy(), sample))
    grades = rows.column("grade").to_numpy().astype(np.int64)
    if not len(grades) or len(np.unique(grades)) < 2:
        return Model(np.zeros(PLACES), np.arange(top, dtype=np.float64))
    lists = rows.column("places").combine_chunks()
    return fit_model(lists.offsets.to_numpy().astype(np.int64), lists.values.to_numpy(), grades, top)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, expected_grade and p_top (the tail probability of the best grade)."""
    bank = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches):
            tails = bank.value.tails(bank.value.scores(*hashed(texts)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(tails.sum(axis=1)), pa.array(tails[:, -1])],
                names=["doc_id", "expected_grade", "p_top"],
            )

    return by_arrow(docs.select(F.col("doc_id").cast("long"), "text"), work, "doc_id long, expected_grade double, p_top double")


def grade_of(quality: Column, toxic: Column) -> Column:
    """Grades of labels: 0 low quality, 1 good but toxic, 2 good."""
    return F.when(quality == 0, 0).when(F.coalesce(toxic, F.lit(0)) != 0, 1).otherwise(2)


def quality_report(docs: DataFrame, labels: DataFrame, *, least: float = 0.5) -> DataFrame:
    """doc_id, expected_grade, p_top and kept (p_top at least ``least``) of every document."""
    known = labels.where("quality is not null")
    ratings = known.select("doc_id", grade_of(F.col("quality"), F.col("toxic")).cast("int").alias("grade"))
    scored = score(docs, fit(docs, ratings, top=2))
    return scored.withColumn("kept", F.col("p_top") >= least)
