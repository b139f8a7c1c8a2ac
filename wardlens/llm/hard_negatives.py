"""Hard negatives by Kronecker-packed products.

Components become integers. Several candidates' components, biased to be no less than zero,
are put into separated fields of one wide integer; one multiplication with an anchor's
component then serves all of them, and the sums over the components hold the candidates'
inner products in the same fields, from which they are unpacked exactly. Wide integers of up
to 53 bits are carried by doubles, whose matrix product is exact as long as no sum reaches
2^53; components too large for that go into Python's integers, which have any width.

Anchors meet all rows in blocks: anchors are dealt to blocks, rows are dealt to blocks, and
a task works on one block of each. The first pass gives each anchor its positives, the
second, with the bounds that the positives' scores set, its negatives. A block gives at most
so many rows for each anchor (and positive) as are asked for; these are merged by anchor.

Cases: rows with a null id, label or vector or with a null or infinite component or one that
is no number take no part. Vectors of different lengths meet as if the shorter had zeros
behind. Components beyond 64 bits are cut to 64 bits, scores likewise. Rows with equal ids
are rows of their own: each is an anchor and a candidate, and an anchor's copies are other
rows. Equal scores come by id. An anchor without positives, or a positive without negatives,
gives no row. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardlens.llm.common import ship, stage

#: Rows and anchors of a block at most, and rows of a block if there are enough tasks.
BLOCK_ROWS = 1 << 17
BLOCK_ANCHORS = 1 << 16
SMALL_BLOCK = 1 << 12
#: Scores worked on at once.
TILE_ANCHORS = 512
TILE_ROWS = 1 << 13
#: Bits a double holds exactly, and the fields of a Python integer.
DOUBLE_BITS = 53
LONG_FIELDS = 32
MOST = (1 << 63) - 1
LEAST = -MOST


def integer_rows(rows: DataFrame, *, scale: int = 256) -> DataFrame:
    """vec_id, label and the integer components of the rows that take part."""
    usable = F.forall("embedding", lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
    there = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull()
    parts = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale))
    return rows.where(there & usable).select("vec_id", "label", parts.alias("parts"))


def matrix(parts: pa.ChunkedArray, width: int) -> np.ndarray:
    """Lists of integers as rows of one matrix, zeros behind the shorter ones."""
    lists = parts.combine_chunks()
    sizes = np.diff(lists.offsets.to_numpy())
    made = np.zeros((len(lists), width), dtype=np.int64)
    made[np.arange(width) < sizes[:, None]] = lists.flatten().to_numpy()
    return made


def largest(numbers: np.ndarray) -> int:
    return max(abs(int(numbers.min())), abs(int(numbers.max()))) if numbers.size else 0


class Packed:
    """The components of rows, several rows to a wide integer, for anchors within ``reach``."""

    def __init__(self, rows: np.ndarray, reach: int):
        self.count, width = rows.shape
        most = largest(rows)
        self.bias, self.reach = most, reach
        self.sums = rows.sum(axis=1, dtype=object if most > 1 << 40 else np.int64)
        # The largest sum of products of biased components.
        self.bits = max(1, (width * 2 * most * 2 * reach).bit_length())
        self.wide = self.bits > DOUBLE_BITS
        self.fields = LONG_FIELDS if self.wide else DOUBLE_BITS // self.bits
        groups = -(-self.count // self.fields)
        biased = np.zeros((groups * self.fields, width), dtype=object if self.wide else np.int64)
        biased[: self.count] = rows
        biased += most
        # Row k * groups + g is field k of group g.
        parts = biased.reshape(self.fields, groups, width)
        packed = parts[0].copy()
        for k in range(1, self.fields):
            packed += parts[k] * (1 << (self.bits * k))
        self.packed = (packed if self.wide else packed.astype(np.float64)).T.copy()
        self.groups = groups

    def scores(self, anchors: np.ndarray) -> np.ndarray:
        """Inner products, by anchor and row."""
        kind = object if self.wide else np.float64
        biased = anchors.astype(object) + self.reach if self.wide else anchors + self.reach
        sums = biased.astype(kind) @ self.packed
        made = np.empty((len(anchors), self.fields * self.groups), dtype=object if self.wide else np.int64)
        sums = sums if self.wide else sums.astype(np.int64)
        mask = (1 << self.bits) - 1
        for k in range(self.fields):
            made[:, k * self.groups : (k + 1) * self.groups] = (sums >> (self.bits * k)) & mask
        # (a + reach)(r + bias) = a r + reach r + bias a + reach bias, summed over components.
        of_anchor = biased.sum(axis=1) * self.bias
        made = made[:, : self.count]
        made -= of_anchor[:, None]
        made -= (self.sums * self.reach)[None, :]
        return np.clip(made, LEAST, MOST).astype(np.int64) if self.wide else made


def first_of_rows(scores: np.ndarray, allowed: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of each row's ``most`` largest allowed scores; ties by column."""
    many = np.flatnonzero(np.count_nonzero(allowed, axis=1) > 4 * most)
    if len(many):
        some = np.where(allowed[many], scores[many], LEAST)
        bound = np.partition(some, -most, axis=1)[:, -most]
        allowed = allowed.copy()
        allowed[many] &= some >= bound[:, None]
    row, column = np.nonzero(allowed)
    order = np.lexsort((column, ~scores[row, column], row))
    row, column = row[order], column[order]
    place = np.arange(len(row)) - np.searchsorted(row, row)
    return row[place < most], column[place < most]


class Block:
    """One block of rows in the order of their ids, to be met by anchors tile by tile."""

    def __init__(self, anchors: pa.Table, rows: pa.Table):
        rows = rows.sort_by("vec_id")
        both = [anchors.column("parts"), rows.column("parts")]
        width = max(pc.max(pc.list_value_length(lists)).as_py() or 0 for lists in both)
        self.anchors, self.rows = (matrix(lists, width) for lists in both)
        self.reach = largest(self.anchors)
        labels = np.concatenate([t.column("label").to_numpy() for t in (anchors, rows)])
        _, codes = np.unique(labels, return_inverse=True)
        self.anchor_label, self.label = codes[: len(anchors)], codes[len(anchors) :]
        self.anchor_row, self.row = anchors.column("row").to_numpy(), rows.column("row").to_numpy()
        self.ids = rows.column("vec_id").to_numpy()

    def tiles(self, among: np.ndarray) -> Iterator[tuple[np.ndarray, Packed]]:
        """Parts of the rows ``among`` (their places), packed."""
        for start in range(0, len(among), TILE_ROWS):
            places = among[start : start + TILE_ROWS]
            yield places, Packed(self.rows[places], self.reach)

    def best(self, of: np.ndarray, among: np.ndarray, allow, kinds: int, most: int):
        """Anchor, kind, row place and score of each anchor's first rows of each kind.

        ``allow(anchors, places, scores, kind)`` tells which rows count. Rows come in the
        order of their ids, so a later one must score more than the last one held.
        """
        held: dict[int, list] = {}
        for places, packed in self.tiles(among):
            for start in range(0, len(of), TILE_ANCHORS):
                some = of[start : start + TILE_ANCHORS]
                scores = packed.scores(self.anchors[some])
                for kind in range(kinds):
                    allowed = allow(some, places, scores, kind)
                    old = held.get((start, kind))
                    if old is not None:
                        full, last = old[3]
                        allowed &= ~full[:, None] | (scores > last[:, None])
                    row, column = first_of_rows(scores, allowed, most)
                    found = [row, places[column], scores[row, column]]
                    if old is not None:
                        found = [np.concatenate(pair) for pair in zip(old[:3], found, strict=True)]
                        order = np.lexsort((found[1], ~found[2], found[0]))
                        found = [x[order] for x in found]
                        place = np.arange(len(order)) - np.searchsorted(found[0], found[0])
                        found = [x[place < most] for x in found]
                    sizes = np.bincount(found[0], minlength=len(some))
                    last = np.full(len(some), LEAST)
                    ends = np.cumsum(sizes) - 1
                    last[sizes > 0] = found[2][ends[sizes > 0]]
                    held[start, kind] = [*found, (sizes >= most, last)]
        for (start, kind), (row, place, score, _) in held.items():
            yield of[start + row], np.full(len(row), kind), place, score


FOUND_SCHEMA = "anchor long, kind int, vec_id long, score long"
_FOUND = pa.schema([("anchor", pa.int64()), ("kind", pa.int32()), ("vec_id", pa.int64()), ("score", pa.int64())])


def found_table(block: Block, found: Iterator) -> pa.Table:
    parts = [
        pa.table([block.anchor_row[anchor], kind, block.ids[place], score], schema=_FOUND)
        for anchor, kind, place, score in found
    ]
    return pa.concat_tables(parts) if parts else _FOUND.empty_table()


def positives_of(most: int):
    """For a block of anchors and one of rows: each anchor's first other rows of its label."""

    def work(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        block = Block(anchors, rows)
        tables = []
        for label in np.unique(block.anchor_label):
            of, among = np.flatnonzero(block.anchor_label == label), np.flatnonzero(block.label == label)

            def others(some, places, scores, kind):
                return block.anchor_row[some][:, None] != block.row[places]

            tables.append(found_table(block, block.best(of, among, others, 1, most)))
        return pa.concat_tables(tables) if tables else _FOUND.empty_table()

    return work


def negatives_of(most: int, low: int, high: int, kinds: int):
    """For a block of anchors with bounds and one of rows: the first rows of other labels.

    ``bounds`` holds the positives' scores; a row counts for one of them if its score is
    from ``low`` to ``high`` hundredths of it.
    """

    def work(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        block = Block(anchors, rows)
        lowest = np.full((len(anchors), kinds), MOST)
        highest = np.full((len(anchors), kinds), LEAST)
        for i, scores in enumerate(anchors.column("scores").to_pylist()):
            for kind, score in enumerate(scores):
                lowest[i, kind] = -((-low * score) // 100)
                highest[i, kind] = high * score // 100

        def between(some, places, scores, kind):
            other = block.anchor_label[some][:, None] != block.label[places]
            return other & (scores >= lowest[some, kind, None]) & (scores <= highest[some, kind, None])

        everyone = np.arange(len(block.row))
        return found_table(block, block.best(np.arange(len(anchors)), everyone, between, kinds, most))

    return work


def in_blocks(anchors: DataFrame, rows: DataFrame, sizes: tuple[int, int], work) -> DataFrame:
    """Every block of anchors with every block of rows, each pair worked on by one task.

    ``sizes`` are the numbers of blocks. Anchors are sent once to each block of rows, rows
    once to each block of anchors.
    """
    ship(rows.sparkSession)
    anchor_blocks, row_blocks = sizes

    def other(blocks: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))

    def dealt(blocks: int) -> Column:
        return F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int")

    pair = ["anchor_block", "row_block"]
    left = anchors.withColumn(pair[0], dealt(anchor_blocks)).withColumn(pair[1], other(row_blocks))
    right = rows.withColumn(pair[1], dealt(row_blocks)).withColumn(pair[0], other(anchor_blocks))
    return left.groupBy(*pair).cogroup(right.groupBy(*pair)).applyInArrow(work, FOUND_SCHEMA)


def block_counts(rows: int, anchors: int, tasks: int) -> tuple[int, int]:
    """How many blocks of anchors and of rows: small ones while there are tasks without any."""
    least = math.ceil(rows / BLOCK_ROWS)
    return max(1, math.ceil(anchors / BLOCK_ANCHORS)), max(1, least, min(tasks, math.ceil(rows / SMALL_BLOCK)))


def first_found(found: DataFrame, most: int, *group: str) -> DataFrame:
    """Per group the array ``first`` of (order, vec_id), order being the negated score."""
    entry = F.struct((-F.col("score")).alias("order"), "vec_id")
    return found.groupBy(*group).agg(
        F.slice(F.array_sort(F.collect_list(entry)), 1, most).alias("first")
    )


def hard_negatives(
    rows: DataFrame,
    *,
    anchor: Column,
    positives: int = 5,
    negatives: int = 10,
    share: tuple[int, int] = (30, 90),
    scale: int = 256,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score.

    ``rows`` have vec_id (integer), label and embedding; ``anchor`` is a condition on vec_id
    and label. Positives are an anchor's first other rows of its label, negatives for each
    the first rows of other labels whose scores are from ``share[0]`` to ``share[1]``
    hundredths of the positive's.
    """
    spark = rows.sparkSession
    keep = stage(spark).keep
    used = integer_rows(rows, scale=scale)
    # Row numbers are written down: they stay the same when a task runs again.
    numbered = used.withColumns({"vec_id": F.col("vec_id").cast("long"), "row": F.monotonically_increasing_id()})
    used = keep(numbered, "used")
    anchors = keep(used.where(anchor), "anchors")
    tasks = 2 * spark.sparkContext.defaultParallelism
    sizes = block_counts(used.count(), anchors.count(), tasks)

    near = in_blocks(anchors, used, sizes, positives_of(positives))
    best = keep(first_found(near, positives, "anchor"), "positives")
    bounded = anchors.join(best, F.col("row") == F.col("anchor")).select(
        *anchors.columns, "first", F.transform("first", lambda x: -x["order"]).alias("scores")
    )
    bounded = keep(bounded, "bounded")
    far = in_blocks(
        bounded.select(*anchors.columns, "scores"), used, sizes, negatives_of(negatives, *share, positives)
    )
    found = first_found(far, negatives, "anchor", "kind")
    pairs = bounded.select(
        F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id"), F.posexplode("first").alias("kind", "positive")
    )
    return pairs.join(found, ["anchor", "kind"]).select(
        "anchor_id",
        F.col("positive.vec_id").alias("positive_id"),
        F.posexplode("first").alias("place", "negative"),
        (-F.col("positive.order")).alias("positive_score"),
    ).select(
        "anchor_id",
        "positive_id",
        (F.col("place") + 1).alias("rank"),
        F.col("negative.vec_id").alias("negative_id"),
        "positive_score",
        (-F.col("negative.order")).alias("negative_score"),
    )


def moved_labels(embeddings: DataFrame) -> DataFrame:
    """The table with the label of every seventh id moved to the next of ten."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return embeddings.withColumn("label", moved)


#: The query in SQL (DuckDB).
HARD_NEGATIVE_SQL = """
WITH used AS MATERIALIZED (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS parts,
    row_number() OVER () AS place
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scores AS MATERIALIZED (
  SELECT a.place AS anchor, a.vec_id AS anchor_id, r.place, r.vec_id, r.label = a.label AS same,
    list_inner_product(a.parts, r.parts)::BIGINT AS score
  FROM used a JOIN used r ON a.vec_id % 100 = 0 AND a.place <> r.place
), positives AS (
  SELECT anchor, anchor_id, place AS positive, vec_id AS positive_id, score AS positive_score
  FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id, place) <= 5
)
SELECT p.anchor_id, p.positive_id,
  (row_number() OVER nth)::INTEGER AS rank, s.vec_id AS negative_id, p.positive_score,
  s.score AS negative_score
FROM positives p JOIN scores s ON s.anchor = p.anchor AND NOT s.same
  AND 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score
WINDOW nth AS (PARTITION BY p.anchor, p.positive ORDER BY s.score DESC, s.vec_id, s.place)
QUALIFY row_number() OVER nth <= 10
"""
