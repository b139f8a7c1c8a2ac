"""Document fingerprints: one-permutation MinHash, densified and packed.

Every shingle is hashed once. The leading bits of the hash choose one of 128 bins, which
keeps the smallest hash that falls into it. An empty bin takes the value of a full one: each
bin has its own fixed random order of all bins and takes the first full one in that order
(optimal densification), so equal sets fill equal bins alike. Of each bin the low-order byte
is stored, eight bins to a number. Bytes of different hashes agree by chance once in 256;
the likeness is corrected for it.

Sorting a document's hashes puts each bin's smallest first, so a fingerprint is made within
its row, by built-in functions only.

Cases: null text is the empty text. A text with fewer words than a shingle is one shingle, a
text without words the empty one, equal to others of that kind. Null doc_ids come first;
rows with equal doc_id follow by a hash of their texts. With one document, the next is
itself. Other columns are not read.
"""

from __future__ import annotations

import json
import math
import random

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardlens.llm.common import BLANKS

#: Leading bits that choose the bin; bins packed into a number.
BIN_BITS = 7
BINS = 1 << BIN_BITS
PACKED = 8
#: Bytes of text ordered together, about.
STRETCH_BYTES = 32 << 20
BLANK_CHARS = " \t\n\x0b\x0c\r"


def probes(bins: int = BINS, seed: int = 11) -> list[list[int]]:
    """Each bin's order in which it looks for a full bin."""
    draw = random.Random(seed)
    return [draw.sample(range(bins), bins) for _ in range(bins)]


def constant(values: list, kind: str) -> Column:
    """A list as one constant."""
    return F.from_json(F.lit(json.dumps(values)), kind)


def add_fingerprint(df: DataFrame, text: str, to: str, words: int = 5) -> DataFrame:
    """``df`` with column ``to``, the packed fingerprint of column ``text``.

    Every step is a column of its own that the next one uses more than once, so that Spark
    works it out once a row.
    """
    found, hashes, ordered, firsts, bins, low = (f"{to}_{k}" for k in ("words", "hashes", "ordered", "firsts", "bins", "low"))
    trimmed = F.btrim(F.col(text), F.lit(BLANK_CHARS))
    split = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, f"{BLANKS}+"))
    df = df.withColumn(found, F.transform(split, lambda w: F.xxhash64(w)))
    starts = F.sequence(F.lit(1), F.greatest(F.size(found) - (words - 1), F.lit(1)))
    df = df.withColumn(hashes, F.transform(starts, lambda i: F.xxhash64(F.slice(found, i, words))))
    df = df.withColumn(ordered, F.sort_array(hashes)).drop(found, hashes)

    def bin_of(value: Column) -> Column:
        return F.shiftrightunsigned(value, 64 - BIN_BITS)

    first = F.filter(ordered, lambda x, i: (i == 0) | (bin_of(x) != bin_of(F.get(F.col(ordered), i - 1))))
    df = df.withColumn(firsts, first).drop(ordered)
    df = df.withColumn(bins, F.transform(firsts, lambda x: bin_of(x).cast("int")))
    order = constant(probes(), "array<array<int>>")

    def value(j: Column) -> Column:
        place = F.array_position(F.col(bins), j)
        full = F.get(F.array_intersect(F.get(order, j), F.col(bins)), F.lit(0))
        borrowed = F.array_position(F.col(bins), full)
        taken = F.when(place > 0, place).otherwise(borrowed)
        return F.get(F.col(firsts), taken.cast("int") - 1).bitwiseAND(F.lit(255))

    df = df.withColumn(low, F.transform(F.sequence(F.lit(0), F.lit(BINS - 1)), value)).drop(firsts, bins)
    numbers = F.transform(
        F.sequence(F.lit(0), F.floor(F.size(low) / PACKED).cast("int") - 1),
        lambda k: F.aggregate(
            F.slice(low, k * PACKED + 1, PACKED),
            F.lit(0).cast("long"),
            lambda a, v: F.shiftleft(a, 8).bitwiseOR(v),
        ),
    )
    return df.withColumn(to, numbers).drop(low)


def shown(fingerprint: str) -> Column:
    """A packed fingerprint as hexadecimal digits."""
    return F.array_join(F.transform(fingerprint, lambda x: F.lower(F.lpad(F.hex(x), 16, "0"))), "")


def likeness(left: str, right: str) -> Column:
    """The estimated share of common shingles, 0 to 1, corrected for chance agreement."""

    def unequal(x: Column, y: Column) -> Column:
        # Each byte's lowest bit becomes one if any of its bits differs.
        bits = x.bitwiseXOR(y)
        for shift in (4, 2, 1):
            bits = bits.bitwiseOR(F.shiftrightunsigned(bits, shift))
        return F.bit_count(bits.bitwiseAND(F.lit(0x0101010101010101)))

    different = F.aggregate(F.zip_with(left, right, unequal), F.lit(0), lambda a, n: a + n)
    chance = 1 / 256
    agreeing = 1 - different / BINS
    return F.greatest(F.lit(0.0), (agreeing - chance) / (1 - chance))


def with_next(docs: DataFrame, key: str, tie: str, carried: list[str]) -> DataFrame:
    """``docs`` with next_<column> for the carried columns of the following row.

    Rows follow each other by key and tie, and the first follows the last. The order is cut
    into stretches at some of the keys; a row at a cut also ends the stretch before, as does
    the first row for the last stretch. ``docs`` must give the same rows when read again.
    """
    size = F.sum(F.octet_length(carried[0]))
    total, least, rows = docs.agg(size, F.min(key), F.count("*")).first()
    if not rows:
        return docs.withColumns({f"next_{c}": F.col(c) for c in carried})
    pieces = math.ceil((total or 0) / STRETCH_BYTES)
    bounds: list[int] = []
    if pieces > 1:
        shares = F.lit([i / pieces for i in range(1, pieces)])
        cuts = docs.agg(F.percentile_approx(key, shares, F.lit(max(10_000, 20 * pieces)))).first()[0]
        bounds = sorted({cut for cut in cuts if cut > least})
    block = max(1, math.isqrt(len(bounds)))
    blocks = [bounds[i : i + block] for i in range(0, len(bounds), block)]
    groups = constant(blocks or [[]], "array<array<bigint>>")
    leads = constant([b[0] for b in blocks], "array<bigint>")
    before = F.size(F.filter(leads, lambda b: b <= F.col(key)))
    within = F.size(F.filter(F.get(groups, before - 1), lambda b: b <= F.col(key)))
    stretch = F.when(before == 0, F.lit(0)).otherwise((before - 1) * block + within)
    cut = F.coalesce(F.array_contains(F.get(groups, before - 1), F.col(key)), F.lit(False))
    docs = docs.withColumns({"_stretch": stretch, "_cut": cut})

    def at(where: Column, kind: int) -> Column:
        return F.struct(where.cast("int").alias("stretch"), F.lit(kind).alias("kind"))

    places = F.array(
        at(F.col("_stretch"), 0),
        F.when(F.col("_cut"), at(F.col("_stretch") - 1, 1)),
        F.when(F.col(key) == least, at(F.lit(len(bounds)), 2)),
    )
    placed = docs.withColumn("_at", F.explode(F.array_compact(places)))
    placed = placed.withColumns({"_stretch": F.col("_at.stretch"), "_kind": F.col("_at.kind")})
    # In a stretch: its rows, then the rows of the cut behind it or, in the last, the first.
    order = Window.partitionBy("_stretch").orderBy("_kind", key, tie)
    followed = placed.withColumns({f"next_{c}": F.lead(c).over(order) for c in carried})
    return followed.where("_kind = 0").drop("_stretch", "_cut", "_at", "_kind")


def fingerprint_report(docs: DataFrame, *, words: int = 5) -> DataFrame:
    """Fingerprints of all texts and of their edited texts, and how like they are.

    The edited text has its last half replaced by the beginning of the next document's text.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    least = F.lit(-(1 << 63))
    rows = docs.select(
        "doc_id",
        text.alias("body"),
        F.coalesce(F.col("doc_id").cast("long"), least).alias("key"),
        F.xxhash64(text).alias("tie"),
    )
    rows = add_fingerprint(rows, "body", "own", words)
    rows = with_next(rows, "key", "tie", ["body", "own"])
    n = F.char_length("body")
    half = F.floor(n / 2).cast("int")
    rows = rows.withColumn("n", n.cast("long")).withColumn(
        "edited", F.concat(F.left("body", n - half), F.left("next_body", half))
    )
    rows = add_fingerprint(rows.drop("body", "next_body"), "edited", "changed", words)
    return rows.select(
        "doc_id",
        F.col("n").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        shown("own").alias("fingerprint"),
        shown("changed").alias("edited_fingerprint"),
        likeness("own", "changed").alias("near_edited"),
        likeness("own", "next_own").alias("near_next"),
    )
