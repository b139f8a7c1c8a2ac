"""A Bloom filter of staged ids, tested where a fact table is scanned.

A fact table without a date has nothing to restrict it by but the ids it is joined with. If
those are too many to broadcast, the join shuffles the whole table; behind the filter, only
rows whose id is among the staged ones, and a known small share of the others, are shuffled.
The filter is a constant of bounded size in the plan: some bits of one array of numbers.
"""

from __future__ import annotations

import json
import math
import re

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bits of a filter at most (one megabyte), and the share of other ids it lets through.
MOST_BITS = 1 << 23
ERROR = 0.01
#: Bytes an id counts for when the staged side's size is held against the broadcast limit.
ID_BYTES = 16


def broadcast_limit(spark: SparkSession) -> int:
    """spark.sql.autoBroadcastJoinThreshold in bytes; -1 where broadcasts are off."""
    text = spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760b").lower()
    number, unit = re.fullmatch(r"(-?\d+)\s*([kmgt]?)i?b?", text.strip()).groups()
    return int(number) * 1024 ** " kmgt".index(unit or " ")


def filter_shape(count: int, error: float, most_bits: int) -> tuple[int, int]:
    """Bits (a power of two) and probes of a filter of ``count`` ids."""
    needed = max(64, math.ceil(-count * math.log(error) / math.log(2) ** 2))
    bits = min(1 << (needed - 1).bit_length(), 1 << (most_bits.bit_length() - 1))
    return bits, max(1, min(8, round(bits / max(count, 1) * math.log(2))))


def probes(value: Column, bits: int, count: int) -> list[Column]:
    """The bits that stand for a value."""
    return [F.xxhash64(value, F.lit(j)).bitwiseAND(F.lit(bits - 1)) for j in range(count)]


def may_be_in(value: Column, words: list[int], bits: int, count: int) -> Column:
    """True if all bits of ``value`` are set; null and false for a null."""
    array = F.from_json(F.lit(json.dumps(words)), "array<bigint>")
    tests = value.isNotNull()
    for place in probes(value, bits, count):
        # The place in a word is in the low six bits, which is all that is read of a shift.
        word = F.get(array, F.shiftright(place, 6).cast("int"))
        tests &= F.getbit(word, place.bitwiseAND(F.lit(63)).cast("int")) == 1
    return tests


def bloom_words(ids: DataFrame, column: str, bits: int, count: int) -> list[int]:
    """The filter's bits as numbers of 64 bits; so many rows, whatever the table's size."""
    place = ids.select(F.explode(F.array(*probes(F.col(column), bits, count))).alias("place"))
    bit = F.expr("shiftleft(1L, cast(place & 63 AS int))")
    words = place.groupBy(F.shiftright("place", 6).alias("word")).agg(F.bit_or(bit).alias("bits")).toArrow()
    made = np.zeros(bits // 64, dtype=np.int64)
    made[words.column("word").to_numpy()] = words.column("bits").to_numpy()
    return made.tolist()


def reduce_by_ids(
    rows: DataFrame,
    column: str,
    ids: DataFrame,
    *,
    error: float = ERROR,
    most_bits: int = MOST_BITS,
) -> DataFrame:
    """``rows`` without most of those whose ``column`` is not in ``ids`` (same column name).

    To be followed by a join or semi join with ``ids``, a staged table. ``rows`` come back as
    they are if ``ids`` are few enough to broadcast, as the join then filters in the scan
    stage by itself, or so many that even the largest filter would let most rows through.
    """
    count = ids.count()
    limit = broadcast_limit(rows.sparkSession)
    if 0 <= count * ID_BYTES <= limit or count > most_bits:
        return rows
    kind = ids.schema[column].dataType
    bits, tries = filter_shape(count, error, most_bits)
    words = bloom_words(ids.where(F.col(column).isNotNull()), column, bits, tries)
    return rows.where(may_be_in(F.col(column).cast(kind), words, bits, tries))
