"""Sharding by proportional stratified interleaving.

Rows are shuffled by a seeded hash within each source and ranked; rank over the source's
size is a row's fraction. In the order of the fractions every source is spread evenly, so
equal cuts of that order hold the whole table's mixture, and counts differ by one at most.

Ranks never need a whole source, or the whole table, in one task: a source is cut into
buckets by the leading hash digits and the order of fractions into equal stretches; ranks
within these get the numbers of rows before them added.

Cases: null text has size 1 and the checksum of the empty text; null source is a source of
its own, after the others. Rows are shuffled by the hash of doc_id, checksum and size, so that
documents under one id (or none) are spread; rows equal in all three may swap places. An empty
table gives an empty result. ``shard`` reads no other columns; ``write_shards`` carries them.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardlens.llm.common import free_name, stage

#: Rows that are ranked together, about.
TOGETHER = 50_000


def sizes_of_shards(rows: DataFrame, text: Column) -> DataFrame:
    """``rows`` with size (bytes and one) and text_crc32."""
    return rows.withColumns(
        {
            "size": F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1,
            "text_crc32": F.crc32(F.coalesce(text, F.lit("")).cast("binary")),
        }
    )


def offsets(counts: DataFrame, bucket: str, *group: str) -> DataFrame:
    """Per bucket the rows of the group's earlier buckets; ``counts`` has column n."""
    order = Window.partitionBy(*group).orderBy(bucket) if group else Window.orderBy(bucket)
    before = F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, -1))
    return counts.withColumn("before", F.coalesce(before, F.lit(0)))


def places(docs: DataFrame, seed: str, *carried: str) -> DataFrame:
    """What the order goes by, of every row, and the columns ``carried``."""
    known = sizes_of_shards(docs.select("doc_id", "source", "text", *carried), F.col("text"))
    parts = [F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "text_crc32", "size"]
    return known.select(
        "doc_id",
        F.coalesce(F.col("source"), F.lit("")).alias("name"),
        F.col("source").isNull().alias("unnamed"),
        "size",
        "text_crc32",
        F.md5(F.concat_ws(":", F.lit(seed), *parts)).alias("place"),
        *carried,
    )


def shard(docs: DataFrame, *, shards: int = 8, seed: str = "shards") -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard (null under this law)."""
    keep = stage(docs.sparkSession).keep
    return interleave(places(docs, seed), shards, keep).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def write_shards(docs: DataFrame, path: str, *, shards: int = 8, seed: str = "shards") -> None:
    """Write all rows and columns of ``docs`` as Parquet, a folder per shard (column shard),
    with their slots (column slot) in order in every file.

    Rows are told apart by a serial that is written down with them once; slots are worked out
    from the narrow columns and joined back by serial, a key without heavy values. The names
    get underscores before them where ``docs`` has columns of these names.
    """
    keep = stage(docs.sparkSession).keep
    serial, shard_, slot = (free_name(docs, name) for name in ("serial", "shard", "slot"))
    wide = keep(docs.withColumn(serial, F.monotonically_increasing_id()), "documents")
    placed = interleave(places(wide, seed, serial), shards, keep).select(
        serial, F.col("shard").alias(shard_), F.col("slot").alias(slot)
    )
    whole = wide.join(keep(placed, "placed"), serial).drop(serial)
    ordered = whole.repartitionByRange(shard_, slot).sortWithinPartitions(shard_, slot)
    ordered.write.partitionBy(shard_).parquet(path)


def interleave(narrow: DataFrame, shards: int, keep) -> DataFrame:
    """The rows of :func:`places` with shard and slot."""
    rows = keep(narrow, "rows")
    total = rows.count()
    digits = max(0, math.ceil(math.log(max(total, 1) / TOGETHER, 16)))
    rows = rows.withColumn("bucket", F.substring("place", 1, digits))

    group = ("unnamed", "name")
    counts = rows.groupBy(*group, "bucket").agg(F.count("*").alias("n"))
    ahead = offsets(counts, "bucket", *group).select(
        *group, "bucket", "before", F.sum("n").over(Window.partitionBy(*group)).alias("of")
    )
    within = Window.partitionBy(*group, "bucket").orderBy("place", "text_crc32", "size")
    ranked = rows.join(keep(ahead, "ahead"), [*group, "bucket"]).withColumn(
        "fraction", (F.col("before") + F.row_number().over(within) - 0.5) / F.col("of")
    )
    stretches = max(1, math.ceil(total / TOGETHER))
    ranked = ranked.drop("before", "of").withColumn(
        "stretch", F.floor(F.col("fraction") * stretches)
    )
    ranked = keep(ranked, "ranked")

    counts = ranked.groupBy("stretch").agg(F.count("*").alias("n"))
    ahead = keep(offsets(counts, "stretch").select("stretch", "before"), "stretches")
    within = Window.partitionBy("stretch").orderBy("fraction", *group)
    place = F.col("before") + F.row_number().over(within) - 1
    placed = ranked.join(ahead, "stretch").withColumn("position", place)
    cut = F.expr(f"position * {shards} div {max(total, 1)}")
    first = F.expr(f"(shard * {total} + {shards - 1}) div {shards}")
    return placed.withColumn("shard", cut).withColumns(
        {"slot": F.col("position") - first, "shard": F.col("shard").cast("int")}
    )


#: The same in SQL (DuckDB); the checksum's polynomial is the fixed value 0xEDB88320.
SHARD_SQL = """
WITH crc_steps AS (
  SELECT list(list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1
           THEN xor(3988292384::BIGINT, c >> 1) ELSE c >> 1 END, i::BIGINT) ORDER BY i) AS steps
  FROM range(256) AS r(i)
), sized AS (
  SELECT doc_id, source, strlen(coalesce(text, '')) + 1 AS size,
    CASE WHEN coalesce(text, '') = '' THEN 0 ELSE xor(4294967295::BIGINT, list_reduce(
      list_transform(regexp_extract_all(hex(encode(text)), '..'), lambda h: ('0x' || h)::BIGINT),
      lambda c, b: xor(c >> 8, steps[1 + (xor(c, b) & 255)]),
      4294967295::BIGINT)) END AS text_crc32
  FROM documents, crc_steps
), hashed AS (
  SELECT *, md5('shards:' || coalesce(doc_id::VARCHAR, '') || ':' || text_crc32 || ':' || size) AS place
  FROM sized
), ranked AS (
  SELECT *, (row_number() OVER (PARTITION BY source ORDER BY place, text_crc32, size) - 0.5::DOUBLE)
    / count(*) OVER (PARTITION BY source) AS fraction
  FROM hashed
), placed AS (
  SELECT *, row_number() OVER (ORDER BY fraction, source IS NULL, source) - 1 AS position,
    count(*) OVER () AS total
  FROM ranked
)
SELECT doc_id, size::BIGINT AS size, text_crc32, 'rows' AS law,
  (position * 8 // total)::INTEGER AS shard,
  position - ((position * 8 // total) * total + 7) // 8 AS slot,
  NULL::INTEGER AS grown_shard
FROM placed
"""
