"""Mixing sources to target weights by entropy balancing.

Each source is to give a target number of words. Among all document rates that do, entropy
balancing takes the ones nearest to one copy of each document: exp(tilt * size / mean size),
at most the cap, with one tilt per source. The tilts solve the convex dual; Newton steps
(kept inside a bracket) find all of them together, each step one sum over the cells. A cell
is all documents of one source and size: they have one rate, so cells are all the sums need.

Rates become copies by rounding the running sum of rates over the sizes of a source, and the
few words still missing or too many are evened out with the smallest documents. In a cell
whose copies do not divide evenly, the documents with the smallest seeded hashes get one
more; that border is found in one narrow bucket of hashes, so a cell of any size is split.

Cases: null text has no words; documents without words have rate 1 and give one copy of
nothing. Null source is a source of its own, the last. Rows with equal doc_id, source and
text have equal hashes; where the border falls among them, as many as are missing get one
more, no matter which. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardlens.llm.common import BLANKS, free_name, stage

#: Documents whose hashes are ordered together, about.
TOGETHER = 50_000
#: Newton ends when no source's words are off by more than this share, or after STEPS.
CLOSE = 1e-4
STEPS = 60
#: Bounds of a tilt that are no further apart have met.
FINEST = 2e-9


def word_count(text: Column) -> Column:
    words = F.regexp_count(text, F.lit(BLANKS.replace("[", "[^", 1) + "+"))
    return F.coalesce(words, F.lit(0)).cast("long")


def source_targets(
    sources: DataFrame, *, weights: Sequence[int], total: float, most: float
) -> DataFrame:
    """Targets of sources (columns unnamed, name, source_size; one row each).

    ``weights`` go round over the sources by code point, unnamed last. Together they are to
    give ``total`` times all words, none more than ``most`` times its own. In the order of
    their limits per weight, sources stop at their limit as long as that is under the level
    the later ones share.
    """
    by_name = Window.orderBy("unnamed", "name")
    cycle = F.array(*map(F.lit, weights))
    weighed = sources.withColumn(
        "weight", F.get(cycle, (F.row_number().over(by_name) - 1) % len(weights))
    )
    by_limit = Window.orderBy(F.col("source_size") / F.col("weight"), "unnamed", "name")
    everything = Window.partitionBy()
    limit = F.col("source_size") * F.lit(float(most))
    words = F.sum("source_size").over(everything) * F.lit(float(total))
    earlier = by_limit.rowsBetween(Window.unboundedPreceding, -1)
    left = words - F.coalesce(F.sum(limit).over(earlier), F.lit(0.0))
    later = F.sum("weight").over(by_limit.rowsBetween(0, Window.unboundedFollowing))
    levels = weighed.withColumns({"limit": limit, "level": left / later})
    stops = F.col("limit") <= F.col("weight") * F.col("level")
    # The first source that does not stop sets the level.
    levels = levels.withColumn("stops", stops)
    level = F.min(F.when(~F.col("stops"), F.struct(F.col("source_size") / F.col("weight"), "unnamed", "name", "level"))).over(everything)["level"]
    shared = F.col("weight") * level
    return levels.withColumn(
        "target", F.when(shared.isNull(), F.col("limit")).otherwise(F.least("limit", shared))
    ).select("unnamed", "name", "source_size", "target")


def tilts(cells: DataFrame, targets: DataFrame, most: float, keep) -> DataFrame:
    """``targets`` with tilt (null: every document at the cap) and mean size.

    It is an error if a tilt is neither close nor settled after STEPS.
    """
    group = ["unnamed", "name"]
    means = cells.groupBy(*group).agg((F.sum(F.col("n") * F.col("size")) / F.sum("n")).alias("mean"))
    ratio = F.col("target") / F.col("source_size")
    none = F.lit(None).cast("double")
    now = targets.join(means, group).select(
        *group,
        "target",
        "mean",
        F.when(ratio < most * (1 - 1e-9), F.log(F.greatest(ratio, F.lit(1e-9)))).alias("tilt"),
        none.alias("low"),
        none.alias("high"),
        F.lit(1.0).alias("off"),
    )
    now = keep(now, "tilts-0")
    cap = F.lit(float(most))
    for step in range(1, STEPS + 1):
        x = F.col("size") / F.col("mean")
        rate = F.exp(F.col("tilt") * x)
        words = F.col("n") * F.col("size")
        sums = (
            cells.join(now, group)
            .groupBy(*group, "target", "mean", "tilt", "low", "high")
            .agg(
                F.sum(words * F.least(cap, rate)).alias("words"),
                F.sum(F.when(rate < cap, words * x * rate).otherwise(0.0)).alias("slope"),
            )
        )
        gap = F.col("words") - F.col("target")
        low = F.when(gap <= 0, F.col("tilt")).otherwise(F.col("low"))
        high = F.when(gap >= 0, F.col("tilt")).otherwise(F.col("high"))
        newton = F.col("tilt") - gap / F.greatest(F.col("slope"), F.lit(1e-300))
        reach = F.greatest(F.lit(1.0), F.abs("tilt"))
        free = F.least(F.greatest(newton, F.col("tilt") - reach), F.col("tilt") + reach)
        middle = (F.col("low") + F.col("high")) / 2
        inside = (newton > F.col("low")) & (newton < F.col("high"))
        off = F.coalesce(F.abs(gap) / F.greatest("target", F.lit(1.0)), F.lit(0.0))
        new = F.when(F.col("low").isNull() | F.col("high").isNull(), free).otherwise(
            F.when(inside, newton).otherwise(middle)
        )
        stepped = (
            sums.withColumns({"low": low, "high": high, "off": off})
            # Sums may differ in the last places from run to run; rounded tilts do not.
            .withColumn("tilt", F.when(F.col("off") <= CLOSE, F.col("tilt")).otherwise(F.round(new, 9)))
            .select(*group, "target", "mean", "tilt", "low", "high", "off")
        )
        now = keep(stepped, f"tilts-{step}")
        worst = now.agg(F.max("off")).first()[0]
        if worst is None or worst <= CLOSE:
            break
    else:
        # Tilts are rounded: where the bounds meet, no closer one is to be had.
        open_ones = (F.col("off") > CLOSE) & F.coalesce(F.col("high") - F.col("low") > FINEST, F.lit(True))
        if not now.where(open_ones).isEmpty():
            raise RuntimeError(f"tilts still changed in step {STEPS}")
    return now


def cell_copies(cells: DataFrame, tilted: DataFrame, most: int) -> DataFrame:
    """Copies of each cell: rounded running sums, then evened out from the smallest."""
    group = ["unnamed", "name"]
    by_size = Window.partitionBy(*group).orderBy("size")
    so_far = by_size.rowsBetween(Window.unboundedPreceding, 0)
    before = by_size.rowsBetween(Window.unboundedPreceding, -1)
    source = Window.partitionBy(*group)
    rate = F.coalesce(
        F.least(F.lit(float(most)), F.exp(F.col("tilt") * F.col("size") / F.col("mean"))),
        F.lit(float(most)),
    )
    room = F.col("n") * most
    rounded = cells.join(tilted, group).withColumn("rates", F.sum(F.col("n") * rate).over(so_far))
    rounded = rounded.withColumn("upto", F.floor(F.col("rates") + 0.5)).withColumn(
        "copies",
        F.least(room, F.greatest(F.lit(0), F.col("upto") - F.coalesce(F.lag("upto").over(by_size), F.lit(0)))),
    )
    gap = F.col("target") - F.sum(F.col("copies") * F.col("size")).over(source)
    moved = rounded.withColumn("gap", gap).withColumn(
        "movable", F.when(F.col("gap") > 0, room - F.col("copies")).otherwise(F.col("copies"))
    )
    used = F.coalesce(F.sum(F.col("movable") * F.col("size")).over(before), F.lit(0))
    fits = F.floor((F.abs("gap") - used) / F.col("size"))
    moves = F.least(F.col("movable"), F.greatest(F.lit(0), fits))
    return (
        moved.withColumn("moves", moves)
        .withColumn("copies", F.col("copies") + F.signum("gap").cast("long") * F.col("moves"))
        .select(
            *group,
            "size",
            "n",
            F.expr("copies div n").alias("each"),
            (F.col("copies") % F.col("n")).alias("extra"),
        )
    )


def hash_borders(rows: DataFrame, cells: DataFrame, keep) -> DataFrame:
    """``cells`` with border, edge and missing, for cells with extra copies.

    Documents with hashes up to ``border`` get one more copy. Of those with hash ``edge``
    (null unless equal rows straddle the border), only ``missing`` do.
    """
    cell = ["unnamed", "name", "size"]
    split = cells.where("extra > 0")
    largest = split.agg(F.max("n")).first()[0] or 1
    bits = max(0, math.ceil(math.log2(largest / TOGETHER)))
    bucketed = rows.withColumn("bucket", F.shiftright("place", 63 - bits) if bits else F.lit(0).cast("long"))
    counts = bucketed.join(split.select(*cell, "extra"), cell).groupBy(*cell, "extra", "bucket").agg(
        F.count("*").alias("of")
    )
    order = Window.partitionBy(*cell).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("of").over(order), F.lit(0))
    chosen = counts.withColumn("nth", F.col("extra") - before).where("nth between 1 and of")
    chosen = keep(chosen.select(*cell, "bucket", "nth"), "chosen")
    # Equal rows have one hash: however many there are, they are one row before they are ordered.
    places = bucketed.join(chosen, [*cell, "bucket"]).groupBy(*cell, "nth", "place").agg(
        F.count("*").alias("here")
    )
    order = Window.partitionBy(*cell).orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    counted = places.withColumn("upto", F.sum("here").over(order))
    whole = F.col("upto") == F.col("nth")
    borders = counted.where("upto >= nth and upto - here < nth").select(
        *cell,
        F.when(whole, F.col("place")).otherwise(F.col("place") - 1).alias("border"),
        F.when(~whole, F.col("place")).alias("edge"),
        F.when(~whole, F.col("nth") - F.col("upto") + F.col("here")).alias("missing"),
    )
    return cells.join(borders, cell, "left").select(*cell, "each", "border", "edge", "missing")


def first_rows(rows: DataFrame, cell: Sequence[str], missing: str, serial: str, keep) -> DataFrame:
    """Per cell the ``serial`` of its ``missing``-th row, in the order of serials.

    The high bits of a serial are the task that gave it. Rows are counted per task first, and
    only those of the one task the wanted row is from are put in order.
    """
    narrow = rows.select(*cell, F.col(missing).alias("nth"), F.col(serial).alias("serial"))
    narrow = narrow.withColumn("task", F.shiftright("serial", 33))
    counts = narrow.groupBy(*cell, "nth", "task").agg(F.count("*").alias("of"))
    order = Window.partitionBy(*cell).orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    left = F.col("nth") - F.coalesce(F.sum("of").over(order), F.lit(0))
    chosen = counts.withColumn("nth", left).where("nth between 1 and of").drop("of")
    chosen = keep(chosen, "edge-tasks")
    rank = F.row_number().over(Window.partitionBy(*cell).orderBy("serial"))
    ranked = narrow.drop("nth").join(chosen, [*cell, "task"]).withColumn("rank", rank)
    return ranked.where("rank = nth").select(*cell, F.col("serial").alias("last"))


def mix_columns(seed: int) -> dict[str, Column]:
    """What the mix needs of a document: its source, words and seeded hash."""
    spread = F.xxhash64(F.lit(seed), "doc_id", "source", "text")
    return {
        "name": F.coalesce(F.col("source"), F.lit("")),
        "unnamed": F.col("source").isNull(),
        "size": word_count(F.col("text")),
        "place": spread.bitwiseAND(F.lit((1 << 63) - 1)),
    }


def plan_mix(
    rows: DataFrame,
    *,
    weights: Sequence[int] = (3, 1, 2),
    total: float = 1.5,
    most: int = 2,
    keep,
) -> tuple[DataFrame, DataFrame]:
    """The copies of every cell (each, border), and the sources' sizes and targets."""
    cells = keep(rows.groupBy("unnamed", "name", "size").agg(F.count("*").alias("n")), "cells")
    sources = cells.groupBy("unnamed", "name").agg(
        F.sum(F.col("n") * F.col("size")).alias("source_size")
    )
    targets = keep(source_targets(sources, weights=weights, total=total, most=most), "targets")
    worded = cells.where("size > 0")
    tilted = tilts(worded, targets, most, keep)
    copies = keep(cell_copies(worded, tilted, most), "copies")
    return keep(hash_borders(rows, copies, keep), "plan"), targets


def with_copies(planned: DataFrame, names: dict[str, str], keep) -> DataFrame:
    """Documents joined with their cells' plans (columns as ``names`` says), with copies.

    Documents without words have one. Rows at an edge are equal to each other, so any of them
    may get the copies missing; they alone are written down with a serial, and a table without
    edges is not read for them.
    """
    cell = [names[k] for k in ("unnamed", "name", "size")]
    each, place, border, edge, missing = (
        F.col(names[k]) for k in ("each", "place", "border", "edge", "missing")
    )
    copies, serial = names["copies"], names["serial"]
    extra = F.coalesce(place <= border, F.lit(False)).cast("long")
    plain = planned.withColumn(copies, F.coalesce(each + extra, F.lit(1).cast("long")))
    at_edge = F.coalesce(place == edge, F.lit(False))
    equal = planned.where(at_edge).withColumn(serial, F.monotonically_increasing_id())
    equal = keep(equal, "edges")
    if equal.isEmpty():
        return plain
    last = keep(first_rows(equal, cell, names["missing"], serial, keep), "last-of-edges")
    more = equal.join(last.withColumnRenamed("last", names["last"]), cell).withColumn(
        copies, each + (F.col(serial) <= F.col(names["last"])).cast("long")
    )
    return plain.where(~at_edge).unionByName(more.select(*plain.columns))


CELL = ("unnamed", "name", "size")
PLAN = ("each", "border", "edge", "missing")
WORKED = ("copies", "serial", "last")


def mix_report(docs: DataFrame, *, seed: int = 7, **settings) -> DataFrame:
    """doc_id, size, source_size, target and taken (words of the copies) per document."""
    keep = stage(docs.sparkSession).keep
    rows = keep(docs.select("doc_id", *(c.alias(k) for k, c in mix_columns(seed).items())), "rows")
    plan, targets = plan_mix(rows, keep=keep, **settings)
    planned = rows.join(plan, list(CELL), "left")
    names = {k: k for k in (*CELL, "place", *PLAN, *WORKED)}
    copied = with_copies(planned, names, keep).join(targets, ["unnamed", "name"])
    return copied.select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("copies") * F.col("size")).alias("taken"),
        "copies",
    )


def mix(docs: DataFrame, *, seed: int = 7, **settings) -> DataFrame:
    """The documents, each as often as the mix takes it, with their own columns."""
    keep = stage(docs.sparkSession).keep
    columns = mix_columns(seed)
    rows = keep(docs.select(*(c.alias(k) for k, c in columns.items())), "rows")
    plan, _ = plan_mix(rows, keep=keep, **settings)
    names = {k: free_name(docs, f"mix_{k}") for k in (*columns, *PLAN, *WORKED, "times")}
    plan = plan.select(*(F.col(k).alias(names[k]) for k in (*CELL, *PLAN)))
    wide = docs.withColumns({names[k]: c for k, c in columns.items()})
    joined = wide.join(plan, [names[k] for k in CELL], "left")
    copied = with_copies(joined, names, keep)
    upto = F.sequence(F.lit(0).cast("long"), F.col(names["copies"]))
    times = names["times"]
    repeated = copied.withColumn(times, F.explode(upto))
    return repeated.where(F.col(times) > 0).select(*(F.col(f"`{c}`") for c in docs.columns))
