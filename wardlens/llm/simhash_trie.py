"""SimHash near-duplicates by a self-join of a binary trie of fingerprints.

The distinct fingerprints form a binary trie. Two nodes are followed down together; the
bits in which their paths differ add up, and a pair over the budget is dropped with all
below it. The upper trie, whose nodes hold more fingerprints than a task should, is followed
as a table of node pairs, two bits a step; where both nodes are small enough (``LEAF``), one
task goes on with the pair in memory. A task gives no more links than tie its fingerprints
together, so a group of thousands of near copies never becomes all its pairs. Connected
components over these links follow by rounds of large and small stars.

Cases: null and blank texts have the fingerprint zero and are linked like any other. Null
doc_ids take part; a component's id is its smallest doc_id that is not null (null if there
is none). Repeated rows give repeated rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardlens.llm.common import by_arrow, free_name, ship, slices, stage

#: Most fingerprints of a node that a task follows in memory.
LEAF = 65_536
#: Bits by which the upper trie is followed at a time.
STRIDE = 2
#: Node pairs followed at once in a task; below this many comparisons a pair is compared.
TOGETHER = 100_000
COMPARED = 32
SEED = 42


def fingerprint(text: str, words: int = 3) -> int:
    """The 64-bit SimHash of a text's shingles, repeats included."""
    import xxhash

    found = text.encode().lower().split()
    if not found:
        return 0
    count = max(1, len(found) - words + 1)
    shingles = zip(*(found[i : i + count] for i in range(words)), strict=True) if count > 1 or len(found) == words else [found]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(b" ".join(s), SEED) for s in shingles), dtype="<u8", count=count)
    ones = np.zeros(64, dtype=np.int64)
    for start in range(0, count, 1 << 16):
        part = hashes[start : start + (1 << 16)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > count, bitorder="little")
    return int(bits.view("<u8")[0])


def with_fingerprints(docs: DataFrame, *keep: str, words: int = 3) -> DataFrame:
    """The columns ``keep`` and fp, the fingerprint as a signed number."""
    kept = docs.select(*keep)

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches):
            found = np.array([fingerprint(text, words) for text in texts.to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(name) for name in keep), pa.array(found.view(np.int64))],
                names=[*keep, "fp"],
            )

    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in kept.schema)
    return by_arrow(docs.select(*keep, "text"), work, f"{fields}fp long")


def prefix(fp: Column, depth: int) -> Column:
    """The first ``depth`` bits as a number."""
    return F.shiftrightunsigned(fp, 64 - depth) if depth else F.lit(0).cast("long")


def trie_nodes(prints: DataFrame, total: int, keep) -> tuple[DataFrame, list[int]]:
    """Nodes (depth, path, n) down to leaves of at most LEAF fingerprints, and the depths.

    The first count is made at the depth where leaves are expected; what is above follows
    from it, and heavier nodes are counted deeper. Distinct fingerprints make a node of
    depth 48 a leaf, so this ends.
    """
    depth = 0
    while total >> depth > LEAF:
        depth += STRIDE
    counted = keep(prints.groupBy(prefix(F.col("fp"), depth).alias("path")).agg(F.count("*").alias("n")), f"depth-{depth}")
    levels = {depth: counted}
    for upper in range(depth - STRIDE, -1, -STRIDE):
        below = levels[upper + STRIDE]
        levels[upper] = below.groupBy(F.shiftrightunsigned("path", STRIDE).alias("path")).agg(F.sum("n").alias("n"))
    while True:
        heavy = levels[depth].where(F.col("n") > LEAF).select(F.col("path").alias("above"))
        if heavy.isEmpty():
            break
        depth += STRIDE
        inside = prints.withColumn("above", prefix(F.col("fp"), depth - STRIDE)).join(heavy, "above", "left_semi")
        levels[depth] = keep(
            inside.groupBy(prefix(F.col("fp"), depth).alias("path")).agg(F.count("*").alias("n")), f"depth-{depth}"
        )
    nodes = None
    for at in sorted(levels):
        level = levels[at].select(F.lit(at).alias("depth"), "path", "n")
        if at:
            # Children of leaves are left out.
            inner = nodes.where((F.col("depth") == at - STRIDE) & (F.col("n") > LEAF))
            above = inner.select(F.col("path").alias("above"))
            level = level.withColumn("above", F.shiftrightunsigned("path", STRIDE)).join(above, "above", "left_semi")
            level = level.select("depth", "path", "n")
        nodes = level if nodes is None else nodes.unionByName(level)
    return keep(nodes, "nodes"), sorted(levels)


def leaf_pairs(nodes: DataFrame, depths: list[int], budget: int, keep) -> DataFrame:
    """Pairs of leaves (depth_a, path_a, depth_b, path_b) within the budget so far."""
    a_depth, b_depth = F.col("depth_a"), F.col("depth_b")
    differ = F.bit_count(
        F.expr("shiftrightunsigned(path_a, depth_a - least(depth_a, depth_b))").bitwiseXOR(
            F.expr("shiftrightunsigned(path_b, depth_b - least(depth_a, depth_b))")
        )
    )
    pairs = nodes.where("depth = 0").select(
        F.col("depth").alias("depth_a"), F.col("path").alias("path_a"), (F.col("n") > LEAF).alias("open_a"),
        F.col("depth").alias("depth_b"), F.col("path").alias("path_b"), (F.col("n") > LEAF).alias("open_b"),
    )
    columns = pairs.columns
    for step, depth in enumerate(depths[1:]):
        below = nodes.where(F.col("depth") == depth).select(
            F.shiftrightunsigned("path", STRIDE).alias("above"),
            F.col("path").alias("child"),
            (F.col("n") > LEAF).alias("child_open"),
        )
        same = (a_depth == b_depth) & (F.col("path_a") == F.col("path_b"))
        wide = pairs.withColumn("same", same)
        for side in "ab":
            # A node that is no leaf is followed to its children, a leaf stays.
            stays = wide.where(~F.col(f"open_{side}"))
            goes = (
                wide.where(f"open_{side}")
                .join(below, F.col(f"path_{side}") == F.col("above"))
                .withColumns({f"depth_{side}": F.lit(depth), f"path_{side}": F.col("child"), f"open_{side}": F.col("child_open")})
                .drop("above", "child", "child_open")
            )
            wide = stays.unionByName(goes)
        once = ~F.col("same") | (F.col("path_a") <= F.col("path_b"))
        pairs = keep(wide.where(once & (differ <= budget)).select(columns), f"pairs-{step}")
    return pairs.select("depth_a", "path_a", "depth_b", "path_b")


def follow(a: np.ndarray, b: np.ndarray, same: bool, budget: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of near fingerprints in two sorted arrays: both tries followed together."""
    if not len(a) or not len(b):
        return
    start = [np.array([x]) for x in (0, len(a), 0, len(b))]
    todo = [(63, *start, np.array([0]), np.array([same]))]
    while todo:
        bit, a0, a1, b0, b1, differ, own = todo.pop()
        if len(a0) > TOGETHER:
            todo.extend((bit, *(x[s : s + TOGETHER] for x in (a0, a1, b0, b1, differ, own))) for s in range(0, len(a0), TOGETHER))
            continue
        few = (a1 - a0) * (b1 - b0) <= COMPARED
        if bit < 0:
            few[:] = True
        if few.any():
            yield from compared(a, b, a0[few], a1[few], b0[few], b1[few], own[few], budget)
            rest = ~few
            a0, a1, b0, b1, differ, own = (x[rest] for x in (a0, a1, b0, b1, differ, own))
        if not len(a0):
            continue
        one = np.uint64(1 << bit)
        above = ~np.uint64((1 << (bit + 1)) - 1)
        am = np.clip(np.searchsorted(a, (a[a0] & above) | one), a0, a1)
        bm = np.clip(np.searchsorted(b, (b[b0] & above) | one), b0, b1)
        other = ~own
        children = (
            (a0, am, b0, bm, differ, own),
            (am, a1, bm, b1, differ, own),
            (a0, am, bm, b1, differ + 1, np.zeros_like(own)),
            tuple(x[other] for x in (am, a1, b0, bm, differ + 1, own)),
        )
        joined = [np.concatenate(parts) for parts in zip(*children, strict=True)]
        good = (joined[0] < joined[1]) & (joined[2] < joined[3]) & (joined[4] <= budget)
        if good.any():
            todo.append((bit - 1, *(x[good] for x in joined)))


def compared(a, b, a0, a1, b0, b1, own, budget) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Compare all of each small node pair; about 4 million comparisons at once."""
    wide = b1 - b0
    sizes = (a1 - a0) * wide
    cuts = np.flatnonzero(np.diff(np.cumsum(sizes) // 4_000_000)) + 1
    for part in np.split(np.arange(len(sizes)), cuts):
        if not len(part):
            continue
        size = sizes[part]
        which = np.repeat(part, size)
        place = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        i, j = a0[which] + place // wide[which], b0[which] + place % wide[which]
        near = np.bitwise_count(a[i] ^ b[j]) <= budget
        near &= ~own[which] | (i < j)
        if near.any():
            yield i[near], j[near]


def tie(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Labels after joining places i and j; a label is the smallest place tied to it."""
    while True:
        left, right = label[i], label[j]
        apart = left != right
        if not apart.any():
            return label
        i, j = i[apart], j[apart]
        low, high = np.minimum(left, right)[apart], np.maximum(left, right)[apart]
        np.minimum.at(label, high, low)
        while not np.array_equal(label, label[label]):
            label = label[label]


def links(prints: DataFrame, *, budget: int = 3, keep) -> DataFrame:
    """Links (a, b) that tie all near ones of the distinct fingerprints fp together."""
    total = prints.count()
    nodes, depths = trie_nodes(prints, total, keep)
    pairs = leaf_pairs(nodes, depths, budget, keep).withColumn("pair", F.xxhash64("depth_a", "path_a", "depth_b", "path_b"))
    pairs = keep(pairs, "leaf-pairs")
    leaves = nodes.where(F.col("n") <= LEAF)
    placed = None
    for depth in depths:
        here = leaves.where(F.col("depth") == depth).select("depth", "path")
        part = prints.withColumn("path", prefix(F.col("fp"), depth)).join(here, "path").select("depth", "path", "fp")
        placed = part if placed is None else placed.unionByName(part)
    sides = None
    for side in "ab":
        own = pairs if side == "a" else pairs.where("depth_a <> depth_b or path_a <> path_b")
        own = own.select(F.col(f"depth_{side}").alias("depth"), F.col(f"path_{side}").alias("path"), "depth_a", "path_a", "depth_b", "path_b")
        part = placed.join(own, ["depth", "path"]).select("depth_a", "path_a", "depth_b", "path_b", F.lit(side).alias("side"), "fp")
        sides = part if sides is None else sides.unionByName(part)

    def work(table: pa.Table) -> pa.Table:
        side = np.asarray(table.column("side").to_pylist()) == "a"
        fps = table.column("fp").to_numpy().view(np.uint64)
        a, b = np.sort(fps[side]), np.sort(fps[~side])
        same = not len(b)
        if same:
            b = a
        label = np.arange(len(a) if same else len(a) + len(b))
        shift = 0 if same else len(a)
        for i, j in follow(a, b, same, budget):
            label = tie(label, i, j + shift)
        every = a if same else np.concatenate([a, b])
        tied = np.flatnonzero(label != np.arange(len(label)))
        return pa.table({"a": every[tied].view(np.int64), "b": every[label[tied]].view(np.int64)})

    ship(prints.sparkSession)
    return sides.groupBy("depth_a", "path_a", "depth_b", "path_b").applyInArrow(work, "a long, b long")


def components(edges: DataFrame, keep, rounds: int = 100) -> DataFrame:
    """node and root (the smallest node of its component) for all nodes of the edges.

    Large stars tie a node's larger neighbours to its smallest one, small stars its smaller
    ones; when nothing changes, every node hangs on its root. The smallest neighbours are
    grouped sums joined back, so that a node with very many edges can be split. It is an error
    if something may still change after ``rounds``.
    """
    u, v = F.col("u"), F.col("v")
    now = keep(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "edges-0")
    seen = None
    for step in range(1, rounds + 1):
        both = now.unionByName(now.select(v.alias("u"), u.alias("v")))
        least = keep(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), f"large-{step}")
        large = both.join(least, "u").where(v > u).select(v.alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = keep(large, f"stars-{step}")
        # Every edge now leads from a larger to a smaller node.
        least = keep(large.groupBy("u").agg(F.min("v").alias("m")), f"small-{step}")
        joined = large.join(least, "u")
        small = joined.select(v.alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
        now = keep(small.where("u <> v").distinct(), f"edges-{step}")
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    else:
        raise RuntimeError(f"components still changed in round {rounds}")
    return now.select(u.alias("node"), v.alias("root"))


def near_duplicates(rows: DataFrame, *, budget: int = 3, keep) -> DataFrame:
    """For rows with fp and doc_id: fp and component_id of every distinct fingerprint."""
    prints = keep(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "prints")
    edges = links(prints.select("fp"), budget=budget, keep=keep)
    roots = keep(components(edges, keep), "roots")
    rooted = prints.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    rooted = keep(rooted, "rooted")
    least = keep(rooted.groupBy("root").agg(F.min("first_id").alias("component_id")), "least")
    return keep(rooted.join(least, "root").select("fp", "root", "component_id"), "classes")


def simhash_components(docs: DataFrame, *, words: int = 3, budget: int = 3) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every document."""
    keep = stage(docs.sparkSession).keep
    rows = keep(with_fingerprints(docs, "doc_id", words=words), "fingerprints")
    classes = near_duplicates(rows, budget=budget, keep=keep)
    shown = F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint")
    return rows.join(classes, "fp").select("doc_id", shown, "component_id")


def one_of_each(docs: DataFrame, *, words: int = 3, budget: int = 3) -> DataFrame:
    """One document of each component, with all columns.

    It is the one with the smallest doc_id (null last), then the smallest hash of its text;
    of equal rows one.
    """
    keep = stage(docs.sparkSession).keep
    row, text_hash = free_name(docs, "kept_row"), free_name(docs, "kept_hash")
    # Rows get numbers of their own, so that the texts meet one short column and are not sorted.
    numbered = keep(docs.withColumn(row, F.monotonically_increasing_id()), "documents")
    hashed = F.xxhash64(F.coalesce("text", F.lit(""))).alias(text_hash)
    slim = numbered.select("doc_id", "text", row, hashed)
    rows = keep(with_fingerprints(slim, "doc_id", row, text_hash, words=words), "fingerprints")
    classes = near_duplicates(rows, budget=budget, keep=keep)
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", text_hash, row)
    # Equal rows of a fingerprint are summed up before they meet the classes.
    firsts = rows.groupBy("fp").agg(F.min(order).alias("first"))
    chosen = firsts.join(classes, "fp").groupBy("root").agg(F.min("first").alias("first"))
    chosen = keep(chosen.select(F.col(f"first.{row}").alias(row)), "chosen")
    # Hashed are the numbers, which spread evenly; the texts stream past them.
    kept = numbered.join(chosen.hint("shuffle_hash"), row, "left_semi")
    return kept.select(*(F.col(f"`{c}`") for c in docs.columns))
