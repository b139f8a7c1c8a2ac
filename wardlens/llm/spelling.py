"""Spelling variants by pairs of trie nodes.

Distinct words make two tries, one read forward and one backward. Every node gets a number,
so a word cut at a place is a pair of integers: the node of what stands before and the node
of what stands behind. A pair with one letter skipped and a pair with none, or two pairs
with one letter skipped, are equal exactly if the words are one inserted, deleted or
replaced letter apart: grouping by pairs gives all near words and no others, without
comparing strings.

Nodes up to four letters deep are numbered by their path; words that begin alike so far go
to one task, where they come in order and deeper nodes are counted. A task holds the path of
one word only. Numbers do not depend on tasks. A group has at most one word for each letter
and one without it; each of its words takes from it the number of its partners and the best
of them, so no pair of words is written out.

A word's form is its near word of largest count, if that is large enough beside its own.
Forms only lead to larger counts, so they have ends: the roots, found by doubling steps.

Cases: null and empty texts have no words. Words of any length are taken whole; for them
the work grows with the length, not with its square. Equal words are one word, repeated
rows count again. Ties between near words go to the smallest in code-point order. An empty
table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import os.path
import zlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardlens.llm.common import by_arrow, slices, stage

#: Fixed value: what words are made of, as a class of patterns.
LETTERS = r"[A-Za-zÀ-ÿ]"
#: Letters in the order of their code points; a place in it takes seven bits, 0 is no letter.
ALPHABET = "".join(map(chr, [*range(65, 91), *range(97, 123), *range(192, 256)]))
UPPER = ALPHABET[:26]
BITS = 7
#: Letters of a path that numbers a node, and bits for the nodes below it.
STEM = 4
BELOW = 63 - STEM * BITS
#: The factor by which a form is more frequent.
FORM_TIMES = 5


def _steps() -> np.ndarray:
    """The checksum's register after one byte, by the byte it is mixed with."""
    register = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        register = np.where(register & 1, (register >> 1) ^ np.uint32(0xEDB88320), register >> 1)
    return register


CRC_STEPS = _steps()
LOWERED = np.arange(256, dtype=np.uint8)
LOWERED[65:91] += 32
SMALL = np.zeros(256, dtype=bool)
SMALL[97:123] = True


class Runs:
    """Where the runs of letters of some texts are, in the texts' lower-cased bytes.

    In UTF-8 the letters past z are the byte 0xC3 and one more.
    """

    def __init__(self, texts: pa.StringArray):
        _, offsets, data = texts.buffers()
        cuts = np.frombuffer(offsets, dtype=np.int32)[texts.offset : texts.offset + len(texts) + 1]
        self.bytes = LOWERED[np.frombuffer(data or b"", dtype=np.uint8)[cuts[0] : cuts[-1]]]
        cuts = cuts - cuts[0]
        wide = self.bytes == 0xC3
        inside = SMALL[self.bytes] | wide
        inside[1:] |= wide[:-1]
        first, last = inside.copy(), inside.copy()
        first[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
        # A run ends with its text.
        borders = cuts[(cuts > 0) & (cuts < len(inside))]
        first[borders] = inside[borders]
        last[borders - 1] = inside[borders - 1]
        self.start, self.stop = np.flatnonzero(first), np.flatnonzero(last) + 1
        self.text = np.searchsorted(cuts, self.start, side="right") - 1
        wides = np.concatenate([[0], np.cumsum(wide)])
        self.letters = self.stop - self.start - (wides[self.stop] - wides[self.start])

    def checksums(self, heads: list[bytes]) -> np.ndarray:
        """The checksum of each run behind its text's head, letter by letter for all runs."""
        begun = np.array([zlib.crc32(head) ^ 0xFFFFFFFF for head in heads], dtype=np.uint32)
        order = np.argsort(self.start - self.stop, kind="stable")
        start, size = self.start[order], (self.stop - self.start)[order]
        state = begun[self.text[order]]
        for place in range(int(size[0]) if len(size) else 0):
            n = np.searchsorted(-size, -place)
            state[:n] = CRC_STEPS[(state[:n] ^ self.bytes[start[:n] + place]) & 255] ^ (state[:n] >> 8)
        sums = np.empty(len(order), dtype=np.uint32)
        sums[order] = state ^ np.uint32(0xFFFFFFFF)
        return sums

    def words(self, which: np.ndarray) -> pa.StringArray:
        """The runs with the numbers ``which``."""
        # Runs and what is between them, as one array over the bytes.
        bounds = np.column_stack([self.start, self.stop]).astype(np.int32).reshape(-1)
        if not len(bounds):
            return pa.array([], pa.string())
        parts = pa.StringArray.from_buffers(len(bounds) - 1, pa.py_buffer(bounds), pa.py_buffer(self.bytes))
        return parts.take(pa.array(2 * which))


def count_runs(texts: pa.StringArray, heads: list[bytes], letters: int, every: int) -> pa.Table:
    """word and n: the runs of enough letters, one letter less where the checksum says so."""
    runs = Runs(texts)
    sums = runs.checksums(heads)
    slips = sums % every == 0 if every else np.zeros(len(sums), dtype=bool)
    counted = runs.words(np.flatnonzero(~slips & (runs.letters >= letters))).value_counts()
    found, n = counted.field("values"), counted.field("counts")
    short = []
    slipped = np.flatnonzero(slips)
    for word, h in zip(runs.words(slipped).to_pylist(), sums[slipped].tolist(), strict=True):
        place = h % len(word)
        short.append(word[:place] + word[place + 1 :])
    short = [word for word in short if len(word) >= letters]
    words = pa.concat_arrays([found, pa.array(short, pa.string())])
    return pa.table({"word": words, "n": pa.concat_arrays([n, pa.array([1] * len(short), pa.int64())])})


def word_counts(docs: DataFrame, *, letters: int = 6, least: int = 5, every: int = 0) -> DataFrame:
    """word and n: the runs of enough letters that occur often enough, A-Z lower-cased.

    With ``every``, a run is a letter shorter if the checksum of id and run is a multiple of
    it: slips of the pen, put in at places that only depend on the document.
    """

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches):
            heads = [f"{'' if i is None else i}:".encode() for i in batch.column("id").to_pylist()]
            yield from count_runs(texts, heads, letters, every).to_batches()

    rows = docs.select(F.col("doc_id").cast("string").alias("id"), "text")
    counts = by_arrow(rows, work, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counts.where(F.col("n") >= least)


CODE = {letter: place for place, letter in enumerate(ALPHABET, 1)}


def node_numbers(words: Iterable[str]) -> Iterator[list[int]]:
    """For words in order, the numbers of the nodes on their paths, the root first.

    Words with equal first STEM letters follow each other.
    """
    last, path, count = "", [0], 0
    for word in words:
        shared = len(os.path.commonprefix((last, word)))
        if shared < min(STEM, len(last)) or not last:
            count = 0
        del path[shared + 1 :]
        for place in range(shared, len(word)):
            if place < STEM:
                step = CODE[word[place]] << (BELOW + BITS * (STEM - 1 - place))
                path.append(path[-1] + step)
            else:
                count += 1
                path.append((path[STEM] >> BELOW << BELOW) + count)
        last = word
        yield path


def add_nodes(words: DataFrame, of: str, to: str) -> DataFrame:
    """``words`` with ``to``: the nodes of column ``of`` in the trie of all its values."""
    stem = F.substring(of, 1, STEM)
    dealt = words.repartition(stem).sortWithinPartitions(of)
    names = words.columns

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = iter(batches)
        held: list[pa.RecordBatch] = []

        def texts() -> Iterator[str]:
            for batch in batches:
                held.append(batch)
                yield from batch.column(of).to_pylist()

        made: list[int] = []
        places = [0]

        def done() -> pa.RecordBatch:
            batch = held.pop(0)
            lists = pa.ListArray.from_arrays(pa.array(places, pa.int32()), pa.array(made, pa.int64()))
            return pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), lists], names=[*names, to])

        for path in node_numbers(texts()):
            if len(held) > 1:
                yield done()
                made, places = [], [0]
            made.extend(path)
            places.append(len(made))
        if held:
            yield done()

    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in words.schema]
    return by_arrow(dealt, work, ", ".join([*kinds, f"`{to}` array<long>"]))


def numbered(words: DataFrame, keep: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """word, n, id, letters, heads and tails: the nodes before and behind each place.

    ``id``, the number of the whole word's node, keeps the words' order.
    """
    forward = keep(add_nodes(words.select("word", "n"), "word", "heads"), "forward")
    both = add_nodes(forward.withColumn("back", F.reverse("word")), "back", "ends")
    letters = F.filter(F.split("word", ""), lambda x: x != "")
    return both.select(
        "word", "n", F.element_at("heads", -1).alias("id"), letters.alias("letters"), "heads", F.reverse("ends").alias("tails")
    )


def node_pairs(words: DataFrame) -> DataFrame:
    """head, tail, id, n, whole and last of every place of every word.

    ``whole`` pairs skip no letter. A pair that skips a letter is the ``last`` of its kind if
    the next letter is another one: of equal letters in a row, only one counts as inserted.
    """

    def pair(head: Column, tail: Column, whole: bool, last: Column) -> Column:
        return F.struct(head.alias("head"), tail.alias("tail"), F.lit(whole).alias("whole"), last.alias("last"))

    def uncut(head: Column, i: Column) -> Column:
        return pair(head, F.get("tails", i), True, F.lit(True))

    def skip(letter: Column, i: Column) -> Column:
        last = ~letter.eqNullSafe(F.get("letters", i + 1))
        return pair(F.get("heads", i), F.get("tails", i + 1), False, last)

    both = F.concat(F.transform("heads", uncut), F.transform("letters", skip))
    return words.select("id", "n", F.explode(both).alias("x")).select("id", "n", "x.*")


def near_words(words: DataFrame) -> DataFrame:
    """id, n_near and best (n and negated id) of the words that have near words."""
    entry = F.struct("n", (-F.col("id")).alias("back"), "whole", "last")
    groups = node_pairs(words).groupBy("head", "tail").agg(F.collect_list(entry).alias("all"))
    groups = groups.where(F.size("all") > 1)
    whole = F.filter("all", lambda x: x["whole"])
    groups = groups.withColumns(
        {"whole": whole, "skips": F.array_sort(F.filter("all", lambda x: ~x["whole"]))}
    )
    groups = groups.withColumn("lasts", F.filter("skips", lambda x: x["last"]))
    top, lasts = F.element_at("skips", -1), F.size("lasts")
    none = F.lit(None).cast("struct<n:bigint,back:bigint>")

    def best(x: Column) -> Column:
        return F.struct(x["n"].alias("n"), x["back"].alias("back"))

    def of_skip(x: Column) -> Column:
        # The best of the others that skip a letter, and the word without it.
        second = F.when(F.size("skips") > 1, best(F.get("skips", F.size("skips") - 2))).otherwise(none)
        other = F.when(x["back"] == top["back"], second).otherwise(best(top))
        shorter = F.when(x["last"] & (F.size("whole") > 0), best(F.get("whole", F.lit(0)))).otherwise(none)
        count = F.size("skips") - 1 + shorter.isNotNull().cast("int")
        return F.struct((-x["back"]).alias("id"), count.cast("long").alias("count"), F.greatest(other, shorter).alias("best"))

    def of_whole(x: Column) -> Column:
        longer = F.when(lasts > 0, best(F.element_at("lasts", -1))).otherwise(none)
        return F.struct((-x["back"]).alias("id"), lasts.cast("long").alias("count"), longer.alias("best"))

    each = groups.select(F.explode(F.concat(F.transform("skips", of_skip), F.transform("whole", of_whole))).alias("x"))
    return (
        each.where("x.count > 0")
        .groupBy("x.id")
        .agg(F.sum("x.count").alias("n_near"), F.max("x.best").alias("best"))
    )


def root_ids(forms: DataFrame, keep: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """id and root of every (id, form): where following the forms ends."""
    now = keep(forms.select("id", F.col("form").alias("root")), "roots-0")
    step = 0
    while True:
        step += 1
        ahead = now.select(F.col("id").alias("root"), F.col("root").alias("further"))
        doubled = now.join(ahead, "root", "left").select(
            "id", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")
        )
        doubled = keep(doubled, f"roots-{step}")
        now = doubled.select("id", "root")
        if doubled.where("moved").isEmpty():
            return now


def spelling_variants(counts: DataFrame, *, times: int = FORM_TIMES) -> DataFrame:
    """word, form, root, n, n_near and form_n of every word of ``counts`` (word and n).

    Words have letters of ALPHABET only and are distinct; ``times`` is over 1.
    """
    keep = stage(counts.sparkSession).keep
    words = keep(numbered(keep(counts.select("word", "n"), "counts"), keep), "words")
    near = keep(near_words(words), "near")
    known = words.select("word", "n", "id")
    enough = F.col("best.n") >= times * F.col("n")
    joined = known.join(near, "id", "left").select(
        "id", "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(enough, -F.col("best.back")).alias("form_id"), F.when(enough, F.col("best.n")).alias("form_n"),
    )
    joined = keep(joined, "joined")
    roots = root_ids(joined.where("form_id is not null").select("id", F.col("form_id").alias("form")), keep)

    def named(ids: str, to: str) -> DataFrame:
        return known.select(F.col("id").alias(ids), F.col("word").alias(to))

    return (
        joined.join(roots.select("id", F.col("root").alias("root_id")), "id", "left")
        .join(named("form_id", "form"), "form_id", "left")
        .join(named("root_id", "root"), "root_id", "left")
        .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
    )


def variant_report(docs: DataFrame) -> DataFrame:
    """The spelling variants among the words of documents, slips of the pen put in."""
    return spelling_variants(word_counts(docs, every=199))


#: The query in SQL (DuckDB); the checksum's polynomial is the fixed value 0xEDB88320.
VARIANT_SQL = f"""
WITH RECURSIVE crc_steps AS (
  SELECT list(list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1
           THEN xor(3988292384::BIGINT, c >> 1) ELSE c >> 1 END, i::BIGINT) ORDER BY i) AS steps
  FROM range(256) AS r(i)
), runs AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{UPPER.lower()}'), '{LETTERS}+')) AS run
  FROM documents
), counted AS (
  SELECT doc_id, run, count(*) AS times FROM runs GROUP BY ALL
), summed AS (
  SELECT run, times, xor(4294967295::BIGINT, list_reduce(
      list_transform(regexp_extract_all(hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)), '..'),
        lambda h: ('0x' || h)::BIGINT),
      lambda c, b: xor(c >> 8, steps[1 + (xor(c, b) & 255)]),
      4294967295::BIGINT)) AS h
  FROM counted, crc_steps
), slipped AS (
  SELECT CASE WHEN h % 199 = 0
      THEN substring(run, 1, (h % length(run))::INT) || substring(run, (h % length(run))::INT + 2)
      ELSE run END AS word, times
  FROM summed
), words AS MATERIALIZED (
  SELECT word, sum(times)::BIGINT AS n FROM slipped WHERE length(word) >= 6
  GROUP BY word HAVING sum(times) >= 5
), skips AS MATERIALIZED (
  SELECT word, n, i, substring(word, 1, i - 1) || substring(word, i + 1) AS rest
  FROM (SELECT word, n, unnest(range(1, length(word)::BIGINT + 1)) AS i FROM words)
), near AS (
  SELECT a.word, b.word AS other, b.n AS other_n
  FROM skips a JOIN skips b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT s.word, w.word, w.n FROM skips s JOIN words w ON s.rest = w.word
  UNION SELECT w.word, s.word, s.n FROM skips s JOIN words w ON s.rest = w.word
), best AS (
  SELECT word, other, other_n, count(*) OVER (PARTITION BY word) AS n_near FROM near
  QUALIFY row_number() OVER (PARTITION BY word ORDER BY other_n DESC, other) = 1
), formed AS MATERIALIZED (
  SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near,
    CASE WHEN b.other_n >= {FORM_TIMES} * w.n THEN b.other END AS form,
    CASE WHEN b.other_n >= {FORM_TIMES} * w.n THEN b.other_n END AS form_n
  FROM words w LEFT JOIN best b ON b.word = w.word
), chains AS (
  SELECT word, word AS root, 0 AS step FROM formed
  UNION ALL
  SELECT c.word, f.form, c.step + 1 FROM chains c JOIN formed f ON f.word = c.root WHERE f.form IS NOT NULL
), roots AS (
  SELECT word, arg_max(root, step) AS root FROM chains GROUP BY word
)
SELECT f.word, f.form, r.root, f.n, f.n_near, f.form_n FROM formed f JOIN roots r ON r.word = f.word
"""
