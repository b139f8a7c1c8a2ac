"""Token-ID output: ORC files of token ids with metadata that prunes reads.

Documents are dealt to parts by ranges of doc_id and sorted, so every stripe and row index
entry covers a short range of ids; ORC stores the ids run-length encoded, keeps minimum and
maximum of each stripe and row group, and has a Bloom filter on doc_id. Stripes are the
units of parallel reads. A document carries its part's number and the number of ids before
it in the part; the numbers before a part come from one sum per part, however many files
the part has. Ranges go on over a hash of the text, so an id that many rows share is spread
over parts like any others.

Cases: null text has only the end id. Null doc_ids come first. Rows with equal doc_id
follow each other in the order of a hash of their texts; equal rows are in one part. An
empty table gives files without rows.
"""

from __future__ import annotations

import string
import zlib
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wardlens.llm.chunks import byte_level_memory
from wardlens.llm.common import by_arrow, slices

FILE_SCHEMA = "doc_id long, part int, before long, n_tokens long, ids array<int>"
#: Bytes of a stripe; rows between row index entries; false positives of Bloom filters.
STRIPE_BYTES = 16 << 20
INDEX_ROWS = 1000
BLOOM_FALSE = 0.01


@cache
def _encoder(tokenizer: str) -> LibraryEncoder:
    return LibraryEncoder(tokenizer)


class LibraryEncoder:
    """Token ids by the tokenizers library, each distinct chunk of text encoded once.

    Chunks that the byte-level pattern leaves whole go to the library's model as lines of
    one text, already in the letters that stand for bytes; the lengths of the tokens in
    bytes tell them apart again. Other chunks go to the library one by one.
    """

    def __init__(self, tokenizer: str):
        import os

        import public_tokenizers

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.library = Tokenizer.from_file(public_tokenizers.path(tokenizer))
        shown = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        letter = {
            byte: shown.pre_tokenize_str(bytes([byte]).decode("latin-1"))[0][0][-1] for byte in range(128)
        }
        self.feed = self.library.encode("\n", add_special_tokens=False).ids
        self.lines = Tokenizer(self.library.model)
        self.lines.pre_tokenizer = pre_tokenizers.CharDelimiterSplit(letter[10])
        signs = sorted(pre_tokenizers.ByteLevel.alphabet())
        # Bytes that are letters or signs of Latin-1 stand for themselves, the others in order
        # for what comes from U+0100 on.
        own = [sign for sign in signs if ord(sign) < 256]
        rest = iter(sign for sign in signs if ord(sign) >= 256)
        self.letters = np.array([byte if chr(byte) in own else ord(next(rest)) for byte in range(256)], dtype="<u4")
        if any(chr(self.letters[byte]) != sign for byte, sign in letter.items()):
            raise ValueError("the library shows bytes by other letters")
        vocabulary = self.library.get_vocab()
        self.length = np.zeros(max(vocabulary.values()) + 1, dtype=np.int64)
        for token, i in vocabulary.items():
            self.length[i] = len(token)
        self.memory = byte_level_memory(self.work, self.of_plain)

    def work(self, chunks: list[str]) -> list[bytes]:
        """The ids of chunks."""
        return self.of_chunks(pa.array(chunks, pa.string())).to_pylist()

    def of_plain(self, words: pa.StringArray) -> pa.BinaryArray:
        """The ids of words behind blanks; a word with a line feed before it has no blank."""
        blank = pa.array([" ", ""]).take(pc.starts_with(words, "\n").cast(pa.int8()))
        return self.of_chunks(pc.binary_join_element_wise(blank, words, ""))

    def of_chunks(self, given: pa.StringArray) -> pa.BinaryArray:
        """The ids of chunks; words and the marks behind them are pieces of their own."""
        fed = pc.starts_with(given, "\n")
        bare = pc.if_else(fed, pc.utf8_slice_codeunits(given, 1), given)
        core = pc.utf8_rtrim(bare, string.punctuation)
        letters = pc.if_else(pc.starts_with(core, " "), pc.utf8_slice_codeunits(core, 1), core)
        worded = pc.utf8_is_alpha(letters).to_numpy(zero_copy_only=False)
        words, others = np.flatnonzero(worded), np.flatnonzero(~worded)
        cores = core.take(pa.array(words)).dictionary_encode()
        # Marks are of one byte each.
        behind = pc.subtract(pc.binary_length(bare), pc.binary_length(core)).to_numpy()[words]
        marked = np.flatnonzero(behind)
        marks = _tails(bare.take(pa.array(words[marked])), behind[marked]).dictionary_encode()
        known = pa.array([b"", *self.one_by_one(marks.dictionary.to_pylist())], pa.binary())
        place = np.zeros(len(words), dtype=np.int64)
        place[marked] = marks.indices.to_numpy() + 1
        feed = pa.array([b"", np.array(self.feed, dtype="<u4").tobytes()], pa.binary())
        heads = fed.to_numpy(zero_copy_only=False)[words].astype(np.int64)
        parts = (feed.take(pa.array(heads)), self.of_words(cores.dictionary).take(cores.indices), known.take(pa.array(place)))
        rest = pa.array(self.one_by_one(given.take(pa.array(others)).to_pylist()), pa.binary())
        order = np.empty(len(given), dtype=np.int64)
        order[words], order[others] = np.arange(len(words)), len(words) + np.arange(len(others))
        coded = pa.concat_arrays([pc.binary_join_element_wise(*parts, b""), rest])
        return coded.take(pa.array(order))

    def of_words(self, words: pa.StringArray) -> pa.BinaryArray:
        """The ids of words, with or without a blank before them: lines of one text."""
        if not len(words):
            return pa.array([], pa.binary())
        raw = np.frombuffer("\n".join(words.to_pylist()).encode(), dtype=np.uint8)
        shown = self.letters[raw].tobytes().decode("utf-32-le")
        coded = self.lines.encode_batch_fast([shown], add_special_tokens=False)
        ids = np.array(coded[0].ids, dtype="<u4")
        # The line feeds are gone; a word's ids end where its bytes do.
        reached, sought = np.cumsum(self.length[ids]), np.cumsum(pc.binary_length(words).to_numpy())
        last = np.searchsorted(reached, sought)
        if reached[-1] != sought[-1] or (reached[last] != sought).any():
            raise ValueError("the tokenizer joins line feeds with other text")
        ends = np.concatenate([[0], (last + 1) * 4]).astype(np.int32)
        return pa.BinaryArray.from_buffers(pa.binary(), len(words), [None, pa.py_buffer(ends), pa.py_buffer(ids.tobytes())])

    def one_by_one(self, chunks: list[str]) -> Iterator[bytes]:
        # Not joined: what stands at the end of a text is not split as inside it.
        for start in range(0, len(chunks), 10_000):
            part = chunks[start : start + 10_000]
            for code in self.library.encode_batch_fast(part, add_special_tokens=False):
                yield np.array(code.ids, dtype="<u4").tobytes()

    def encode(self, texts: pa.StringArray, end: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Where each text's ids start and end in all ids; ``end`` follows each text."""
        places, data = self.memory.join(texts, before=end)
        ids = np.frombuffer(bytes(data) + end, dtype="<i4")[1:] if len(texts) else np.array([], "<i4")
        return places // 4, ids


def _tails(words: pa.StringArray, sizes: np.ndarray) -> pa.StringArray:
    """The last bytes of words, so many as ``sizes`` says (whole characters)."""
    if not len(words):
        return pa.array([], pa.string())
    stops = np.frombuffer(words.buffers()[1], dtype=np.int32)[words.offset + 1 : words.offset + len(words) + 1]
    ends = np.cumsum(sizes, dtype=np.int64)
    at = np.arange(ends[-1]) + np.repeat(stops - ends, sizes)
    data = np.frombuffer(words.buffers()[2], dtype=np.uint8)[at]
    places = np.concatenate([[0], ends]).astype(np.int32)
    return pa.StringArray.from_buffers(len(words), pa.py_buffer(places), pa.py_buffer(data.tobytes()))


def write_token_files(
    docs: DataFrame,
    path: str,
    *,
    tokenizer: str = "byte_bpe_50k.json",
    end_id: int = 2,
    files: int | None = None,
) -> None:
    """Write doc_id, before, n_tokens and ids as ORC files in ascending doc_id order."""
    order = ["doc_id", "text_hash"]
    named = docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"), "text")
    ranged = named.repartitionByRange(*order) if files is None else named.repartitionByRange(files, *order)
    end = np.array([end_id], dtype="<u4").tobytes()

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer)
        before, part = 0, TaskContext.get().partitionId()
        for batch, texts in slices(batches):
            places, ids = encoder.encode(texts, end)
            sizes = np.diff(places)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").cast(pa.int64()),
                    pa.array(np.full(len(sizes), part, dtype=np.int32)),
                    pa.array(before + places[:-1]),
                    pa.array(sizes),
                    pa.ListArray.from_arrays(pa.array(places.astype(np.int32)), pa.array(ids)),
                ],
                names=["doc_id", "part", "before", "n_tokens", "ids"],
            )
            before += int(places[-1])

    by_arrow(ranged.sortWithinPartitions(*order, "text"), work, FILE_SCHEMA).write.options(
        **{
            "orc.stripe.size": STRIPE_BYTES,
            "orc.row.index.stride": INDEX_ROWS,
            "orc.bloom.filter.columns": "doc_id",
            "orc.bloom.filter.fpp": BLOOM_FALSE,
            "compression": "zstd",
        }
    ).orc(path)


def token_rows(spark: SparkSession, path: str) -> DataFrame:
    """The rows of the files."""
    return spark.read.schema(FILE_SCHEMA).orc(path)


def with_starts(rows: DataFrame, written: DataFrame) -> DataFrame:
    """``rows`` (of any columns of token_rows) with start, the ids of all documents before.

    ``written`` are the token rows all of ``rows`` come from. One row a part is summed up;
    parts are numbered in the order of doc_id.
    """
    totals = written.groupBy("part").agg(F.sum("n_tokens").alias("tokens"))
    ahead = F.sum("tokens").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    starts = totals.select("part", F.coalesce(ahead, F.lit(0)).alias("ahead"))
    start = (F.col("ahead") + F.col("before")).alias("start")
    others = [name for name in rows.columns if name not in ("doc_id", "before", "part")]
    return rows.join(starts, "part").select("doc_id", start, *others)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids, ``start`` being the ids of all documents before."""
    rows = token_rows(spark, path)
    return with_starts(rows, rows)


def documents_by_id(spark: SparkSession, path: str, ids: list[int]) -> DataFrame:
    """The rows of some documents; statistics and Bloom filters skip other stripes."""
    return spark.read.schema(FILE_SCHEMA).orc(path).where(F.col("doc_id").isin(ids))


def id_checksums(rows: DataFrame) -> DataFrame:
    """Token rows with ids_crc32 in the place of their ids.

    The checksum is over the ids as little-endian unsigned 32-bit numbers.
    """
    names = ["doc_id", "part", "before", "n_tokens"]

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("ids")
            raw = memoryview(lists.values.to_numpy(zero_copy_only=False).astype("<i4").tobytes())
            places = (lists.offsets.to_numpy() * 4).tolist()
            sums = [zlib.crc32(raw[a:b]) for a, b in zip(places, places[1:], strict=False)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(name) for name in names), pa.array(sums, pa.int64())],
                names=[*names, "ids_crc32"],
            )

    schema = "doc_id long, part int, before long, n_tokens long, ids_crc32 long"
    return by_arrow(rows.select(*names, "ids"), work, schema)


def checked_tokens(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32, all from the files.

    Checksums take the place of the ids before rows meet what stands before their part.
    """
    rows = token_rows(spark, path)
    return with_starts(id_checksums(rows), rows)
