"""Byte-level BPE through a lexicon of frequent words, and back.

Spark counts the words of all texts; the most frequent ones are encoded once and compiled
into a minimal acyclic transducer (see :mod:`wardlens.llm.transducer`), a file that every
executor gets and its Python workers map into memory, sharing its pages. Texts are split
into the pieces of the tokenizer's pattern; pieces in the lexicon have their ids from there,
all others are merged pair by pair, exactly as the tokenizer would. The lexicon only saves
work: without it ids are the same.

Decoding puts the tokens' bytes together; bytes that are no UTF-8 become replacement
characters, as in the tokenizers library.

Cases: null text is the empty text and has no ids. Special tokens in a text become their
ids, as is the library's default. Equal rows have equal results; null doc_ids are kept. An
empty table gives an empty result and an empty lexicon. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardlens.llm.bpe import merged
from wardlens.llm.chunks import byte_level_memory
from wardlens.llm.common import by_arrow, slices, stage
from wardlens.llm.prefix_counts import byte_letters
from wardlens.llm.transducer import Transducer, compiled

#: Most words of a lexicon; those of the largest counts, ties in or out together.
LEXICON = 1 << 16
#: Classes of counts: so many for each doubling.
CLASSES = 8
#: Letters that any edition of Unicode has as letters, as a class of Arrow's patterns.
SURE = r"A-Za-zÀ-ÖØ-öø-ɏЀ-ҁ"
#: A word behind a blank: what the lexicon has. Longer ones are no words.
FIRST_WORD = rf"^(?P<word>[{SURE}]{{1,40}})(?:[^{SURE}]|$)"
#: A chunk that is one word: a line feed or blank before it, marks behind it.
ONE_WORD = rf"^(?P<feed>\n?)(?P<word> ?[{SURE}]+)(?P<marks>[!-/:-@\[-`{{-~]*)$"
#: Pieces of up to so many bytes are merged together, so many at a time.
SHORT = 32
TOGETHER = 8_000
#: No pair of these tokens merges.
NEVER = 1 << 30


class Tokens:
    """What a byte-level BPE file of the tokenizers library says.

    Tokens and units are kept as strings of the 256 first code points, one for each byte.
    """

    def __init__(self, tokenizer: str):
        import public_tokenizers
        from tokenizers import pre_tokenizers

        with open(public_tokenizers.path(tokenizer), encoding="utf-8") as file:
            made = json.load(file)
        split = made["pre_tokenizer"]
        if made["model"]["type"] != "BPE" or split["type"] != "ByteLevel" or split["add_prefix_space"]:
            raise ValueError(f"{tokenizer} is not a plain byte-level BPE tokenizer")
        if made["normalizer"] is not None or made["model"]["ignore_merges"]:
            raise ValueError(f"{tokenizer} changes texts, or does not merge all words")
        for token in made["added_tokens"]:
            if token["lstrip"] or token["rstrip"] or token["single_word"] or token["normalized"]:
                raise ValueError(f"{token['content']!r} of {tokenizer} is not taken as it is")
        self.split = pre_tokenizers.ByteLevel(add_prefix_space=False)
        letters = byte_letters()
        self.plain = str.maketrans(letters)
        vocabulary = made["model"]["vocab"]
        self.ids = {token.translate(self.plain): i for token, i in vocabulary.items()}
        self.special = {token["content"]: token["id"] for token in made["added_tokens"]}
        self.rank, pairs = {}, []
        for place, pair in enumerate(made["model"]["merges"]):
            left, right = (t.translate(self.plain) for t in (pair if isinstance(pair, list) else pair.split(" ")))
            self.rank[left + right] = place
            pairs.append((self.ids[left] << 32 | self.ids[right], place, self.ids[left + right]))
        pairs.sort()
        # Pairs of tokens in order, their ranks, and what the pair of a rank becomes.
        self.pair, rank, made_of = np.array(pairs, dtype=np.int64).reshape(-1, 3).T.copy()
        self.pair_rank = rank.astype(np.int32)
        self.becomes = np.empty(len(pairs), dtype=np.int32)
        self.becomes[rank] = made_of
        self.unit = np.array([self.ids[chr(byte)] for byte in range(256)], dtype=np.int32)
        count = 1 + max([*vocabulary.values(), *self.special.values()])
        self.bytes = [b""] * count
        for token, i in self.ids.items():
            self.bytes[i] = token.encode("latin-1")
        for token, i in self.special.items():
            self.bytes[i] = token.encode()

    def merge(self, piece: str) -> bytes:
        """The ids of one piece (as bytes' code points), merged pair by pair."""
        ids = [self.ids[part] for part in merged(piece, self.rank.get)]
        return np.array(ids, dtype="<u4").tobytes()

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left.astype(np.int64) << 32 | right
        at = np.minimum(np.searchsorted(self.pair, key), len(self.pair) - 1)
        return np.where(self.pair[at] == key, self.pair_rank[at], np.int32(NEVER))

    def merge_all(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of pieces: one merge of every piece at a time, the long ones alone."""
        done: list[bytes] = [b""] * len(pieces)
        order = sorted((i for i, piece in enumerate(pieces) if piece), key=lambda i: len(pieces[i]))
        while order and len(pieces[order[-1]]) > SHORT:
            i = order.pop()
            done[i] = self.merge(pieces[i].decode("latin-1"))
        for start in range(0, len(order), TOGETHER):
            some = order[start : start + TOGETHER]
            for i, ids in zip(some, self.merge_short([pieces[i] for i in some]), strict=True):
                done[i] = ids
        return done

    def merge_short(self, pieces: list[bytes]) -> list[bytes]:
        most = max(map(len, pieces))
        size = np.array([len(piece) for piece in pieces])
        units = np.frombuffer(b"".join(piece.ljust(most, b"\0") for piece in pieces), dtype=np.uint8)
        tokens = self.unit[units.reshape(-1, most)]
        place = np.arange(most)
        rank = np.full(tokens.shape, NEVER, dtype=np.int32)
        rank[:, :-1] = self.ranks(tokens[:, :-1], tokens[:, 1:])
        rank[place >= size[:, None] - 1] = NEVER
        left = np.arange(len(pieces))
        now, ends = tokens.copy(), size.copy()
        while len(left):
            at = rank.argmin(axis=1)
            least = rank[np.arange(len(at)), at]
            some = least < NEVER
            # What has no pair left is done; the others merge their first pair of least rank.
            tokens[left[~some]], size[left[~some]] = now[~some], ends[~some]
            left, now, ends, rank, at, least = (x[some] for x in (left, now, ends, rank, at, least))
            row = np.arange(len(left))
            shift = np.minimum(place + (place > at[:, None]), most - 1)
            now = np.take_along_axis(now, shift, axis=1)
            now[row, at] = self.becomes[least]
            rank = np.take_along_axis(rank, np.minimum(place + (place >= at[:, None]), most - 1), axis=1)
            ends = ends - 1
            for first in (at - 1, at):
                second = first + 1
                there = (first >= 0) & (second < ends)
                r, a, b = row[there], first[there], second[there]
                rank[r, a] = self.ranks(now[r, a], now[r, b])
            rank[row, ends - 1] = NEVER
        kept = tokens[place < size[:, None]].astype("<u4").tobytes()
        stops = (np.cumsum(size) * 4).tolist()
        return [kept[a:b] for a, b in zip([0, *stops], stops, strict=False)]

    def pieces(self, text: str) -> list[str]:
        """The pieces of a text without special tokens, by the library's own pattern."""
        return [piece.translate(self.plain) for piece, _ in self.split.pre_tokenize_str(text)]


@cache
def _tokens(tokenizer: str) -> Tokens:
    return Tokens(tokenizer)


def frequent_words(docs: DataFrame, *, most: int = LEXICON) -> list[str]:
    """At most ``most`` words of ``docs``, the most frequent ones, by counts over all texts.

    The least count is found from the numbers of words by classes of counts, some hundred
    rows; so only the words themselves come to the driver.
    """
    keep = stage(docs.sparkSession).keep

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in slices(batches):
            counted = pc.split_pattern(texts, " ").flatten().value_counts()
            word = pc.struct_field(pc.extract_regex(counted.field("values"), FIRST_WORD), "word")
            table = pa.table({"word": word, "n": counted.field("counts")})
            yield from table.filter(pc.is_valid(word)).to_batches()

    found = by_arrow(docs.select("text"), work, "word string, n long")
    counts = found.groupBy(F.concat(F.lit(" "), "word").alias("word")).agg(F.sum("n").alias("n"))
    steps = F.floor(F.log2("n") * CLASSES).cast("int")
    counts = keep(counts.where("n > 1").withColumn("step", steps), "word-counts")
    total, least = 0, None
    for row in counts.groupBy("step").count().orderBy(F.col("step").desc()).collect():
        total += row["count"]
        if total > most:
            break
        least = row["step"]
    if least is None:
        return []
    return [row.word for row in counts.where(F.col("step") >= least).select("word").collect()]


def lexicon_file(words: Iterable[str], tokenizer: str) -> bytes:
    """The transducer of words that are one piece of the tokenizer's pattern."""
    tokens = _tokens(tokenizer)
    entries = {}
    for word in words:
        if word in tokens.special or len(parts := tokens.pieces(word)) != 1:
            continue
        entries[parts[0].encode("latin-1")] = np.frombuffer(tokens.merge(parts[0]), dtype="<u4").tolist()
    return compiled(entries.items())


def ship_lexicon(docs: DataFrame, tokenizer: str, most: int) -> str:
    """Compile the lexicon of ``docs`` and give it to all executors; its name there.

    The file lies in the shared folder; executors that come later fetch it, too.
    """
    spark = docs.sparkSession
    made = lexicon_file(frequent_words(docs, most=most), tokenizer)
    name = f"lexicon-{uuid.uuid4().hex}.bin"
    path = f"{stage(spark).folder}/{name}"
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    place = jvm.org.apache.hadoop.fs.Path(path)
    out = place.getFileSystem(conf).create(place)
    out.write(bytearray(made))
    out.close()
    spark.sparkContext.addFile(path)
    return name


@cache
def _coder(tokenizer: str, lexicon: str) -> Coder:
    return Coder(_tokens(tokenizer), Transducer(SparkFiles.get(lexicon)))


@cache
def _decoder(tokenizer: str) -> Decoder:
    return Decoder(_tokens(tokenizer))


class Decoder:
    """Puts the bytes of tokens together."""

    def __init__(self, tokens: Tokens):
        self.values = pa.array(tokens.bytes, pa.binary())
        self.length = np.array([len(b) for b in tokens.bytes], dtype=np.int64)

    def decode(self, ids: np.ndarray, places: np.ndarray) -> Iterator[bytes]:
        """The texts, in UTF-8, of the ids from each of ``places`` to the next."""
        known = (ids >= 0) & (ids < len(self.length))
        if not known.all():
            ids, places = ids[known], np.concatenate([[0], np.cumsum(known)])[places]
        joined = self.values.take(pa.array(ids))
        raw = memoryview(joined.buffers()[2] or b"")
        ends = np.concatenate([[0], np.cumsum(self.length[ids])])[places].tolist()
        for start, stop in zip(ends, ends[1:], strict=False):
            yield bytes(raw[start:stop]).decode("utf-8", "replace").encode()


class Coder:
    """Encodes texts, an Arrow array at a time."""

    def __init__(self, tokens: Tokens, lexicon: Transducer):
        import re

        self.tokens, self.lexicon = tokens, lexicon
        special = map(re.escape, sorted(tokens.special, key=len, reverse=True))
        self.special = re.compile(f"({'|'.join(special) or '(?!)'})")
        self.memory = byte_level_memory(self.work)

    def odd(self, chunks: list[str]) -> list[bytes]:
        """The ids of chunks of any kind, special tokens among them."""
        split, pieces = [], {}
        for chunk in chunks:
            parts: list[str | bytes] = []
            for i, part in enumerate(self.special.split(chunk)):
                if i % 2:
                    parts.append(np.array([self.tokens.special[part]], dtype="<u4").tobytes())
                elif part:
                    parts += self.tokens.pieces(part)
            split.append(parts)
            pieces.update((part, None) for part in parts if isinstance(part, str))
        known = dict(zip(pieces, self.of([piece.encode("latin-1") for piece in pieces]), strict=True))
        return [b"".join(known[part] if isinstance(part, str) else part for part in parts) for parts in split]

    def of(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of pieces: from the lexicon, or merged."""
        found = self.lexicon.look_up(pieces)
        missing = [i for i, ids in enumerate(found) if ids is None]
        for i, ids in zip(missing, self.tokens.merge_all([pieces[i] for i in missing]), strict=True):
            found[i] = ids
        return found

    def work(self, chunks: list[str]) -> list[bytes]:
        """The ids of each chunk; most are one word, with marks behind it as a piece of their own."""
        split = pc.extract_regex(pa.array(chunks, pa.string()), ONE_WORD)
        simple = np.flatnonzero(pc.is_valid(split).to_numpy(zero_copy_only=False))
        split = split.take(pa.array(simple))
        columns = []
        for name in ("feed", "word", "marks"):
            coded = pc.struct_field(split, name).dictionary_encode()
            pieces = [piece.encode() for piece in coded.dictionary.to_pylist()]
            columns.append(pa.array(self.of(pieces), pa.binary()).take(coded.indices))
        made: list[bytes | None] = [None] * len(chunks)
        joined = pc.binary_join_element_wise(*columns, b"").to_pylist() if len(simple) else []
        for i, ids in zip(simple.tolist(), joined, strict=True):
            made[i] = ids
        odd = [i for i, ids in enumerate(made) if ids is None]
        for i, ids in zip(odd, self.odd([chunks[i] for i in odd]), strict=True):
            made[i] = ids
        return made

    def encode(self, texts: pa.StringArray) -> tuple[np.ndarray, memoryview]:
        """Where each text's ids start and end, in bytes, and all ids."""
        return self.memory.join(texts)


def encode_texts(docs: DataFrame, *, tokenizer: str = "byte_bpe_50k.json", most: int = LEXICON) -> DataFrame:
    """doc_id and ids of every document."""
    lexicon = ship_lexicon(docs, tokenizer, most)

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(tokenizer, lexicon)
        for batch, texts in slices(batches):
            places, raw = coder.encode(texts)
            ids = np.frombuffer(raw, dtype="<i4")
            lists = pa.ListArray.from_arrays(pa.array((places // 4).astype(np.int32)), pa.array(ids))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), lists], names=["doc_id", "ids"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return by_arrow(docs.select("doc_id", "text"), work, f"doc_id {kind}, ids array<int>")


def decode_ids(rows: DataFrame, *, tokenizer: str = "byte_bpe_50k.json") -> DataFrame:
    """doc_id and text of every row of doc_id and ids (null: none; unknown ids add nothing)."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            filled = [x or [] for x in batch.column("ids").to_pylist()]
            places = np.cumsum([0, *map(len, filled)])
            ids = np.array([i for x in filled for i in x], dtype=np.int64)
            texts = [raw.decode() for raw in _decoder(tokenizer).decode(ids, places)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    ids = F.transform("ids", lambda i: F.coalesce(i.cast("long"), F.lit(-1)))
    return by_arrow(rows.select("doc_id", ids.alias("ids")), work, f"doc_id {kind}, text string")


def code_report(docs: DataFrame, *, tokenizer: str = "byte_bpe_50k.json", most: int = LEXICON) -> DataFrame:
    """doc_id, n_tokens, and the checksums of the ids and of the text decoded from them."""
    lexicon = ship_lexicon(docs, tokenizer, most)

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, decoder = _coder(tokenizer, lexicon), _decoder(tokenizer)
        for batch, texts in slices(batches):
            places, raw = coder.encode(texts)
            ids = np.frombuffer(raw, dtype="<u4")
            bounds = places.tolist()
            coded = [hashlib.sha256(raw[a:b]).hexdigest() for a, b in zip(bounds, bounds[1:], strict=False)]
            decoded = [hashlib.sha256(text).hexdigest() for text in decoder.decode(ids, places // 4)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.diff(places) // 4), pa.array(coded), pa.array(decoded)],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return by_arrow(docs.select("doc_id", "text"), work, schema)
