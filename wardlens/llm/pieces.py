"""SentencePiece encoding and decoding by a shared walk over a trie of marked words.

Texts are split into words marked with the model's blank sign. The distinct new words of a
part of the table are sorted, which makes neighbours paths of one trie; the walk goes
through it depth-first and keeps the forward state of each prefix, so what words have in
common is worked out once. The public model is a BPE model: its forward state is the last
piece of the one valid encoding of a prefix (see bpe), where a unigram model would keep the
best score. Reading the states back from the word's end gives the pieces.

Cases: null text is the empty text and has no ids. Blank signs in texts count as blanks, as
in the library. Characters that are no piece become their UTF-8 bytes' pieces. Words behind
several blanks, where equal scores of blank runs matter, are encoded merge by merge.
Repeated rows give repeated rows; only the named columns are read.
"""

from __future__ import annotations

import codecs
import re
from array import array
from collections.abc import Iterable, Iterator, Sequence
from functools import cache, cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardlens.llm.bpe import PrefixBpe
from wardlens.llm.chunks import ChunkMemory
from wardlens.llm.common import by_arrow, slices

#: Fixed value: the sign that stands for a blank.
MARK = "▁"
WORD = re.compile(f"{MARK}+[^{MARK}]*")
#: Text encoded and decoded at once, in bytes (a longer text alone).
CHECKED_BYTES = 2_000_000


def _each_byte(error: UnicodeDecodeError) -> tuple[str, int]:
    return "�" * (error.end - error.start), error.end


codecs.register_error("pieces.each_byte", _each_byte)


@cache
def _coder(model: str) -> PieceCoder:
    return PieceCoder(model)


class PieceCoder:
    """Ids of texts and texts of ids for one BPE model file with byte pieces."""

    def __init__(self, model: str):
        import public_tokenizers
        import sentencepiece

        library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(model))
        ranks: dict[str, float] = {}
        self.bytes_of: list[bytes] = []
        self.byte_ids = [0] * 256
        self.ids: dict[str, int] = {}
        for i in range(library.get_piece_size()):
            piece = library.id_to_piece(i)
            if library.is_byte(i):
                self.byte_ids[int(piece[3:5], 16)] = i
                self.bytes_of.append(bytes([int(piece[3:5], 16)]))
            elif library.is_unknown(i):
                self.bytes_of.append(" ⁇ ".encode())
            elif library.is_control(i):
                self.bytes_of.append(b"")
            else:
                ranks[piece] = -library.get_score(i)
                self.ids[piece] = i
                self.bytes_of.append(piece.replace(MARK, " ").encode())
        if any(MARK in piece.lstrip(MARK) for piece in ranks):
            raise ValueError(f"{model} has pieces that reach over words")
        self.marked = {i for piece, i in self.ids.items() if piece[0] == MARK}
        self.silent = {i for i, value in enumerate(self.bytes_of) if not value}
        self.ranks = ranks
        self.memory = ChunkMemory(
            self.work,
            plain=lambda word: word != "" and MARK not in word,
            chunk=lambda word, head: MARK + word if word else "",
            whole=lambda text: WORD.findall(MARK + text.replace(" ", MARK)) if text else [],
            feeds=False,
        )

    @cached_property
    def bpe(self) -> PrefixBpe:
        """Only workers that encode need it."""
        return PrefixBpe(self.ranks)

    def coded(self, pieces: Sequence[str]) -> bytes:
        found = array("i")
        for piece in pieces:
            number = self.ids.get(piece)
            if number is None:
                found.extend(self.byte_ids[byte] for byte in piece.encode())
            else:
                found.append(number)
        return found.tobytes()

    def work(self, chunks: list[str]) -> Iterator[bytes]:
        """The ids of sorted marked words: a depth-first walk over their trie."""
        forward = self.bpe.forward()
        for chunk in chunks:
            if chunk.startswith(MARK + MARK):
                yield self.coded(self.bpe.encode(chunk))
            elif chunk:
                forward.go(chunk)
                yield self.coded(forward.tokens())
            else:
                yield b""

    def encode(self, texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """Where each text's ids start and end in all ids, and these."""
        places, data = self.memory.join(texts)
        return places // 4, np.frombuffer(data, dtype=np.int32)

    def decode(self, ids: list[int]) -> str:
        if not self.silent.isdisjoint(ids):
            # Bytes on both sides of a control piece are no character.
            runs: list[list[int]] = [[]]
            for i in ids:
                if i in self.silent:
                    runs.append([])
                else:
                    runs[-1].append(i)
            runs = [run for run in runs if run]
        else:
            runs = [ids] if ids else []
        text = "".join(
            b"".join(map(self.bytes_of.__getitem__, run)).decode("utf-8", "pieces.each_byte")
            for run in runs
        )
        return text[1:] if runs and runs[0][0] in self.marked else text


def encode(
    docs: DataFrame,
    *,
    model: str = "piece_bpe_32k.model",
    text: str = "text",
    keep: Sequence[str] = ("doc_id",),
) -> DataFrame:
    """The columns ``keep`` and ``ids``, the pieces of ``text``."""
    kept = docs.select(*keep)
    names = list(keep)

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(model)
        for batch, texts in slices(batches, text):
            yield _with(batch, names, ids=_ids(coder, texts))

    return by_arrow(docs.select(*keep, text), work, f"{_fields(kept)}, ids array<int>")


def decode(
    tokens: DataFrame,
    *,
    model: str = "piece_bpe_32k.model",
    keep: Sequence[str] = ("doc_id", "ids"),
) -> DataFrame:
    """The columns ``keep`` and ``decoded``, the text of ``ids``."""
    kept = tokens.select(*keep)
    names = list(keep)

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(model)
        for batch in _few_rows(batches):
            yield _with(batch, names, decoded=_texts(coder, batch.column("ids")))

    columns = dict.fromkeys([*keep, "ids"])
    return by_arrow(tokens.select(*columns), work, f"{_fields(kept)}, decoded string")


def encode_and_decode(
    docs: DataFrame,
    *,
    model: str = "piece_bpe_32k.model",
    text: str = "text",
    keep: Sequence[str] = ("doc_id",),
) -> DataFrame:
    """The columns ``keep``, ``ids`` and ``decoded``: decode after encode in one task.

    One after the other, the two would be two Python workers a core, with a coder each, and
    the ids would go from one to the other through the JVM.
    """
    kept = docs.select(*keep)
    names = list(keep)

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(model)
        for batch, texts in slices(batches, text, CHECKED_BYTES):
            ids = _ids(coder, texts)
            yield _with(batch, names, ids=ids, decoded=_texts(coder, ids))

    schema = f"{_fields(kept)}, ids array<int>, decoded string"
    return by_arrow(docs.select(*keep, text), work, schema)


def _fields(kept: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema)


def _with(batch: pa.RecordBatch, names: list[str], **made: pa.Array) -> pa.RecordBatch:
    columns = [*(batch.column(name) for name in names), *made.values()]
    return pa.RecordBatch.from_arrays(columns, names=[*names, *made])


def _ids(coder: PieceCoder, texts: pa.StringArray) -> pa.ListArray:
    places, values = coder.encode(texts)
    return pa.ListArray.from_arrays(pa.array(places.astype(np.int32)), pa.array(values))


def _texts(coder: PieceCoder, ids: pa.ListArray) -> pa.StringArray:
    return pa.array([coder.decode(row) for row in _lists(ids)], pa.string())


def _few_rows(batches: Iterable[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, len(batch), rows):
            yield batch.slice(start, rows)
        pa.default_memory_pool().release_unused()


def _lists(column: pa.ListArray) -> Iterator[list[int]]:
    values = column.values.to_numpy(zero_copy_only=False)
    places = column.offsets.to_pylist()
    for start, end in zip(places, places[1:], strict=False):
        yield values[start:end].tolist()


def encode_and_check(docs: DataFrame, *, model: str = "piece_bpe_32k.model") -> DataFrame:
    """doc_id, n_ids, ids, decoded_sha256 and round_trip (decoding gave the text again)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    # A blank sign in a text comes back as a blank, as from the library.
    plain = F.translate(text, MARK, " ")
    hashed = docs.select("doc_id", "text", F.sha2(plain, 256).alias("text_sha256"))
    texts = encode_and_decode(hashed, model=model, keep=("doc_id", "text_sha256"))
    decoded = F.sha2("decoded", 256)
    return texts.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_ids"),
        "ids",
        decoded.alias("decoded_sha256"),
        (decoded == F.col("text_sha256")).alias("round_trip"),
    )
