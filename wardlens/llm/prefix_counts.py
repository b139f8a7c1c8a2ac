"""Token counts: the exact number of tokens of every prefix of a text.

Prefix dynamic programming (see bpe) gives for each chunk of a text the number of tokens at
each of its characters. What is stored is the step of that number from one character to
the next, so the running sum at n is the number of tokens of
the first n characters as the library encodes them by themselves. Truncation ("how many
tokens has the first part?") and budget ("how much text fits in so many tokens?") are
answered from the store.

Cases: null text is the empty text (no changes, 0 tokens). Repeated rows give repeated rows.
The special token's text inside a text is the special token, as the library has it; a prefix
that cuts through it counts what the cut text gives.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardlens.llm.bpe import ManyForward, PrefixBpe
from wardlens.llm.chunks import byte_level_memory
from wardlens.llm.common import by_arrow, slices

#: The widths of a step in bytes. One byte is enough for all but very odd texts.
WIDTHS = {1: np.int8, 2: np.int16, 4: np.int32}
#: Pieces of up to so many bytes are worked on together, so many at a time.
SHORT = 64
TOGETHER = 50_000


@cache
def _coder(tokenizer: str) -> Coder:
    return Coder(tokenizer)


class Coder:
    """Steps of the token count along texts, for one tokenizer file."""

    def __init__(self, tokenizer: str):
        import json

        import public_tokenizers

        with open(public_tokenizers.path(tokenizer), encoding="utf-8") as file:
            made = json.load(file)
        if made["model"]["type"] != "BPE" or made["pre_tokenizer"]["type"] != "ByteLevel":
            raise ValueError(f"{tokenizer} is not a byte-level BPE tokenizer")
        plain = byte_letters()
        order = {}
        for place, pair in enumerate(made["model"]["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            order["".join(plain[c] for c in left + right)] = place
        units = {"".join(plain[c] for c in t): -1 for t in made["model"]["vocab"] if len(t) == 1}
        self.bpe = PrefixBpe(units | order)
        self.many = ManyForward(self.bpe)
        self.pattern = regex.compile(public_tokenizers.PATTERN)
        self.space = regex.compile(r"\s")
        self.wide_space = regex.compile(r"\s\s")
        special = [regex.escape(t["content"]) for t in made["added_tokens"]]
        self.special_text = regex.compile("|".join(special) or "(?!)")
        self.memory = byte_level_memory(self.steps)

    def steps(self, chunks: list[str]) -> Iterator[bytes | None]:
        """For each chunk, the steps of the count at its characters."""
        pieces: dict[str, bytes | None] = {}
        split: list[tuple[str, ...] | None] = []
        for chunk in chunks:
            if (chunk[1:] if chunk[0] == " " else chunk).isalpha():
                parts = (chunk,)
            elif self.special_text.search(chunk) or self.wide_space.search(chunk):
                parts = None
            else:
                parts = self.pattern.findall(chunk)
            split.append(parts)
            if parts:
                pieces.update(dict.fromkeys(parts))
        self.fill(pieces)
        for chunk, parts in zip(chunks, split, strict=True):
            if parts is None:
                yield packed(self.counts(chunk), 1)
            elif len(parts) == 1:
                yield pieces[parts[0]]
            else:
                found = [pieces[part] for part in parts]
                yield None if None in found else b"".join(found)

    def fill(self, pieces: dict[str, bytes | None]) -> None:
        """Set the steps of each piece of the pattern."""
        coded = [(piece.encode(), piece) for piece in pieces]
        short = [
            pair for pair in coded if len(pair[0]) <= SHORT and (pair[1][0] != "'" or len(pair[1]) == 1)
        ]
        short.sort(key=lambda pair: -len(pair[0]))
        for start in range(0, len(short), TOGETHER):
            some = short[start : start + TOGETHER]
            lengths = np.array([len(units) for units, _ in some])
            most = int(lengths[0])
            units = np.frombuffer(b"".join(u.ljust(most, b"\0") for u, _ in some), dtype=np.uint8)
            units = units.reshape(len(some), most)
            counts = self.many.counts(lengths, np.ascontiguousarray(units.T))[1:].T
            ends = np.arange(most) < lengths[:, None]
            ends[:, :-1] &= ((units[:, 1:] & 0xC0) != 0x80) | ~ends[:, 1:]
            at_ends = counts[ends]
            sizes = ends.sum(axis=1)
            stops = np.cumsum(sizes)
            steps = np.diff(at_ends, prepend=0)
            steps[stops - sizes] = at_ends[stops - sizes]
            buffer = steps.astype(np.int8).tobytes()
            for (_, piece), stop, size in zip(some, stops.tolist(), sizes.tolist(), strict=True):
                pieces[piece] = buffer[stop - size : stop]
        if len(short) < len(coded):
            forward = self.bpe.forward()
            for code, piece in coded:
                if pieces[piece] is None:
                    units = code.decode("latin-1")
                    forward.go(units)
                    pieces[piece] = packed(np.array(self.ends(piece, units, forward.count)), 1)

    def ends(self, piece: str, units: str, count: list[int]) -> list[int]:
        """The counts at a piece's characters."""
        if piece[0] == "'" and len(piece) > 1:
            return self.contraction(piece, count[-1:])
        return count[1:] if len(units) == len(piece) else char_ends(units, count)

    def contraction(self, piece: str, ends: list[int]) -> list[int]:
        """Counts inside pieces like 'll, whose prefixes the pattern splits otherwise."""
        return [self.count(piece[:n]) for n in range(1, len(piece))] + [ends[-1]]

    def count(self, text: str) -> int:
        return sum(
            len(self.bpe.encode(piece.encode().decode("latin-1")))
            for piece in self.pattern.findall(text)
        )

    def counts(self, text: str) -> np.ndarray:
        """The counts at the characters of any text.

        A cut changes the split into pieces only where it is: inside a special token, inside
        a contraction, or behind the last character of a run of white space.
        """
        counts: list[int] = []
        start = 0
        for match in [*self.special_text.finditer(text), None]:
            done = counts[-1] if counts else 0
            end = match.start() if match else len(text)
            at_end = self.segment(text[start:end], parts := [], done)
            if match:
                self.segment(text[start : match.end()], parts := [], done)
                parts[-1] = at_end + 1
                start = match.end()
            counts.extend(parts)
        return np.array(counts, dtype=np.int64)

    def segment(self, text: str, counts: list[int], done: int) -> int:
        """Append the counts at the characters of ``text``; give the count at its end."""
        forward = self.bpe.forward()
        run_start, before_run, place, in_run = 0, done, 0, False
        for piece in self.pattern.findall(text):
            units = piece.encode().decode("latin-1")
            forward.go(units)
            count = forward.count
            ends = self.ends(piece, units, count)
            if in_run and self.space.match(piece):
                ends[0] = before_run + self.count(text[run_start : place + 1]) - done
            counts.extend(done + n for n in ends)
            in_run = self.space.match(piece) is not None and self.space.match(piece[-1]) is not None
            if in_run:
                run_start, before_run = place, done
            place += len(piece)
            done += count[-1]
        return done

    def wide(self, text: str) -> bytes:
        """The store of a text with steps of more than one byte."""
        counts = self.counts(text)
        width = next(w for w in WIDTHS if packed(counts, w) is not None)
        return bytes([width]) + packed(counts, width)

    def stores(self, texts: pa.StringArray) -> tuple[np.ndarray, memoryview]:
        """Where the texts' stores start and end, and their bytes: a width, then steps."""
        return self.memory.join(texts, before=b"\1", otherwise=self.wide)


def byte_letters() -> dict[str, str]:
    """The characters byte-level BPE files write bytes with, each to its Latin-1 character."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [byte for byte in range(256) if byte not in shown]
    letters = {chr(byte): chr(byte) for byte in shown}
    return letters | {chr(256 + place): chr(byte) for place, byte in enumerate(hidden)}


def char_ends(units: str, count: list[int]) -> list[int]:
    """The counts at the last bytes of characters."""
    size = len(units)
    return [
        count[i] for i in range(1, size + 1) if i == size or not 0x80 <= ord(units[i]) < 0xC0
    ]


def packed(counts: np.ndarray, width: int) -> bytes | None:
    """The steps from count to count, None if they need more than ``width`` bytes."""
    steps = np.diff(counts, prepend=0)
    limits = np.iinfo(WIDTHS[width])
    if len(steps) and (steps.min() < limits.min or steps.max() > limits.max):
        return None
    return steps.astype(WIDTHS[width]).tobytes()


def prefix_counts(store: bytes) -> np.ndarray:
    """Tokens of the first 0, 1, 2, ... characters."""
    steps = np.frombuffer(store, dtype=WIDTHS[store[0]], offset=1)
    return np.concatenate([[0], np.cumsum(steps, dtype=np.int64)])


def count_tokens(
    docs: DataFrame, *, tokenizer: str = "byte_bpe_50k.json", limit: int = 512
) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit, fit_chars and the store ``token_steps``.

    ``fit_chars`` is the length of the longest prefix with at most ``limit`` tokens, in
    characters. Other columns of ``docs`` are not read.
    """

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(tokenizer)
        for batch, texts in slices(batches):
            places, data = coder.stores(texts)
            fits = pc.utf8_length(texts).to_numpy().astype(np.int64)
            steps = np.frombuffer(data, dtype=np.int8)
            # The width itself, 1, stands before the steps.
            tokens = np.add.reduceat(steps, places[:-1], dtype=np.int64) - 1
            for i in np.flatnonzero((steps[places[:-1]] != 1) | (tokens > limit)).tolist():
                counts = prefix_counts(data[places[i] : places[i + 1]])
                tokens[i] = counts[-1]
                fits[i] = np.flatnonzero(counts <= limit)[-1]
            offsets = pa.py_buffer(places.astype(np.int32).tobytes())
            stores = pa.BinaryArray.from_buffers(pa.binary(), len(texts), [None, offsets, pa.py_buffer(data)])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(pc.binary_length(texts), pa.int64()),
                    pa.array(tokens),
                    pa.array(tokens > limit),
                    pa.array(fits),
                    stores,
                ],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit", "fit_chars", "token_steps"],
            )

    return by_arrow(
        docs.select(F.col("doc_id").cast("long"), "text"),
        work,
        "doc_id long, n_bytes long, n_tokens long, over_limit boolean, fit_chars long, "
        "token_steps binary",
    )


def tokens_of_prefix(store: Column, n_chars: Column) -> Column:
    """Truncation: tokens of the first ``n_chars`` characters, from the stored steps."""

    @F.pandas_udf("long")
    def answer(steps, chars):
        import pandas as pd

        return pd.Series(
            [int(prefix_counts(s)[min(n, len(s))]) for s, n in zip(steps, chars, strict=True)]
        )

    return answer(store, n_chars)


def chars_in_budget(store: Column, budget: Column) -> Column:
    """Budget: characters of the longest prefix with at most ``budget`` tokens."""

    @F.pandas_udf("long")
    def answer(steps, budgets):
        import pandas as pd

        return pd.Series(
            [
                int(np.flatnonzero(prefix_counts(s) <= b)[-1])
                for s, b in zip(steps, budgets, strict=True)
            ]
        )

    return answer(store, budget)
