"""Splitting texts where a tokenizer never joins, and remembering what chunks give.

Arrow splits texts into words and numbers the distinct ones; what a distinct word gives is
worked out once, remembered, and put together for all its places. Words beside unusual white
space make a text odd: it is split by slower rules, but also into chunks of their own.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Most words remembered by a Python worker; beyond it the older ones go.
REMEMBERED = 800_000
#: Longer words are not remembered.
LONGEST = 100
#: Tables of remembered words before they become one.
TABLES = 5


@dataclass
class Table:
    """Words with their bytes, in the order of the words' hashes."""

    hashes: np.ndarray
    words: pa.StringArray
    values: pa.BinaryArray

    def places(self, hashes: np.ndarray, words: pa.StringArray, rows: np.ndarray) -> np.ndarray:
        """Where the words in ``rows`` are, which ``hashes`` are of; -1 for words not here."""
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        same = np.flatnonzero(self.hashes[at] == hashes)
        # Equal hashes are not enough: the words themselves decide.
        equal = pc.equal(self.words.take(pa.array(at[same])), words.take(pa.array(rows[same])))
        found = np.full(len(hashes), -1, dtype=np.int64)
        sure = same[equal.to_numpy(zero_copy_only=False)]
        found[sure] = at[sure]
        return found


def table_of(hashes: np.ndarray, words: pa.StringArray, values: pa.BinaryArray) -> Table:
    order = np.argsort(hashes, kind="stable")
    return Table(hashes[order], words.take(pa.array(order)), values.take(pa.array(order)))


def visible_ends(words: pa.StringArray) -> np.ndarray:
    """True where the first and the last character are visible ones of ASCII."""
    found = np.zeros(len(words), dtype=bool)
    if not len(words):
        return found
    places = np.frombuffer(words.buffers()[1], dtype=np.int32)[words.offset : words.offset + len(words) + 1]
    data = np.frombuffer(words.buffers()[2] or b"", dtype=np.uint8)
    some = np.flatnonzero(np.diff(places))
    first, last = data[places[some]], data[places[some + 1] - 1]
    found[some] = (first > 0x20) & (first < 0x7F) & (last > 0x20) & (last < 0x7F)
    return found


class ChunkMemory:
    """Gives for texts the bytes of their chunks put together.

    ``work`` turns sorted distinct chunks into their bytes. ``plain`` tells whether a word
    between blanks can be taken by itself, ``chunk`` names the chunk of a word (at the head of
    a text or behind a blank), ``whole`` splits an odd text. With ``feeds`` a line feed
    starts a word, too, and stays with it. ``ends`` says that a word's first and last
    character tell that it is plain, if they are visible ones of ASCII. ``many`` gives the
    bytes of distinct plain words that are not at the head of a text, all at once; then
    ``work`` is left with heads and odd texts.
    """

    def __init__(
        self,
        work: Callable[[list[str]], Iterable[bytes | None]],
        *,
        plain: Callable[[str], bool],
        chunk: Callable[[str, bool], str],
        whole: Callable[[str], list[str]],
        feeds: bool,
        ends: bool = False,
        many: Callable[[pa.StringArray], pa.BinaryArray] | None = None,
    ):
        self.work, self.plain, self.chunk, self.whole, self.feeds = work, plain, chunk, whole, feeds
        self.ends, self.many = ends, many
        self.tables: list[Table] = []

    def join(
        self, texts: pa.StringArray, before: bytes = b"", otherwise: Callable[[str], bytes] | None = None
    ) -> tuple[np.ndarray, memoryview]:
        """The places of the texts' bytes and all bytes; ``before`` stands before each text.

        ``otherwise`` gives the bytes (with what stands before) of a text that has a chunk
        for which ``work`` has none.
        """
        from pandas.util import hash_array

        spaced = pc.replace_substring(texts, "\n", " \n") if self.feeds else texts
        split = pc.split_pattern(spaced, " ")
        places = split.offsets.to_numpy().astype(np.int64)
        coded = split.values.slice(places[0], places[-1] - places[0]).dictionary_encode()
        places -= places[0]
        index = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        heads = places[:-1]
        words = coded.dictionary
        hashes = hash_array(words.to_numpy(zero_copy_only=False), categorize=False)

        # What is known comes first into the bank of bytes, table by table.
        slot = np.full(len(words), -1, dtype=np.int64)
        bank, size = [], 0
        by_hash = np.argsort(hashes)
        for table in self.tables:
            open_ = by_hash[slot[by_hash] < 0]
            at = table.places(hashes[open_], words, open_)
            hit = at >= 0
            slot[open_[hit]] = size + np.arange(hit.sum())
            bank.append(table.values.take(pa.array(at[hit])))
            size += int(hit.sum())
        new = np.flatnonzero(slot < 0)
        unknown = words.take(pa.array(new))

        odd = ~visible_ends(unknown) if self.ends else np.ones(len(new), dtype=bool)
        unsure = unknown.take(pa.array(np.flatnonzero(odd))).to_pylist()
        odd[odd] = [not self.plain(word) for word in unsure]
        head_words = words.take(pa.array(index[heads])).to_numpy(zero_copy_only=False).tolist()
        strange = np.zeros(len(words), dtype=bool)
        strange[new[odd]] = True
        in_text = np.add.reduceat(strange[index], heads) > 0
        in_text |= np.array([word[:1].isspace() for word in head_words], dtype=bool)
        wholes = {i: self.whole(texts[i].as_py()) for i in np.flatnonzero(in_text).tolist()}

        chunks = set()
        for i, word in enumerate(head_words):
            chunks.update(wholes[i] if i in wholes else (self.chunk(word, True),))
        lacking = np.zeros(len(new), dtype=bool)
        if self.many is None:
            names = [
                None if bad else self.chunk(word, False)
                for word, bad in zip(unknown.to_pylist(), odd.tolist(), strict=True)
            ]
            chunks.update(names)
            chunks.discard(None)
        order = sorted(chunks)
        found = dict(zip(order, self.work(order), strict=True))
        if self.many is None:
            values = [found.get(name) if name is not None else b"" for name in names]
            lacking[:] = [value is None for value in values]
            coded_new = pa.array([value or b"" for value in values], pa.binary())
        else:
            taken = np.flatnonzero(~odd)
            place = np.full(len(new), len(taken), dtype=np.int64)
            place[taken] = np.arange(len(taken))
            given = [self.many(unknown.take(pa.array(taken))), pa.array([b""], pa.binary())]
            coded_new = pa.concat_arrays(given).take(pa.array(place))
        slot[new] = size + np.arange(len(new))
        bank.append(coded_new)
        size += len(new)

        lost_texts: set[int] = set()
        if lacking.any():
            lost = np.zeros(len(words), dtype=bool)
            lost[new] = lacking
            lost_texts = set(np.flatnonzero(np.add.reduceat(lost[index], heads)).tolist()) - wholes.keys()
        starts: list[bytes] = []
        for i, word in enumerate(head_words):
            parts = [found[c] for c in wholes[i]] if i in wholes else [found[self.chunk(word, True)]]
            if i in lost_texts or None in parts:
                lost_texts.add(i)
                starts.append(otherwise(texts[i].as_py()))
            else:
                starts.append(before + b"".join(parts))
        bank.append(pa.array([b"", *starts], pa.binary()))
        # Whole texts stand at their head; the other words of these add nothing.
        of = slot[index]
        of[heads] = size + 1 + np.arange(len(heads))
        for i in (*wholes, *lost_texts):
            of[places[i] + 1 : places[i + 1]] = size
        joined = pa.concat_arrays(bank).take(pa.array(of))
        ends = np.frombuffer(joined.buffers()[1], dtype=np.int32, count=len(joined) + 1).astype(np.int64)
        short = pc.less_equal(pc.utf8_length(unknown), LONGEST).to_numpy(zero_copy_only=False)
        good = np.flatnonzero(~odd & ~lacking & short)
        self.remember(hashes[new[good]], unknown.take(pa.array(good)), coded_new.take(pa.array(good)))
        return ends[places], memoryview(joined.buffers()[2] or b"")

    def remember(self, hashes: np.ndarray, words: pa.StringArray, values: pa.BinaryArray) -> None:
        if not len(hashes):
            return
        self.tables.append(table_of(hashes, words, values))
        if sum(len(table.hashes) for table in self.tables) > REMEMBERED:
            del self.tables[0]
        if len(self.tables) > TABLES:
            parts = self.tables
            self.tables = [
                table_of(
                    np.concatenate([table.hashes for table in parts]),
                    pa.concat_arrays([table.words for table in parts]),
                    pa.concat_arrays([table.values for table in parts]),
                )
            ]


#: A chunk border that no byte-level piece reaches over, in the text or any prefix of it.
BORDER = re.compile(r"(?<=\S)(?=[ \n]\S)")


def byte_level_memory(
    work: Callable[[list[str]], Iterable[bytes | None]],
    many: Callable[[pa.StringArray], pa.BinaryArray] | None = None,
) -> ChunkMemory:
    """For tokenizers with the byte-level pattern.

    A blank or line feed between two characters that are no white space always starts a new
    piece, also in every prefix of the text. A chunk comes with its blank or line feed, but
    ``many`` gets words without the blank before them.
    """

    def plain(word: str) -> bool:
        if not word or word[-1].isspace():
            return False
        return not word[0].isspace() or (word[0] == "\n" and not word[1].isspace())

    def chunk(word: str, head: bool) -> str:
        return word if head or word[0] == "\n" else f" {word}"

    def whole(text: str) -> list[str]:
        return BORDER.split(text) if text else []

    return ChunkMemory(work, plain=plain, chunk=chunk, whole=whole, feeds=True, ends=True, many=many)
