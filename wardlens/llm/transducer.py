"""A minimal acyclic transducer from words to token ids, as one file that is memory-mapped.

Words come in order; states whose outgoing arcs, ends and outputs are equal become one, so
common suffixes are stored once. Ids stand as far in front as all words through an arc allow,
which lets more suffixes be shared. The file holds plain arrays: all arcs in the order of
(state, byte) with target and output, and each state's end. Many words are followed at once,
byte by byte.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Sequence

import numpy as np

#: No end: a state no word ends in.
NO_END = -1


class _State:
    """A state that may still change: its arcs (target, ids) by byte, and its end's ids."""

    __slots__ = ("arcs", "end")

    def __init__(self) -> None:
        self.arcs: dict[int, list] = {}
        self.end: tuple[int, ...] | None = None


class Builder:
    """Builds the transducer of words added in ascending order of their bytes."""

    def __init__(self) -> None:
        self.path = [_State()]
        self.last = b""
        self.known: dict[tuple, int] = {}
        self.states: list[tuple] = []

    def add(self, word: bytes, ids: Sequence[int]) -> None:
        if not word or word <= self.last:
            raise ValueError("words must be in order, distinct and not empty")
        shared = 0
        for a, b in zip(self.last, word, strict=False):
            if a != b:
                break
            shared += 1
        self._settle(shared)
        out = tuple(ids)
        for place in range(shared):
            arc, state = self.path[place].arcs[word[place]], self.path[place + 1]
            common = 0
            for a, b in zip(arc[1], out, strict=False):
                if a != b:
                    break
                common += 1
            if rest := arc[1][common:]:
                # What the words so far have in common here, the new one has not.
                for after in state.arcs.values():
                    after[1] = rest + after[1]
                if state.end is not None:
                    state.end = rest + state.end
                arc[1] = arc[1][:common]
            out = out[common:]
        for place in range(shared, len(word)):
            self.path.append(_State())
            self.path[place].arcs[word[place]] = [None, out]
            out = ()
        self.path[-1].end = out
        self.last = word

    def _settle(self, depth: int) -> None:
        """States below ``depth`` on the path change no more: number them, equal ones alike."""
        while len(self.path) > depth + 1:
            number = self._number(self.path.pop())
            self.path[-1].arcs[self.last[len(self.path) - 1]][0] = number

    def _number(self, state: _State) -> int:
        key = (state.end, tuple((byte, target, ids) for byte, (target, ids) in sorted(state.arcs.items())))
        found = self.known.get(key)
        if found is None:
            found = self.known[key] = len(self.states)
            self.states.append(key)
        return found

    def finish(self) -> bytes:
        """The file's bytes."""
        self._settle(0)
        root = self._number(self.path[0])
        outputs: dict[tuple[int, ...], int] = {(): 0}
        pool: list[int] = []

        def place(ids: tuple[int, ...]) -> int:
            if ids not in outputs:
                outputs[ids] = len(pool)
                pool.extend(ids)
            return outputs[ids]

        arcs = [
            (number << 8 | byte, target, place(ids), len(ids))
            for number, (_, state) in enumerate(self.states)
            for byte, target, ids in state
        ]
        ends = [(NO_END, 0) if end is None else (place(end), len(end)) for end, _ in self.states]
        made = np.array(arcs, dtype=np.int64).reshape(-1, 4)
        arrays = {
            "key": made[:, 0],
            "target": made[:, 1].astype(np.int32),
            "at": made[:, 2].astype(np.int32),
            "size": made[:, 3].astype(np.int32),
            "ends": np.array(ends, dtype=np.int32).reshape(-1),
            "pool": np.array(pool or [0], dtype=np.uint32),
        }
        head = json.dumps({"root": root, "arrays": {k: [a.dtype.str, len(a)] for k, a in arrays.items()}})
        front = len(head).to_bytes(8, "little") + head.encode()
        parts = [front, b" " * (-len(front) % 8)]
        for array in arrays.values():
            raw = np.ascontiguousarray(array).tobytes()
            parts += [raw, bytes(-len(raw) % 8)]
        return b"".join(parts)


def compiled(words: Iterable[tuple[bytes, Sequence[int]]]) -> bytes:
    """The file of words and their ids; the words in any order, each once."""
    builder = Builder()
    for word, ids in sorted(words):
        builder.add(word, ids)
    return builder.finish()


class Transducer:
    """A file of :class:`Builder`, mapped into memory and read where words lead."""

    def __init__(self, path: str):
        with open(path, "rb") as file:
            size = int.from_bytes(file.read(8), "little")
            head = json.loads(file.read(size))
        place = 8 + size + -(8 + size) % 8
        arrays = {}
        for name, (kind, count) in head["arrays"].items():
            bytes_ = np.dtype(kind).itemsize * count
            arrays[name] = (
                np.memmap(path, dtype=kind, mode="r", offset=place, shape=(count,)) if count else np.empty(0, kind)
            )
            place += bytes_ + -bytes_ % 8
        self.root = head["root"]
        self.key, self.target, self.at, self.size = (arrays[k] for k in ("key", "target", "at", "size"))
        self.ends, self.pool = arrays["ends"].reshape(-1, 2), arrays["pool"]

    def look_up(self, words: Sequence[bytes]) -> list[bytes | None]:
        """The ids of each word as little-endian unsigned 32-bit numbers; None if it is not here."""
        count = len(words)
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=count)
        starts = np.cumsum(lengths) - lengths
        letters = np.frombuffer(b"".join(words), dtype=np.uint8)
        state = np.full(count, self.root, dtype=np.int64)
        open_ = np.flatnonzero(lengths > 0) if len(self.key) else np.empty(0, dtype=np.int64)
        lost = np.ones(count, dtype=bool)
        lost[open_] = False
        steps: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        place = 0
        while len(open_):
            key = state[open_] << 8 | letters[starts[open_] + place]
            arc = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
            there = self.key[arc] == key
            lost[open_[~there]] = True
            open_, arc = open_[there], arc[there]
            state[open_] = self.target[arc]
            out = self.size[arc] > 0
            if out.any():
                steps.append((open_[out], self.at[arc[out]], self.size[arc[out]]))
            place += 1
            open_ = open_[lengths[open_] > place]
        end = self.ends[state]
        lost |= end[:, 0] == NO_END
        found = np.flatnonzero(~lost)
        steps.append((found, end[found, 0], end[found, 1]))

        sizes = np.zeros(count, dtype=np.int64)
        for word, _, size in steps:
            sizes[word] += size
        stops = np.cumsum(sizes)
        ids = np.empty(int(stops[-1]) if count else 0, dtype="<u4")
        at = stops - sizes
        for word, start, size in steps:
            # Runs of different lengths, copied as one.
            inside = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
            ids[np.repeat(at[word], size) + inside] = self.pool[np.repeat(start, size) + inside]
            at[word] += size
        raw, places = ids.tobytes(), (stops * 4).tolist()
        return [
            None if gone else raw[stop - 4 * size : stop]
            for gone, stop, size in zip(lost.tolist(), places, sizes.tolist(), strict=True)
        ]
