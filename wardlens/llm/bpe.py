"""Byte-pair encoding by dynamic programming over prefixes.

The encoding of a prefix ends in exactly one token t, and what stands before t is the
encoding of the shorter prefix. t is that token if the last token of the shorter prefix and
t stay apart when the two are encoded together. So one last token per prefix holds the
encodings of all prefixes, and a trie of texts shares the states of common prefixes.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Sequence

import numpy as np


#: Most answers about pairs of tokens that are remembered.
ANSWERS = 300_000


def merged(units: Sequence[str], rank: Callable[[str], float | None]) -> list[str]:
    """Join neighbours, lowest rank first and then leftmost, until none has a rank."""
    if len(units) <= 24:
        return _merged_short(list(units), rank)
    texts, after, before = list(units), list(range(1, len(units) + 1)), list(range(-1, len(units) - 1))
    queue: list[tuple[float, int, str]] = []

    def offer(left: int) -> None:
        right = after[left]
        if right < len(texts):
            both = texts[left] + texts[right]
            if (r := rank(both)) is not None:
                heapq.heappush(queue, (r, left, both))

    for i in range(len(texts)):
        offer(i)
    while queue:
        _, left, both = heapq.heappop(queue)
        right = after[left] if texts[left] else len(texts)
        if right >= len(texts) or texts[left] + texts[right] != both:
            continue
        texts[left], texts[right] = both, ""
        after[left] = after[right]
        if after[left] < len(texts):
            before[after[left]] = left
        offer(left)
        if before[left] >= 0:
            offer(before[left])
    return [text for text in texts if text]


def _merged_short(texts: list[str], rank: Callable[[str], float | None]) -> list[str]:
    never = float("inf")

    def of(i: int) -> float:
        found = rank(texts[i] + texts[i + 1])
        return never if found is None else found

    ranks = [of(i) for i in range(len(texts) - 1)]
    while ranks and (least := min(ranks)) != never:
        i = ranks.index(least)
        texts[i : i + 2] = [texts[i] + texts[i + 1]]
        del ranks[i]
        if i < len(ranks):
            ranks[i] = of(i)
        if i:
            ranks[i - 1] = of(i - 1)
    return texts


class PrefixBpe:
    """Last token, number of tokens and automaton state of every prefix.

    Tokens are texts whose characters are the units merging starts from (for byte-level
    tokenizers, the 256 characters of Latin-1 stand for the bytes). A unit that is no token
    stands alone.
    """

    def __init__(self, ranks: dict[str, float]):
        self.ranks = ranks
        self.apart: dict[tuple[str, str], bool] = {}
        self.whole: dict[str, bool] = {}
        self.next: list[dict[str, int]] = [{}]
        self.fail = [0]
        self.ends: list[tuple[tuple[str, int], ...]] = [()]
        for token in ranks:
            state = 0
            for unit in token:
                if (follow := self.next[state].get(unit)) is None:
                    follow = self.next[state][unit] = len(self.next)
                    self.next.append({})
                    self.fail.append(0)
                    self.ends.append(())
                state = follow
            self.ends[state] = ((token, len(token)),)
        self.tree = [dict(follow) for follow in self.next]
        level = list(self.tree[0].values())
        while level:
            below = []
            for state in level:
                self.ends[state] += self.ends[self.fail[state]]
                for unit, follow in self.tree[state].items():
                    self.fail[follow] = self.step(self.fail[state], unit)
                    below.append(follow)
            level = below

    def step(self, state: int, unit: str) -> int:
        """The automaton's next state; found steps are kept (at most units x states)."""
        known = self.next[state].get(unit)
        if known is None:
            known = self.step(self.fail[state], unit) if state else 0
            if known:
                self.next[state][unit] = known
        return known

    def encode(self, text: str) -> list[str]:
        return merged(text, self.ranks.get)

    def keeps_apart(self, left: str, right: str) -> bool:
        found = self.apart.get((left, right))
        if found is None:
            if len(self.apart) > ANSWERS:
                self.apart.clear()
            found = self.apart[left, right] = self.encode(left + right) == [left, right]
        return found

    def is_whole(self, token: str) -> bool:
        found = self.whole.get(token)
        if found is None:
            found = self.whole[token] = self.encode(token) == [token]
        return found

    def forward(self) -> Forward:
        return Forward(self)


class Forward:
    """States of the prefixes of one text after another.

    Given sorted texts, going from one to the next walks a trie of them depth-first: what a
    text has in common with the one before is not worked out again. ``last``, ``count`` and
    ``step`` hold the last token, the number of tokens and its change (as an unsigned byte,
    for texts under 128 units) at each length.
    """

    def __init__(self, bpe: PrefixBpe):
        self.bpe = bpe
        self.text = ""
        self.last: list[str | None] = [None]
        self.count = [0]
        self.state = [0]
        self.step = bytearray(1)

    def go(self, text: str) -> None:
        start = 0
        for a, b in zip(self.text, text, strict=False):
            if a != b:
                break
            start += 1
        self.text = text
        bpe, last, count, state, step = self.bpe, self.last, self.count, self.state, self.step
        del last[start + 1 :], count[start + 1 :], state[start + 1 :], step[start + 1 :]
        now, n, apart, ends, follow = state[start], count[start], bpe.apart, bpe.ends, bpe.next
        for i in range(start + 1, len(text) + 1):
            unit = text[i - 1]
            known = follow[now].get(unit)
            now = bpe.step(now, unit) if known is None else known
            for token, length in ends[now]:
                j = i - length
                if j:
                    ok = apart.get((last[j], token))
                    if ok is None:
                        ok = bpe.keeps_apart(last[j], token)
                else:
                    ok = bpe.is_whole(token)
                if ok:
                    break
            else:
                token, j = unit, i - 1
            last.append(token)
            before, n = n, count[j] + 1
            count.append(n)
            state.append(now)
            step.append((n - before) & 255)

    def tokens(self) -> list[str]:
        """The tokens of the text, read back from its end."""
        found, i = [], len(self.text)
        while i:
            token = self.last[i]
            found.append(token)
            i -= len(token)
        return found[::-1]


class ManyForward:
    """The prefix states of many byte texts at once, length by length, with numpy.

    For tokenizers whose 256 single bytes are tokens. Known answers to "do these two tokens
    stay apart?" are kept in a table by a hash of the pair; a pair that is not in its place
    is looked up or worked out anew.
    """

    PLACES = 1 << 21

    def __init__(self, bpe: PrefixBpe):
        self.bpe = bpe
        self.names = list(bpe.ranks)
        number = {token: i for i, token in enumerate(self.names)}
        states = len(bpe.tree)
        self.step = np.zeros((states, 256), dtype=np.int32)
        level = [0]
        while level:
            below = []
            for state in level:
                if state:
                    self.step[state] = self.step[bpe.fail[state]]
                for unit, follow in bpe.tree[state].items():
                    self.step[state, ord(unit)] = follow
                    below.append(follow)
            level = below
        self.longest = np.array([number[e[0][0]] if e else -1 for e in bpe.ends], dtype=np.int32)
        self.length = np.array([len(name) for name in self.names], dtype=np.int32)
        self.shorter = np.full(len(self.names), -1, dtype=np.int32)
        for ends in bpe.ends:
            for (left, _), (right, _) in zip(ends, ends[1:], strict=False):
                self.shorter[number[left]] = number[right]
        self.key = np.full(self.PLACES, -1, dtype=np.int64)
        self.apart = np.zeros(self.PLACES, dtype=bool)
        self.whole = np.array([bpe.is_whole(name) for name in self.names])

    def stay_apart(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left.astype(np.int64) << 20 | right
        places = (keys * 0x2545F4914F6CDD1D >> 40) & (self.PLACES - 1)
        answers = self.apart[places]
        missing = np.flatnonzero(self.key[places] != keys)
        if len(missing):
            new, back = np.unique(keys[missing], return_inverse=True)
            found = np.array(
                [self.bpe.keeps_apart(self.names[k >> 20], self.names[k & 0xFFFFF]) for k in new.tolist()]
            )
            answers[missing] = found[back]
            at = (new * 0x2545F4914F6CDD1D >> 40) & (self.PLACES - 1)
            self.key[at] = new
            for place, key, answer in zip(at.tolist(), new.tolist(), found.tolist(), strict=True):
                if self.key[place] == key:
                    self.apart[place] = answer
        return answers

    def counts(self, lengths: np.ndarray, units: np.ndarray) -> np.ndarray:
        """Numbers of tokens by length (rows) and text (columns).

        ``units`` has the bytes by place and text; the texts come longest first.
        """
        size, most = len(lengths), int(lengths[0])
        last = np.zeros((most + 1, size), dtype=np.int32)
        count = np.zeros((most + 1, size), dtype=np.int32)
        state = np.zeros(size, dtype=np.int32)
        ending = np.searchsorted(-lengths, -np.arange(1, most + 1), side="right")
        for i in range(1, most + 1):
            n = ending[i - 1]
            state = self.step[state[:n], units[i - 1, :n]]
            open_, token = np.arange(n), self.longest[state]
            while len(open_):
                before = i - self.length[token]
                ok = self.stay_apart(last[before, open_], token)
                start = before == 0
                ok[start] = self.whole[token[start]]
                done = open_[ok]
                last[i, done] = token[ok]
                count[i, done] = count[before[ok], done] + 1
                open_, token = open_[~ok], self.shorter[token[~ok]]
        return count
