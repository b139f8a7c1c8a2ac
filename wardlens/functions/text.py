"""Name matching. Names compare without regard to case and to blanks behind them, as columns
of fixed width have them; codes compare exactly."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F


def first_token(name: Column, trim: bool = True) -> Column:
    """Upper-case text before the first blank.

    With ``trim=False`` a name that starts with a blank gives the empty text.
    """
    text = F.ltrim(name) if trim else name
    return F.upper(F.substring_index(text, " ", 1))


def same_name(name: Column, *names: str) -> Column:
    """True where ``name`` is one of ``names``; null where it is null."""
    return name_key(name).isin(sorted({name.rstrip(" ").upper() for name in names}))


def name_key(name: Column) -> Column:
    """What names are equal, joined and grouped by."""
    return F.upper(F.rtrim(name))


def contains_any(name: Column, parts: Sequence[str]) -> Column:
    """True where ``name`` holds any of ``parts``; null where ``name`` is null.

    More than FEW parts are one search for the tree of their prefixes, so that a name is read
    once however many there are.
    """
    lowered = F.lower(name)
    wanted = sorted({part.lower() for part in parts})
    if len(wanted) > FEW and "" not in wanted:
        return lowered.rlike(prefix_pattern(wanted))
    return reduce(or_, (lowered.contains(part) for part in wanted))


def prefix_pattern(parts: Sequence[str]) -> str:
    """A pattern that is found where one of the non-empty ``parts`` is, as they are written.

    Parts with a common beginning share it. What goes on behind a part is left out, since the
    part is found already; no two branches of a node begin alike, so a search never goes back.
    """
    tree: dict = {}
    for part in sorted(parts, key=len):
        node = tree
        for letter in part:
            if node.get(letter) == {}:
                break  # A node with nothing below ends a part.
            node = node.setdefault(letter, {})
    return _branches(tree)


#: Parts up to this number are searched one by one.
FEW = 8


def _branches(tree: dict) -> str:
    written = []
    for letter, node in sorted(tree.items()):
        literal = letter if letter.isalnum() or ord(letter) > 127 else f"\\{letter}"
        written.append(literal + (_branches(node) if node else ""))
    return written[0] if len(written) == 1 else f"(?:{'|'.join(written)})"


def starts_with_any(name: Column, prefixes: Sequence[str]) -> Column:
    """True where ``name`` starts with any of ``prefixes``; null where it is null."""
    lowered = F.lower(name)
    return reduce(or_, (lowered.startswith(prefix.lower()) for prefix in prefixes))


def joined(*parts: Column) -> Column:
    """Parts put together, a null part counting as empty text."""
    return F.concat_ws("", *parts)
