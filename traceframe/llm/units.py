"""Token ids of many short strings by a tokenizer library, each string encoded once while remembered.

Texts are cut where both the library's own splitting and its merges always begin anew, so the ids
of a text are those of its units in a row. What is remembered is bounded: two
generations of a fixed number of units. Longer strings are encoded each time.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator

#: Units remembered, and the longest of them in characters.
REMEMBERED = 400_000
LONGEST = 48
#: Characters of text that are cut into units, and of units that are encoded, at a time.
BLOCK = 1 << 20

_BLANK = re.compile(r"[ \n\t\r]")


class _Known(dict):
    """Units and their ids; asking for others lists them in ``asked``."""

    asked: list[str]

    def __missing__(self, unit: str) -> None:
        self.asked.append(unit)


class Units:
    """Maps units to what ``encode`` gives for a list of them."""

    def __init__(self, encode: Callable[[list[str]], list], remembered: int = REMEMBERED):
        self.encode, self.most = encode, max(1, remembered // 2)
        self.new, self.old = _Known(), {}

    def __call__(self, units: list[str]) -> list:
        self.new.asked = []
        found = list(map(self.new.__getitem__, units))
        asked = self.new.asked
        if asked:
            long, at = self._learn(dict.fromkeys(asked)), -1
            for u in asked:
                at = found.index(None, at + 1)
                found[at] = self.new[u]
            for u in long:
                del self.new[u]
            if len(self.new) > self.most:
                self.old, self.new = self.new, _Known()
        return found

    def _learn(self, missing: Iterable[str]) -> list[str]:
        """Put the units among those known; those of them that are too long to stay."""
        old, fresh = self.old, []
        for u in missing:
            known = old.get(u)
            if known is None:
                fresh.append(u)
            else:
                self.new[u] = known
        for some in blocks(fresh):
            self.new.update(zip(some, self.encode(some), strict=True))
        return [u for u in fresh if len(u) > LONGEST]


def blocks(units: list[str]) -> Iterator[list[str]]:
    """Runs of units of about ``BLOCK`` characters."""
    begin = size = 0
    for i, u in enumerate(units):
        size += len(u)
        if size >= BLOCK:
            yield units[begin : i + 1]
            begin, size = i + 1, 0
    if begin < len(units):
        yield units[begin:]


def parts(text: str, blank: re.Pattern = _BLANK) -> Iterator[str]:
    """The text in parts of about ``BLOCK`` characters that end at a match of ``blank``.

    The match itself is in no part. A text without one is a single part.
    """
    begin = 0
    while len(text) - begin > BLOCK:
        cut = blank.search(text, begin + BLOCK)
        if cut is None:
            break
        yield text[begin : cut.start()]
        begin = cut.end()
    yield text[begin:]
