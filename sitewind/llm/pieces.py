"""Cutting texts into parts that byte-level BPE encodes separately, each distinct part once.

Byte-level vocabularies split a text by a public pattern and merge bytes inside each match only. No
match goes from a character that isn't white space on to white space, so a text may be cut in front
of a space, unless white space stands on both sides of that space. ``cut`` does that with
``str.split``, which is many times faster than the pattern; only distinct parts meet the pattern.
"""

from __future__ import annotations

import gc
import re
from collections.abc import Callable

import regex

# Fixed value: the public pattern, with white space as the vocabularies' own libraries define it.
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?![^\p{White_Space}])|\p{White_Space}+"
)
_MATCHES = regex.compile(PATTERN)
_INSEPARABLE = re.compile(r"\s \s|\s $")

#: Parts after which a worker begins a new memory. It keeps the one before, from which it takes over
#: what it meets again, and encodes the rest anew: results are the same, its memory is bounded.
REMEMBERED = 400_000


def cut(text: str) -> tuple[list[str], list[str]]:
    """(parts as they are, parts that follow a space): the text is all of the first list, then each
    of the second after one space."""
    if _INSEPARABLE.search(text):
        return matches(text), []
    first, *rest = text.split(" ")
    return ([first] if first else []), rest


def matches(part: str) -> list[str]:
    return _MATCHES.findall(part)


class Remembered:
    """Codes of parts, kept from batch to batch and task to task of one worker.

    ``encode`` gets the distinct matches that aren't known, as UTF-8, and returns the code of each;
    the code of a part is the sum of the codes of its matches.
    """

    def __init__(self, encode: Callable[[list[bytes]], list], empty, most: int | None = None) -> None:
        self.encode, self.empty, self.most = encode, empty, most
        self.plain: dict[str, object] = {}
        self.spaced: dict[str, object] = {}
        self.before: tuple[dict, dict] = {}, {}

    def _learn(self, known: dict, before: dict, parts: set[str], space: str) -> list[tuple[str, list[str]]]:
        """Take over the parts met before; the matches of the others."""
        new = []
        for part in parts.difference(known):
            if (code := before.get(part)) is not None:
                known[part] = code
            else:
                new.append((part, matches(space + part)))
        return new

    def codes(self, texts: list[str]) -> list[list]:
        """For each text, the codes of its parts in order."""
        # What is remembered has no cycles, and searching it for some takes longer than the rest.
        gc.disable()
        try:
            return self._codes(texts)
        finally:
            gc.enable()

    def _codes(self, texts: list[str]) -> list[list]:
        if len(self.plain) + len(self.spaced) > (self.most or REMEMBERED):
            self.before, self.plain, self.spaced = (self.plain, self.spaced), {}, {}
        plain, spaced = self.plain, self.spaced
        parts = [cut(text) for text in texts]
        new_plain = self._learn(plain, self.before[0], set().union(*[first for first, _ in parts]), "")
        new_spaced = self._learn(spaced, self.before[1], set().union(*[rest for _, rest in parts]), " ")
        # A match that has been a part by itself is known.
        code, distinct = {}, []
        for m in {m for _, split in (*new_plain, *new_spaced) for m in split}:
            at, part = (1, m[1:]) if m[0] == " " else (0, m)
            known = (spaced if at else plain).get(part) or self.before[at].get(part)
            if known is None:
                distinct.append(m)
            else:
                code[m] = known
        code |= zip(distinct, self.encode([m.encode("utf-8", "surrogatepass") for m in distinct]), strict=True)
        for known, new in ((plain, new_plain), (spaced, new_spaced)):
            for part, split in new:
                total = code[split[0]] if split else self.empty
                for m in split[1:]:
                    total = total + code[m]
                known[part] = total
        return [[*map(plain.__getitem__, first), *map(spaced.__getitem__, rest)] for first, rest in parts]
