"""Ids of whole batches of texts, each distinct part of them encoded once.

Vocabularies that merge inside words only may be cut in front of a space that stands between characters
which aren't white space. Arrow cuts the texts and finds the distinct parts; those a worker hasn't
met go to the vocabulary's own library, many in one text, and numpy puts the ids of all texts together.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Parts after which a worker begins a new memory, and characters of a text made of new parts.
REMEMBERED = 700_000
TOGETHER = 1 << 14

# Python counts a few characters more as white space than the vocabularies do: fewer cuts, same ids.
_SAFE = re.compile(r"(?<!\s) (?=\S)")


def _whole(parts: list[str]) -> list[int]:
    """Places of the parts that can't stand among others: their own text may not meet that of a neighbour."""
    return [at for at, part in enumerate(parts) if not part or " " in part or part.strip() != part]


@dataclass
class Coded:
    """Codes of parts: ids one after the other, where each part's end, and whether they stand for
    exactly the bytes of the part."""

    ids: np.ndarray
    ends: np.ndarray
    exact: np.ndarray


class Vocabulary:
    """A vocabulary for parts that follow a space.

    ``encode`` gives the ids of each of some texts; ``spelled`` has the bytes of each id. Nothing but
    the first id of a part may begin with a space, unless the part has white space at an end or
    a space inside.
    """

    def __init__(self, encode: Callable[[list[str]], list], spelled: list[bytes]) -> None:
        self.encode = encode
        self.spelled = np.array(spelled, object)
        self.sizes = np.array([len(s) for s in spelled], np.int64)
        self.opens = np.array([s[:1] == b" " for s in spelled])

    def _one(self, part: str) -> tuple[np.ndarray, bool]:
        ids = np.array(self.encode([" " + part])[0], np.int32)
        return ids, b"".join(self.spelled[ids]) == (" " + part).encode("utf-8", "surrogatepass")

    def codes(self, parts: list[str]) -> Coded:
        odd = _whole(parts)
        if not odd:
            return self._together(parts)
        alone = [self._one(parts[at]) for at in odd]
        apart = set(odd)
        coded = self._together([part for at, part in enumerate(parts) if at not in apart])
        # Where each part's code is: those encoded together come first.
        source = np.empty(len(parts), np.int64)
        source[odd] = len(coded.ends) + np.arange(len(odd))
        source[np.setdiff1d(np.arange(len(parts)), odd, assume_unique=True)] = np.arange(len(coded.ends))
        every = Coded(
            np.concatenate([coded.ids, *(ids for ids, _ in alone)]),
            np.concatenate([coded.ends, len(coded.ids) + np.cumsum([len(ids) for ids, _ in alone])]),
            np.concatenate([coded.exact, [same for _, same in alone]]),
        )
        return Coded(*gathered(every, source), every.exact[source])

    def _together(self, parts: list[str]) -> Coded:
        """Codes of parts that may stand one after the other in a text."""
        cuts = _cuts([len(part) + 1 for part in parts])
        blocks = [parts[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]
        texts = [" " + " ".join(block) for block in blocks]
        ids, sizes, exact = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)], np.ones(len(parts), bool)
        for at, block, text, code in zip(cuts, blocks, texts, self.encode(texts) if texts else [], strict=False):
            code = np.array(code, np.int32)
            starts = np.flatnonzero(self.opens[code])
            same = b"".join(self.spelled[code]) == text.encode("utf-8", "surrogatepass")
            if not same or len(starts) != len(block):
                each = [self._one(part) for part in block]
                code = np.concatenate([ids for ids, _ in each])
                starts = np.cumsum([0, *(len(ids) for ids, _ in each[:-1])])
                exact[at : at + len(block)] = [same for _, same in each]
            ids.append(code)
            sizes.append(np.diff(starts, append=len(code)))
        return Coded(np.concatenate(ids), np.cumsum(np.concatenate(sizes)), exact)


def _cuts(sizes: list[int]) -> list[int]:
    """Where blocks of about TOGETHER begin, and the end."""
    ends = np.cumsum(sizes) // TOGETHER if sizes else np.zeros(0, np.int64)
    return [0, *(np.flatnonzero(np.diff(ends)) + 1).tolist(), len(sizes)] if sizes else [0]


class Memory:
    """What some vocabularies make of the parts a worker has met. Beyond ``REMEMBERED`` parts it begins
    anew, with those of the batch at hand: results are the same, its size is bounded."""

    def __init__(self, vocabularies: list[Vocabulary]) -> None:
        self.vocabularies = vocabularies
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.parts: list[str] = []
        self.coded = [Coded(np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, bool)) for _ in self.vocabularies]

    def _learn(self, parts: list[str]) -> np.ndarray:
        if len(self.known) > REMEMBERED:
            self._forget()
        known = self.known
        new = [p for p in parts if p not in known]
        if new:
            self.parts += new
            known.update(zip(new, range(len(known), len(self.parts)), strict=True))
            for at, (vocabulary, old) in enumerate(zip(self.vocabularies, self.coded, strict=True)):
                more = vocabulary.codes(new)
                self.coded[at] = Coded(
                    np.concatenate([old.ids, more.ids]),
                    np.concatenate([old.ends, len(old.ids) + more.ends]),
                    np.concatenate([old.exact, more.exact]),
                )
        return np.fromiter(map(known.__getitem__, parts), np.int64, len(parts))

    def places(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(places, ends): the parts of texts, none of them null, as places in ``coded``, and where
        those of each text end. Every text is taken to follow a space."""
        lists = pc.split_pattern(texts, " ")
        words = pc.list_flatten(lists).dictionary_encode()
        offsets = np.asarray(lists.offsets, np.int64)
        offsets = offsets - offsets[0]
        distinct = words.dictionary.to_numpy(zero_copy_only=False).tolist()
        codes = words.indices.to_numpy(zero_copy_only=False)
        # A part that begins or ends with white space, or is nothing.
        bare = pc.utf8_trim_whitespace(words.dictionary)
        odd = pc.or_(pc.equal(bare, ""), pc.not_equal(bare, words.dictionary)).to_numpy(zero_copy_only=False)
        # A text with white space next to a space is cut with care.
        rows = np.unique(np.searchsorted(offsets, np.flatnonzero(odd[codes]), "right") - 1) if odd.any() else []
        careful = {int(r): _cut(texts[int(r)].as_py()) for r in rows}
        needed = distinct if not careful else [p for p, o in zip(distinct, odd, strict=True) if not o]
        more = dict.fromkeys(p for parts in careful.values() for p in parts)
        if not careful:
            return self._learn(distinct)[codes], offsets[1:]
        every = list(dict.fromkeys([*needed, *more]))
        place = dict(zip(every, self._learn(every).tolist(), strict=True))
        by_code = np.array([place.get(p, -1) for p in distinct], np.int64)
        pieces, sizes = [], []
        for r in range(len(offsets) - 1):
            mine = (
                np.array([place[p] for p in careful[r]], np.int64) if r in careful
                else by_code[codes[offsets[r] : offsets[r + 1]]]
            )
            pieces.append(mine)
            sizes.append(len(mine))
        return np.concatenate([np.zeros(0, np.int64), *pieces]), np.cumsum(sizes, dtype=np.int64)


def _cut(text: str) -> list[str]:
    """The parts of a text that follows a space, each without the space in front of it."""
    text = " " + text
    cuts = [m.start() for m in _SAFE.finditer(text) if m.start()]
    return [text[a + 1 : b] for a, b in zip([0, *cuts], [*cuts, len(text)], strict=True)]


def gathered(coded: Coded, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(ids, ends): the ids of these parts one after the other, and where each part's end."""
    ends = coded.ends[places]
    sizes = ends - np.where(places > 0, coded.ends[places - 1], 0)
    stops = np.cumsum(sizes)
    total = int(stops[-1]) if len(stops) else 0
    return coded.ids[np.arange(total) + np.repeat(ends - stops, sizes)], stops
