"""A covering code on 64 bits, made of two perfect binary Golay codes and 18 free bits.

The Golay code has 23 bits and 4096 words, and every 23-bit string is within 3 bits of exactly
one of them. The anchors are the strings whose bits 0..22 and 23..45 are code words and whose
other bits are zero; their covering radius is 3 + 3 + 18. The home of a fingerprint is the anchor
that has the nearest code word in each block.

A fingerprint has to meet all that are within two bits of it. Their homes are anchors within the
covering radius plus two of it, and of those only the ones that two changed bits can lead to are
wanted: about 70 of 2**24, whatever the number of fingerprints.
"""

from __future__ import annotations

from functools import cache

import numpy as np

# Fixed value: the generator polynomial of the binary Golay code.
_GENERATOR = 0xC75
_BITS = 23
_MASK = np.uint64((1 << _BITS) - 1)


def _syndrome(words: np.ndarray) -> np.ndarray:
    rest = words.astype(np.int64)
    for bit in range(_BITS - 1, 10, -1):
        rest = np.where(rest >> bit & 1, rest ^ (_GENERATOR << (bit - 11)), rest)
    return rest


def _patterns(most: int) -> np.ndarray:
    """All 23-bit strings with at most ``most`` bits set, fewest bits first."""
    found, last = [0], [0]
    for _ in range(most):
        last = sorted({p | 1 << b for p in last for b in range(_BITS) if not p >> b & 1})
        found += last
    return np.array(found, dtype=np.int64)


@cache
def tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """By syndrome: the error to the nearest code word; the changes of home (never none) by one
    changed bit; and those by one or two. Rows are filled up with 0."""
    errors = np.zeros(2048, np.int64)
    patterns = _patterns(3)
    errors[_syndrome(patterns)] = patterns

    def changes(flips: np.ndarray) -> np.ndarray:
        moved = errors[:, None] ^ flips[None, :]
        shift = moved ^ errors[_syndrome(moved)]
        rows = [np.setdiff1d(row, [0]) for row in shift]
        table = np.zeros((2048, max(len(r) for r in rows)), np.uint64)
        for at, row in enumerate(rows):
            table[at, : len(row)] = row
        return table

    return errors.astype(np.uint64), changes(_patterns(1)), changes(_patterns(2))


def homes(prints: np.ndarray) -> np.ndarray:
    """The home anchor of each fingerprint (uint64)."""
    errors = tables()[0]
    low, high = prints & _MASK, prints >> np.uint64(_BITS) & _MASK
    low, high = low ^ errors[_syndrome(low)], high ^ errors[_syndrome(high)]
    return low | high << np.uint64(_BITS)


def meeting_places(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The anchors at which each fingerprint meets all within two bits of it: row numbers and
    anchors, its own home included."""
    _, one, two = tables()
    low = _syndrome(prints & _MASK)
    high = _syndrome(prints >> np.uint64(_BITS) & _MASK)
    move = np.uint64(_BITS)
    changes = np.concatenate(
        [
            np.zeros((len(prints), 1), np.uint64),
            two[low],
            two[high] << move,
            np.where(
                (one[low][:, :, None] != 0) & (one[high][:, None, :] != 0),
                one[low][:, :, None] | one[high][:, None, :] << move,
                np.uint64(0),
            ).reshape(len(prints), -1),
        ],
        axis=1,
    )
    wanted = changes != 0
    wanted[:, 0] = True
    rows, columns = np.nonzero(wanted)
    return rows, homes(prints)[rows] ^ changes[rows, columns]
