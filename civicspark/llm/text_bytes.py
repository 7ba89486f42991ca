"""Texts of an Arrow batch as one byte array, in pieces of bounded size.

The helpers run inside tasks on whole texts.  A piece holds as many rows as fit
into ``PIECE_BYTES`` and at least one, so the memory needed follows the longest
text, not the batch.  A space is put behind every text, so nothing that is cut
at white space crosses from one text to the next.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE_BYTES, PIECE_ROWS = 1_000_000, 1 << 16
# odd multipliers of the rolling hash (any odd numbers would do)
BASE, MIX = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93
_SPACED = pa.scalar("", pa.large_string()), pa.scalar(" ", pa.large_string())
_LOWER = np.frombuffer(bytes(range(256)).lower(), np.uint8)
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


class Piece(NamedTuple):
    first: int              # first row of the batch
    data: np.ndarray        # bytes of all rows, a space behind each
    starts: np.ndarray      # of each row in ``data``
    ends: np.ndarray        # of each row, without the space


def pieces(texts: pa.Array, max_bytes: int = PIECE_BYTES, lower: bool = False) -> Iterator[Piece]:
    """Null texts count as empty.  ``lower``: with A-Z in lower case, piece by piece instead of a copy of the batch."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    size = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64) + 1
    upto, first = np.cumsum(size), 0
    while first < len(texts):
        before = upto[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(upto, before + max_bytes, side="right")))
        last = min(last, first + PIECE_ROWS)
        part = texts.slice(first, last - first)
        part = pc.binary_join_element_wise(part, *_SPACED)
        n = size[first:last]
        offsets = np.frombuffer(part.buffers()[1], np.int64)[part.offset:part.offset + len(part) + 1]
        data = np.frombuffer(part.buffers()[2], np.uint8)[offsets[0]:offsets[-1]]
        if lower:          # not by ascii_lower, which is wrong on the cast of a slice: its first offset is not 0
            data = _LOWER[data]
        ends = np.cumsum(n)
        yield Piece(first, data, ends - n, ends - 1)
        first = last


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of BASE and of its inverse modulo 2**64."""
    if 0 not in _POWERS or len(_POWERS[0][0]) < n:
        size = max(n, PIECE_BYTES + 2)

        def table(base: int) -> np.ndarray:
            out = np.ones(size, np.uint64)
            out[1:] = np.uint64(base)
            return np.multiply.accumulate(out)
        _POWERS[0] = table(BASE), table(pow(BASE, -1, 1 << 64))
    return _POWERS[0]


def mixed(h: np.ndarray) -> np.ndarray:
    """Spreads the bits of a polynomial hash."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(MIX)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(BASE)
    return h ^ (h >> np.uint64(32))


class Hasher:
    """Hashes of any stretches of a byte array, each in constant time.  Every byte stands
    for a random 64-bit number (by ``seed``), so two seeds give independent hashes."""

    def __init__(self, data: np.ndarray, seed: int = 1):
        n = len(data)
        self.back = _powers(n + 1)[1]
        numbers = np.random.default_rng(seed).integers(0, 1 << 64, 256, np.uint64)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(numbers[data] * _powers(n + 1)[0][:n], out=self.sums[1:])

    def raw(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return (self.sums[ends] - self.sums[starts]) * self.back[starts]

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mixed(self.raw(starts, ends) + (ends - starts).astype(np.uint64))


def runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the stretches where ``mask`` holds."""
    edge = np.diff(np.concatenate([[False], mask, [False]]).astype(np.int8))
    return np.nonzero(edge == 1)[0], np.nonzero(edge == -1)[0]


def row_of(piece: Piece, at: np.ndarray) -> np.ndarray:
    """Row (in the piece) that holds each position."""
    return np.searchsorted(piece.starts, at, side="right") - 1
