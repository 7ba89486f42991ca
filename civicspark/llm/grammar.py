"""Run-length grammars by recompression, and longest common extensions on them.

A sequence of symbols is rewritten in rounds until it is short.  A round first
replaces every maximal block of one symbol (block compression), then, with the
symbols dealt into left and right ones by a hash, every left symbol followed by
a right one (pair compression).  Both look at nothing but the symbols
themselves, so equal stretches are rewritten equally but for O(1) symbols at
their ends in each round.  The sequences of all rounds, with the first child of
each symbol, are the grammar; their lengths fall geometrically.

An extension query climbs: as long as both places begin a symbol of the next
round it goes up; else it compares what is needed to get there (a symbol, or
the rest of a block).  Where symbols differ it goes down again, which leaves at
most one child to skip per round.  So a query takes O(1) steps per round, and
all queries take each step together, as arrays.  Extensions to the left use the
same grammar from symbol ends.

Places must be told apart by the sequence itself: a query may not run off an
end.  Unique symbols at both ends, and between documents, see to that.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pandas as pd

SHORT = 64                 # symbols below which no further round is made
MOST_ROUNDS = 200          # every round removes a symbol at least; this many halve far beyond any input
MIX = np.uint64(0x9E3779B97F4A7C15)


class Level(NamedTuple):
    symbols: np.ndarray     # names; equal names stand for equal stretches
    parent: np.ndarray      # index of the next level's symbol that holds each symbol
    first: np.ndarray       # of the next level's symbols: the first child, and the count at the end
    blocks: bool            # the next level has blocks (else pairs)


def _renamed(keys: np.ndarray) -> tuple[np.ndarray, int]:
    names, known = pd.factorize(keys)
    return names.astype(np.int64), len(known)


def _blocks(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First children and names after block compression; a lone symbol is a block of one."""
    first = np.flatnonzero(np.concatenate([[True], symbols[1:] != symbols[:-1]]))
    size = np.diff(np.append(first, len(symbols)))
    names, n = _renamed(symbols[first])
    many = size > 1
    if many.any():
        kinds, _ = _renamed(names[many] * (len(symbols) + 1) + size[many])
        names[many] = n + kinds
    return first, names


def _pairs(symbols: np.ndarray, salt: int) -> tuple[np.ndarray, np.ndarray]:
    """First children and names after pair compression; neighbours differ."""
    bits = (symbols.astype(np.uint64) + np.uint64(salt)) * MIX
    bits ^= bits >> np.uint64(29)
    left = (bits * MIX >> np.uint64(40)) & np.uint64(1) == 0
    heads = left[:-1] & ~left[1:]
    if not heads.any():
        left = ~left                                      # the other way round there is one, if there is a left one
        heads = left[:-1] & ~left[1:]
    second = np.concatenate([[False], heads])
    first = np.flatnonzero(~second)
    names, n = _renamed(symbols[first])
    head = np.append(heads, False)[first]
    if head.any():
        at = first[head]
        kinds, _ = _renamed(symbols[at] * (int(symbols.max()) + 1) + symbols[at + 1])
        names[head] = n + kinds
    return first, names


class Grammar:
    def __init__(self, symbols: np.ndarray):
        symbols, _ = _renamed(symbols)
        self.length = len(symbols)
        self.levels: list[Level] = []
        for step in range(2 * MOST_ROUNDS):
            if len(symbols) <= SHORT:
                break
            first, names = _blocks(symbols) if step % 2 == 0 else _pairs(symbols, step)
            bounds = np.append(first, len(symbols)).astype(np.int32)
            parent = np.repeat(np.arange(len(first), dtype=np.int32), np.diff(bounds))
            self.levels.append(Level(symbols.astype(np.int32), parent, bounds, step % 2 == 0))
            symbols = names
        nothing = np.zeros(0, np.int32)
        self.levels.append(Level(symbols.astype(np.int32), nothing, nothing, False))

    def __len__(self) -> int:
        return self.length

    def extend(self, i: np.ndarray, j: np.ndarray, forward: bool) -> np.ndarray:
        """Lengths of the longest equal stretches that begin at i and j (``forward``), or end before
        them.  i and j differ, and each pair meets a difference before an end of the sequence."""
        u, v = i.astype(np.int64), j.astype(np.int64)     # the next symbol of the level (forward), or one behind it
        stopped = np.full(len(u), len(self.levels) - 1)
        active = np.arange(len(u))
        back = 0 if forward else 1
        for depth, level in enumerate(self.levels[:-1]):
            if not len(active):
                break
            a, b = u[active], v[active]
            pa, pb = level.parent[a - back], level.parent[b - back]
            # how many symbols each place lies inside its parent, seen in the direction of travel
            if forward:
                inside_a, inside_b = a - level.first[pa], b - level.first[pb]
                rest_a, rest_b = level.first[pa + 1] - a, level.first[pb + 1] - b
            else:
                inside_a, inside_b = level.first[pa + 1] - a, level.first[pb + 1] - b
                rest_a, rest_b = a - level.first[pa], b - level.first[pb]
            up = (inside_a == 0) & (inside_b == 0)
            same = level.symbols[a - back] == level.symbols[b - back]
            # past the rest of a block, or past one symbol of a pair level
            step = np.minimum(rest_a, rest_b) if level.blocks else 1
            step = np.where(~up & same, step, 0)
            parts = ~up & ~same
            if level.blocks:
                parts |= ~up & (rest_a != rest_b)
            a, b = (a + step, b + step) if forward else (a - step, b - step)
            u[active], v[active] = a, b
            stopped[active[parts]] = depth
            go = ~parts
            active, a, b = active[go], a[go], b[go]
            u[active] = level.parent[a - back] + back
            v[active] = level.parent[b - back] + back
        top = self.levels[-1].symbols
        while len(active):
            active = active[top[u[active] - back] == top[v[active] - back]]
            move = 1 if forward else -1
            u[active] += move
            v[active] += move
        for depth in range(len(self.levels) - 2, -1, -1):
            level = self.levels[depth]
            here = np.flatnonzero(stopped > depth)
            if not len(here):
                continue
            a, b = u[here], v[here]
            if forward:
                size_a, size_b = level.first[a + 1] - level.first[a], level.first[b + 1] - level.first[b]
                a, b = level.first[a], level.first[b]
            else:
                size_a, size_b = level.first[a] - level.first[a - 1], level.first[b] - level.first[b - 1]
                a, b = level.first[a], level.first[b]
            same = level.symbols[a - back] == level.symbols[b - back]
            step = np.where(same, np.minimum(size_a, size_b) if level.blocks else 1, 0)
            u[here], v[here] = (a + step, b + step) if forward else (a - step, b - step)
        return u - i if forward else i - u
