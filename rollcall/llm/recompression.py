"""Run-length grammars by recompression, and longest common extensions on them.

A sequence is compressed level by level: first blocks of one symbol become one
symbol, then pairs do whose members lie on different sides of a split of the
symbols. Equal stretches are parsed equally but for their ends, so that two
places are compared by going up from them and down again.
"""

from __future__ import annotations

import numpy as np

from rollcall.llm.words import mix

SPLITS = 4  # splits of the symbols tried on each level
GOLDEN = 0x9E3779B97F4A7C15


class Level:
    """The symbols of a level; ``up`` and ``down`` tell which of them begin together with one of the next level."""

    def __init__(self, symbols: np.ndarray):
        self.symbols = symbols
        n = len(symbols)
        edge = np.flatnonzero(symbols[1:] != symbols[:-1]) + 1
        self.begin, end = np.concatenate([[0], edge]), np.concatenate([edge, [n]])
        self.size = end - self.begin
        self.ahead = self.behind = self.up = self.down = None
        if len(self.begin) < n:
            # How many equal symbols stand from a place on, and right before it.
            self.ahead = np.repeat(end, self.size) - np.arange(n)
            self.behind = np.arange(n) - np.repeat(self.begin, self.size)
            self.behind[edge] = self.size[:-1]

    def link(self, begin: np.ndarray) -> None:
        """``begin``: where the next level's symbols begin."""
        self.down = np.concatenate([begin, [len(self.symbols)]])
        self.up = np.full(len(self.symbols) + 1, -1, np.int64)
        self.up[self.down] = np.arange(len(self.down))

    def advance(self, a: np.ndarray, b: np.ndarray, who: np.ndarray, forward: bool) -> np.ndarray:
        """Moves the places of ``who`` over equal symbols; True for those that moved."""
        x, y, back = a[who], b[who], 0 if forward else 1
        same = self.symbols[x - back] == self.symbols[y - back]
        if self.ahead is None:
            step = np.int64(1)
        else:
            count = self.ahead if forward else self.behind
            step = np.minimum(count[x[same]], count[y[same]])
        step = step if forward else -step
        a[who[same]] += step
        b[who[same]] += step
        return same


class Grammar:
    """The levels above ``symbols``, of which the first and the last stand once.

    Symbols in the range ``ends`` stand once each and are never joined: they
    part the texts of a batch.
    """

    def __init__(self, symbols: np.ndarray, ends: tuple[int, int]):
        self.levels = [Level(symbols.astype(np.int64))]
        fresh, seed = int(symbols.max()) + 1, 0
        while True:
            level = self.levels[-1]
            if level.ahead is not None:
                level.link(level.begin)
                fresh = self._add(level.symbols[level.begin], level.size, level.size > 1, fresh)
                level = self.levels[-1]
            seed += SPLITS
            begin = self._pairs(level.symbols, ends, seed)
            if begin is None:
                return
            level.link(begin)
            right = level.symbols[np.minimum(begin + 1, len(level.symbols) - 1)]
            fresh = self._add(level.symbols[begin], right, np.diff(level.down) > 1, fresh)

    def _add(self, left: np.ndarray, right: np.ndarray, joined: np.ndarray, fresh: int) -> int:
        """One more level: equal (left, right) get an equal new symbol, what is not joined keeps its own."""
        names, place = np.unique(left[joined] * (int(right.max()) + 1) + right[joined], return_inverse=True)
        symbols = left.copy()
        symbols[joined] = fresh + place
        self.levels.append(Level(symbols))
        return fresh + len(names)

    @staticmethod
    def _pairs(symbols: np.ndarray, ends: tuple[int, int], seed: int) -> np.ndarray | None:
        """Where symbols begin once pairs are joined by the best of some splits; None if none joins any."""
        plain = (symbols < ends[0]) | (symbols >= ends[1])
        both, best = plain[:-1] & plain[1:], np.zeros(len(symbols) - 1, bool)
        for at in range(seed, seed + SPLITS):
            side = (mix(symbols.astype(np.uint64) + np.uint64(at * GOLDEN % (1 << 64))) & np.uint64(1)).astype(bool)
            joined = side[:-1] & ~side[1:] & both
            if np.count_nonzero(joined) > np.count_nonzero(best):
                best = joined
        return np.flatnonzero(np.concatenate([[True], ~best])) if best.any() else None

    def extension(self, x: np.ndarray, y: np.ndarray, forward: bool) -> np.ndarray:
        """How many symbols are equal from places x and y (x < y) on, or right before them."""
        a, b = x.astype(np.int64), y.astype(np.int64)
        rising, peaks = np.arange(len(a)), []
        for level in self.levels:
            stuck, climbed = [], []
            while len(rising):
                if level.up is not None:
                    i, j = level.up[a[rising]], level.up[b[rising]]
                    up = (i >= 0) & (j >= 0)
                    a[rising[up]], b[rising[up]] = i[up], j[up]
                    climbed.append(rising[up])
                    rising = rising[~up]
                moved = level.advance(a, b, rising, forward)
                stuck.append(rising[~moved])
                rising = rising[moved]
            peaks.append(np.concatenate([*stuck, rising]))
            rising = np.concatenate([*climbed, rising])
        falling = np.zeros(0, np.int64)
        for level, own in zip(reversed(self.levels), reversed(peaks), strict=True):
            if len(falling):
                a[falling], b[falling] = level.down[a[falling]], level.down[b[falling]]
                moving = falling
                while len(moving):
                    moving = moving[level.advance(a, b, moving, forward)]
            falling = np.concatenate([falling, own])
        return np.abs(a - x)
