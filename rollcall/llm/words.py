"""Hashes of the words of many texts at once."""

from __future__ import annotations

import numpy as np

_WORDS: list[np.ndarray] = []
_MIX = 0x9E3779B97F4A7C15


def _word_characters() -> np.ndarray:
    if not _WORDS:
        table = np.array([chr(i).isalnum() for i in range(0x110000)])
        table[ord("_")] = True
        _WORDS.append(table)
    return _WORDS[0]


def mix(x: np.ndarray) -> np.ndarray:
    """Scrambles 64-bit numbers; a one-to-one map."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _times(n: int) -> np.uint64:
    return np.uint64(n * _MIX % (1 << 64))


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """A hash of every word in lower case, and the number of words of each text.

    Words are runs of letters, digits and underscores.
    """
    texts = [x.lower() for x in texts]
    codes = np.frombuffer("\n".join([*texts, ""]).encode("utf-32-le", "replace"), np.uint32)
    inside = np.zeros(len(codes) + 2, dtype=bool)
    inside[1:-1] = _word_characters()[codes]
    begin = np.flatnonzero(inside[1:-1] & ~inside[:-2])
    end = np.flatnonzero(inside[1:-1] & ~inside[2:]) + 1
    size = end - begin
    if not len(begin):
        return np.zeros(0, np.uint64), np.zeros(len(texts), np.int64)
    total = np.cumsum(size)
    place = np.arange(int(total[-1])) - np.repeat(total - size, size)
    letters = codes[place + np.repeat(begin, size)].astype(np.uint64)
    values = mix((letters << np.uint64(32)) + place.astype(np.uint64) + np.uint64(1))
    hashed = mix(np.add.reduceat(values, total - size) + size.astype(np.uint64) * np.uint64(_MIX))
    edges = np.cumsum([len(x) + 1 for x in texts])
    return hashed, np.diff(np.searchsorted(begin, edges), prepend=0)


def shingles(hashed: np.ndarray, counts: np.ndarray, size: int) -> list[np.ndarray]:
    """Each text's distinct runs of ``size`` words as sorted hashes.

    A text of fewer words is one run by itself; a text without words has none.
    """
    if len(hashed) >= size:
        runs = np.zeros(len(hashed) - size + 1, np.uint64)
        for i in range(size):
            runs = mix(runs + hashed[i : i + len(runs)] + _times(i + 1))
    out, at = [], 0
    for n in counts.tolist():
        if n >= size:
            out.append(np.unique(runs[at : at + n - size + 1]))
        elif n:
            one = np.zeros(1, np.uint64)
            for i in range(n):
                one = mix(one + hashed[at + i : at + i + 1] + _times(i + 1))
            out.append(one ^ np.uint64(n))
        else:
            out.append(np.zeros(0, np.uint64))
        at += n
    return out


def signatures(sets: list[np.ndarray], size: int) -> np.ndarray:
    """MinHash signatures, one row of ``size`` 32-bit values for each set (zeros if it is empty)."""
    out = np.zeros((len(sets), size), np.int32)
    held = [i for i, x in enumerate(sets) if len(x)]
    if held:
        flat = np.concatenate([sets[i] for i in held])
        begins = np.cumsum([0, *(len(sets[i]) for i in held[:-1])])
        odd = mix(np.arange(1, size + 1, dtype=np.uint64) * np.uint64(_MIX)) | np.uint64(1)
        for j in range(size):
            least = np.minimum.reduceat(((flat ^ odd[j]) * odd[j]), begins)
            out[held, j] = (mix(least) >> np.uint64(32)).astype(np.uint32).view(np.int32)
    return out
