"""Ids of a byte-level BPE vocabulary for many texts at once.

The split into pretokens is done over arrays of code points; each distinct
pretoken is merged once by the installed library and remembered, so that
repeated words cost a table look-up only.
"""

from __future__ import annotations

import base64
import sys
import unicodedata
from functools import lru_cache

import numpy as np

SPACE, LETTER, NUMBER, OTHER, BREAK = range(5)
# Contraction endings of the vocabulary's pattern: fixed values.
ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")


@lru_cache(1)
def kinds() -> np.ndarray:
    """The kind of every code point, as the split pattern sees it."""
    table = np.full(sys.maxunicode + 2, OTHER, dtype=np.uint8)
    for code in range(sys.maxunicode + 1):
        first = unicodedata.category(chr(code))[0]
        if first in "LN":
            table[code] = LETTER if first == "L" else NUMBER
    # White_Space of the Unicode standard: fixed values.
    spaces = [9, 10, 11, 12, 13, 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
    table[spaces] = SPACE
    table[sys.maxunicode + 1] = BREAK
    return table


def starts_of(codes: np.ndarray) -> np.ndarray:
    """Where pretokens begin; texts are parted by the code behind the last code point."""
    kind = kinds()[codes]
    start = np.ones(len(codes), dtype=bool)
    start[1:] = kind[1:] != kind[:-1]
    # The last white space before a word goes with the word if it is a blank, else stands alone.
    word = np.flatnonzero((kind[1:] != kind[:-1]) & (kind[:-1] == SPACE) & (kind[1:] != BREAK)) + 1
    start[word - 1] = True
    start[word] = codes[word - 1] != 32
    start |= kind == BREAK
    quote = np.flatnonzero(start[:-2] & (codes[:-2] == 39) & (kind[1:-1] == LETTER))
    if len(quote):
        after, next_after = codes[quote + 1], codes[quote + 2]
        size = np.zeros(len(quote), dtype=np.int64)
        for ending in ENDINGS:
            hit = after == ord(ending[0])
            if len(ending) == 2:
                hit &= next_after == ord(ending[1])
            size[hit & (size == 0)] = len(ending)
        quote, size = quote[size > 0], size[size > 0]
        start[quote + 1] = False
        long = quote[size == 2]
        start[long + 2] = False
        start[quote + size + 1] = True
    return start


class ByteBpe:
    """Encodes lists of texts; remembers at most ``most`` pretokens at a time."""

    def __init__(self, ranks_path: str, pattern: str, most: int = 1 << 20):
        import tiktoken

        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.library = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.most = most
        self.powers = np.ones(1 << 12, dtype=np.uint64)
        np.multiply.accumulate(np.full(len(self.powers) - 1, 0x9E3779B97F4A7C15, np.uint64), out=self.powers[1:])
        self.forget()

    def forget(self) -> None:
        self.slots = 1 << 12
        self.keys = np.zeros(self.slots, np.uint64)
        self.places = np.zeros(self.slots, np.int32)
        self.known = 0
        self.ids = np.zeros(1 << 12, np.uint16)
        self.ends = np.zeros(1 << 11, np.int64)

    def _slot(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The slot of each key and whether it holds the key (else the slot is free)."""
        slot = (keys >> np.uint64(20)) & np.uint64(self.slots - 1)
        found = self.keys[slot] == keys
        left = np.flatnonzero(~found)
        while len(left):
            there = self.keys[slot[left]]
            hit = there == keys[left]
            found[left[hit]] = True
            left = left[~hit & (there != 0)]
            slot[left] = (slot[left] + np.uint64(1)) & np.uint64(self.slots - 1)
        return slot, found

    def _grow(self) -> None:
        held = self.keys != 0
        keys, places = self.keys[held], self.places[held]
        self.slots *= 4
        self.keys, self.places = np.zeros(self.slots, np.uint64), np.zeros(self.slots, np.int32)
        self._put(keys, places)

    def _put(self, keys: np.ndarray, places: np.ndarray) -> None:
        left = np.arange(len(keys))
        while len(left):
            slot, _ = self._slot(keys[left])
            _, first = np.unique(slot, return_index=True)
            self.keys[slot[first]] = keys[left[first]]
            self.places[slot[first]] = places[left[first]]
            left = np.delete(left, first)

    def _learn(self, keys: np.ndarray, texts: list[str]) -> None:
        encoded = [self.library.encode_ordinary(x) for x in texts]
        sizes = np.fromiter(map(len, encoded), np.int64, len(encoded))
        flat = np.fromiter((i for x in encoded for i in x), np.uint16, int(sizes.sum()))
        begin = int(self.ends[self.known - 1]) if self.known else 0
        while begin + len(flat) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        while self.known + len(texts) > len(self.ends):
            self.ends = np.concatenate([self.ends, np.zeros_like(self.ends)])
        self.ids[begin : begin + len(flat)] = flat
        self.ends[self.known : self.known + len(texts)] = begin + np.cumsum(sizes)
        places = np.arange(self.known, self.known + len(texts), dtype=np.int32)
        self.known += len(texts)
        while self.known * 2 > self.slots:
            self._grow()
        self._put(keys, places)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after the other (uint16), and where each text's ids end."""
        if self.known > self.most:
            self.forget()
        raw = [x.encode("utf-32-le", "replace") + (sys.maxunicode + 1).to_bytes(4, "little") for x in texts]
        codes = np.frombuffer(b"".join(raw), dtype=np.uint32)
        if not len(codes):
            return np.zeros(0, np.uint16), np.zeros(0, np.int64)
        begin = np.flatnonzero(starts_of(codes))
        size = np.diff(begin, append=len(codes))
        place = np.arange(len(codes), dtype=np.int32) - np.repeat(begin.astype(np.int32), size)
        mixed = (codes.astype(np.uint64) + np.uint64(0x1F83D9AB)) * np.uint64(0xD6E8FEB86659FD93)
        mixed ^= mixed >> np.uint64(32)
        mixed *= self.powers[place & (len(self.powers) - 1)]
        keys = np.add.reduceat(mixed, begin)
        keys ^= size.astype(np.uint64) * np.uint64(0xA24BAED4963EE407)
        keys ^= keys >> np.uint64(29)
        keys *= np.uint64(0xBF58476D1CE4E5B9)
        keys |= np.uint64(1)
        real = codes[begin] != sys.maxunicode + 1
        slot, found = self._slot(keys)
        new = np.flatnonzero(~found & real)
        if len(new):
            fresh, first = np.unique(keys[new], return_index=True)
            at = new[first]
            words = [
                codes[b : b + s].tobytes().decode("utf-32-le")
                for b, s in zip(begin[at].tolist(), size[at].tolist(), strict=True)
            ]
            self._learn(fresh, words)
            slot, found = self._slot(keys)
        index = self.places[slot[real]]
        end = self.ends[index]
        start = np.where(index > 0, self.ends[index - 1], 0)
        count = end - start
        total = np.cumsum(count)
        out = self.ids[np.arange(int(total[-1]) if len(total) else 0) + np.repeat(start - (total - count), count)]
        until = np.cumsum(real)[~real]  # pretokens up to each text's end
        return out, np.concatenate([[0], total])[until]


@lru_cache(2)
def shared_encoder(ranks_path: str, pattern: str) -> ByteBpe:
    """One encoder for each Python worker, so that its memory of words is kept."""
    return ByteBpe(ranks_path, pattern)


def slices(sizes: list[int], most: int = 1 << 20):
    """Runs of neighbouring texts with at most ``most`` characters (or one text)."""
    begin, total = 0, 0
    for i, size in enumerate(sizes):
        if i > begin and total + size > most:
            yield begin, i
            begin, total = i, 0
        total += size
    if begin < len(sizes):
        yield begin, len(sizes)
