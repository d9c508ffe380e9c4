"""Benchmark passages in documents, found through the edit distance of word sequences.

The CGK random walk copies a sequence of words symbol by symbol, standing
still or going on by the toss of a hash of step and symbol; near sequences
give walks that agree in most steps. Some steps of the walk are sampled as an
LSH key, repeatedly, until the modelled recall reaches the target. Items are
looked for by pieces: of an item with few edits one piece has one at most, so
that windows of a piece's size find it. From each hit on, the whole item is
compared to both sides by the exact edit distance.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.llm.bytebpe import slices
from rollcall.llm.words import mix, word_hashes


@dataclass(frozen=True)
class Settings:
    """An item of n words leaks if a passage is within ``floor(share * n)`` word edits of it."""

    share: float = 0.15
    samples: int = 5  # steps of the walk in a key
    keys_per_walk: int = 2
    recall: float = 0.9995  # modelled, of a piece with one edit
    most_walks: int = 96
    item_bytes: int = 16 << 20  # text of items that one scan holds; more items take more scans
    seed: int = 7

    def edits(self, n: int) -> int:
        return math.floor(self.share * n + 1e-9)

    def pieces(self, n: int) -> list[tuple[int, int, int]]:
        """(first word, words, edits) of an item's pieces, one of which has no more edits than that."""
        most = self.edits(n)
        count = most // 2 + 1
        edges = [n * j // count for j in range(count + 1)]
        return [(x, y - x, min(most, 1)) for x, y in zip(edges, edges[1:], strict=False)]


class Walks:
    """Walks and keys of the pieces of one size: as many as the modelled recall asks for."""

    def __init__(self, size: int, edits: int, s: Settings):
        self.edits, self.steps = edits, size + 2
        rng = np.random.default_rng([s.seed, size, edits])
        samples = min(s.samples if edits else 2 * s.samples, self.steps)
        self.walks: list[tuple[np.uint64, list[np.ndarray]]] = []
        model = self._model(size, edits, rng)
        missed = np.ones(len(model[0]), bool)
        while len(self.walks) < s.most_walks and (not self.walks or missed.mean() > 1 - s.recall):
            salt = rng.integers(1 << 63, dtype=np.int64).astype(np.uint64)
            picked = [np.sort(rng.choice(self.steps, samples, replace=False)) for _ in range(s.keys_per_walk)]
            self.walks.append((salt, picked))
            if not edits:
                break
            tosses = coins(salt, self.steps, max(int(z.max()) for z in model[2]) + 1)
            for own, text in zip(*model[1:], strict=True):
                x, y = (walk(z.ravel(), np.arange(len(z)) * z.shape[1], tosses) for z in (own, text))
                for key in picked:
                    missed &= (x[:, key] != y[:, key]).any(axis=1)

    def _model(self, size: int, edits: int, rng: np.random.Generator):
        """Pieces and edited texts as they are compared, with and without the first word, for 2,000 edits of every kind."""
        count = 2000 if edits and size > 1 else 1
        width = size + self.steps + 4
        own, text = np.zeros((count, width), np.int32), np.zeros((count, width), np.int32)
        for i in range(count):
            words = list(range(1, size + 1))
            at, kind = int(rng.integers(size)), i % 3
            new = words[:at] + [[size + 1], [size + 1, words[at]], []][kind] + words[at + 1 :]
            own[i, :size] = words
            own[i, size:] = size + 2
            text[i, : len(new)] = new
            text[i, len(new) :] = size + 3 + np.arange(width - len(new), dtype=np.int32)
        used = size + 3 + width  # every pair has words, and tosses, of its own
        second = np.where((text == 2).any(axis=1), (text == 2).argmax(axis=1), 0)
        shifted = np.stack([np.concatenate([row[k:], np.full(k, size + 3, np.int32)]) for row, k in zip(text, second, strict=True)])
        base = np.arange(count, dtype=np.int32)[:, None] * np.int32(used)
        shorter = np.concatenate([own[:, 1:], own[:, -1:]], axis=1)
        return own, (own + base, shorter + base), (text + base, shifted + base)


def coins(salt: np.uint64, steps: int, symbols: int) -> np.ndarray:
    """Whether the walk goes on, for each step and symbol."""
    with np.errstate(over="ignore"):
        seeds = mix(salt + np.arange(1, steps + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        return (mix(seeds[:, None] ^ mix(np.arange(symbols, dtype=np.uint64) + salt)[None, :]) >> np.uint64(63)).astype(np.int8)


def walk(flat: np.ndarray, at: np.ndarray, tosses: np.ndarray) -> np.ndarray:
    """The symbols that walks from the places ``at`` copy."""
    out, at = np.zeros((len(tosses), len(at)), np.int32), at.astype(np.int64)
    for step, toss in zip(out, tosses, strict=True):
        np.take(flat, at, out=step, mode="clip")
        at += toss[step]
    return out.T


@lru_cache(256)
def walks_of(size: int, edits: int, s: Settings) -> Walks:
    return Walks(size, edits, s)


class Index:
    """The items of one scan, prepared for searching."""

    def __init__(self, items: list[tuple[int, str]], s: Settings, plans: dict[tuple[int, int], Walks] | None = None):
        self.s, self.plans = s, plans or {}
        hashed, counts = word_hashes([text for _, text in items])
        whole: dict[bytes, list[int]] = {}
        ends = np.cumsum(counts)
        for (item, _), n, end in zip(items, counts.tolist(), ends.tolist(), strict=True):
            if n:
                whole.setdefault(hashed[end - n : end].tobytes(), []).append(item)
        self.owners = list(whole.values())
        words = [np.frombuffer(x, np.uint64) for x in whole]
        vocabulary = np.unique(np.concatenate([*words, np.zeros(0, np.uint64)]))
        self.layers = self._layers(vocabulary)
        # Symbol 0: no item has the word. The last symbol closes a text.
        self.close = len(vocabulary) + 1
        self.items = [np.searchsorted(vocabulary, x) + 1 for x in words]
        self.flat = np.concatenate([*self.items, np.zeros(0, np.int64)])
        self.sizes = np.array([len(x) for x in self.items], np.int64)
        self.offsets = np.cumsum(self.sizes) - self.sizes
        self.most = np.array([s.edits(len(x)) for x in self.items], np.int64)
        self.classes = self._classes()

    def _classes(self) -> list[dict]:
        """For the pieces of each size: where they may begin, and tables of their keys."""
        by_size: dict[tuple[int, int], list[tuple[int, int, int]]] = {}
        for i, n in enumerate(self.sizes.tolist()):
            for first, size, edits in self.s.pieces(n):
                # An edit may be at the piece's first word.
                for skip in range(min(edits, size - 1) + 1):
                    by_size.setdefault((size, edits), []).append((i, first + skip, size - skip))
        out = []
        for (size, edits), entries in sorted(by_size.items()):
            plan = self.plans.get((size, edits)) or walks_of(size, edits, self.s)
            item, at, rest = np.array(entries, np.int64).T
            flat = np.full((len(entries), size + plan.steps + 2), self.close, np.int32)
            for row, (i, x, n) in enumerate(entries):
                flat[row, :n] = self.items[i][x : x + n]
            starts = np.zeros(self.close + 1, bool)
            starts[flat[:, 0]] = True
            keys = []
            for salt, picked in plan.walks:
                tosses = coins(salt, plan.steps, self.close + 1)
                tosses[:, self.close] = 0  # the walk stays at the end
                walked = walk(flat.ravel(), np.arange(len(entries)) * flat.shape[1], tosses)
                keys.append((tosses, [(key, *_table(walked.T[key].T)) for key in picked]))
            out.append({"size": size, "edits": edits, "item": item, "at": at, "starts": starts, "keys": keys})
        return out

    @staticmethod
    def _layers(vocabulary: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Tables from a hash's first bits to its word; words that share them go to the next table."""
        out, left = [], np.arange(len(vocabulary))
        while len(left):
            slot = (vocabulary[left] >> np.uint64(46)).astype(np.int64)
            _, first = np.unique(slot, return_index=True)
            held, symbol = np.zeros(1 << 18, np.uint64), np.zeros(1 << 18, np.int32)
            held[slot[first]], symbol[slot[first]] = vocabulary[left[first]], left[first] + 1
            out.append((held, symbol))
            left = np.delete(left, first)
        return out

    def symbols(self, hashed: np.ndarray) -> np.ndarray:
        slot = (hashed >> np.uint64(46)).astype(np.int64)
        out = np.zeros(len(hashed), np.int32)
        for held, symbol in self.layers:
            out = np.where(held[slot] == hashed, symbol[slot], out)
        return out

    def search(self, symbols: np.ndarray) -> list[tuple[int, int, int, int]]:
        """(piece, first word, number of words, edits) of every leak in texts closed by ``close``."""
        # Words of items before each place; the places of a text end with its closing symbol.
        inside = (symbols > 0) & (symbols != self.close)
        known = np.concatenate([[0], np.cumsum(inside, dtype=np.int64)])
        close = np.flatnonzero(symbols == self.close)
        out: list[tuple[int, int, int, int]] = []
        padded = np.concatenate([symbols, np.full(2, self.close, symbols.dtype)]).astype(np.int32)
        for c in self.classes:
            start = np.flatnonzero(c["starts"][symbols])
            # All words of the piece but the edited one, or two if the first was left out.
            until = np.minimum(start + c["size"] + c["edits"], close[np.searchsorted(close, start)])
            start = start[known[until] - known[start] >= c["size"] - 2 * c["edits"]]
            for begin in range(0, len(start), 1 << 15):
                hits = self._hits(padded, c, start[begin : begin + (1 << 15)])
                for rows in _blocks(np.ones(len(hits), np.int64), 1 << 16):
                    place, entry = np.divmod(hits[rows], len(c["item"]))
                    own, at = c["item"][entry], c["at"][entry]
                    text = np.searchsorted(close, place)
                    first = np.where(text > 0, close[text - 1] + 1, 0)
                    # A passage lies between these, and has all words of the item but the edited ones.
                    first = np.maximum(first, place - at - self.most[own])
                    last = np.minimum(close[text], place - at + self.sizes[own] + self.most[own])
                    keep = (known[last] - known[first] >= self.sizes[own] - self.most[own]) & (symbols[place] == self.flat[self.offsets[own] + at])
                    if keep.any():
                        out += self._verify(symbols, place[keep], own[keep], at[keep], 1)
        return out

    @staticmethod
    def _hits(padded: np.ndarray, c: dict, start: np.ndarray) -> np.ndarray:
        """Places and entries of equal keys, as place times the number of entries plus entry."""
        found = [np.zeros(0, np.int64)]
        for tosses, keys in c["keys"]:
            walked = walk(padded, start, tosses)
            for picked, table, order, seen in keys:
                key = _fold(walked.T[picked].T)
                near = np.flatnonzero(seen[key >> np.uint64(46)])
                low, high = np.searchsorted(table, key[near]), np.searchsorted(table, key[near], side="right")
                n = high - low
                hit = np.repeat(low - np.cumsum(n) + n, n) + np.arange(n.sum())
                found.append(np.repeat(start[near], n) * len(order) + order[hit])
        return np.unique(np.concatenate(found))

    def _verify(
        self, symbols: np.ndarray, place: np.ndarray, own: np.ndarray, at: np.ndarray, size: int
    ) -> list[tuple[int, int, int, int]]:
        """The leaks whose ``size`` words from ``at`` on stand at ``place``, by the edits before and behind it."""
        most = self.most[own]
        before, back = self._extend(symbols, place - 1, own, at - 1, at, most, -1)
        live = np.flatnonzero(before <= most)
        place, own, at, most, before, back = (x[live] for x in (place, own, at, most, before, back))
        behind, ahead = self._extend(symbols, place + size, own, at + size, self.sizes[own] - at - size, most - before, 1)
        edits, first, length = before + behind, place - back, back + size + ahead
        leaks = np.flatnonzero(edits <= most)
        return list(zip(*(x[leaks].tolist() for x in (own, first, length, edits)), strict=True))

    def _extend(
        self, symbols: np.ndarray, place: np.ndarray, own: np.ndarray, at: np.ndarray, size: np.ndarray,
        most: np.ndarray, way: int,
    ) -> tuple[np.ndarray, np.ndarray]:
        """The least edits between ``size`` words of the item from ``at`` on and the text from ``place`` on, over all
        ends, and the words of the text taken, in a band around the diagonal; both are read in the direction of ``way``.

        Where more than ``most`` edits are needed, some number above it.
        """
        best, taken = np.full(len(place), FAR), np.zeros(len(place), np.int64)
        flat, offset = self.flat, self.offsets[own] + at
        cells = (size + 1) * (2 * most + 1)
        order = np.argsort(cells, kind="stable")
        for block in _blocks(cells[order]):
            live = order[block]
            band, longest = int(most[live].max()), int(size[live].max())
            columns = np.arange(2 * band + 1, dtype=np.int32) - np.int32(band)
            row = np.where(columns < 0, np.int32(FAR), columns)[None, :].repeat(len(live), 0)
            # Texts do not run on: from a closing symbol on there is nothing.
            span = place[live, None] + way * np.arange(longest + band + 1)
            over = (span < 0) | (span >= len(symbols))
            text = symbols[np.clip(span, 0, len(symbols) - 1)]
            over |= np.cumsum(over | (text == self.close), axis=1) > 0
            room = (~over).sum(axis=1)
            text = np.where(over | (text == 0), -1, text)
            for i in range(longest + 1):
                column = columns + np.int32(i)  # words of the text taken
                if i:
                    word = flat[np.clip(offset[live] + way * (i - 1), 0, len(flat) - 1)]
                    match = (text[:, np.clip(column - 1, 0, text.shape[1] - 1)] == word[:, None]) & (column > 0)
                    new = np.where(column > 0, row + ~match, np.int32(FAR))
                    new[:, :-1] = np.minimum(new[:, :-1], row[:, 1:] + 1)
                    new[:, column < 0] = FAR
                    row = np.minimum.accumulate(new - columns, axis=1) + columns
                    row[:, column < 0] = FAR
                row = np.where(column[None, :] > room[:, None], np.int32(FAR), row)
                ended = np.flatnonzero(size[live] == i)
                if len(ended):
                    least = row[ended].argmin(axis=1)
                    best[live[ended]], taken[live[ended]] = row[ended, least], column[least]
                going = (size[live] > i) & (row.min(axis=1) <= most[live])
                if going.sum() < 0.7 * len(live):
                    live, row, text, room = live[going], row[going], text[going], room[going]
                    if not len(live):
                        break
        return best, taken


FAR = 1 << 20


def _blocks(weights: np.ndarray, most: int = 1 << 21) -> Iterator[slice]:
    """Slices of rows of about ``most`` together; a single row may weigh more."""
    ends = np.cumsum(weights)
    begin = 0
    while begin < len(ends):
        end = int(np.searchsorted(ends, (ends[begin - 1] if begin else 0) + most, side="right"))
        end = max(begin + 1, end)
        yield slice(begin, end)
        begin = end


def _table(samples: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted keys, their rows, and which first bits occur at all."""
    keys = _fold(samples)
    order = np.argsort(keys, kind="stable")
    seen = np.zeros(1 << 18, bool)
    seen[keys >> np.uint64(46)] = True
    return keys[order], order, seen


def _fold(samples: np.ndarray) -> np.ndarray:
    key = np.full(len(samples), 1, np.uint64)
    for column in samples.T:
        key = key * np.uint64(0x9E3779B97F4A7C15) + column.astype(np.uint64)
    return mix(key)


LEAKS = "array<struct<item_id: long, first_word: long, n_words: long, edits: long>>"


def mark_leaks(docs: DataFrame, items: DataFrame, s: Settings = Settings()) -> DataFrame:
    """Adds ``leaks`` to ``docs``: the items in each text, each once with its best passage.

    Null, empty and wordless texts have none, and such items are found
    nowhere. Items of equal words are found together; so are repeated ids.
    Very short items are found where all their words stand. A column of the
    name ``leaks`` is replaced; all rows and other columns are kept.
    """
    own = items.where(F.col("text").isNotNull()).select(F.col("item_id").cast("long").alias("item_id"), "text")
    size = own.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    scans = max(1, math.ceil(size / s.item_bytes))
    out = docs.withColumn("leaks", F.array().cast(LEAKS))
    for scan in range(scans):
        part = own.where(F.pmod(F.xxhash64("text"), F.lit(scans)) == scan).distinct()
        held = sorted(((r["item_id"], r["text"]) for r in part.collect()), key=lambda r: (r[0] is None, r))
        out = _scan(out, held, s)
    return out


def _scan(docs: DataFrame, held: list[tuple[int, str]], s: Settings) -> DataFrame:
    counts = word_hashes([text for _, text in held])[1] if held else []
    plans = {x: walks_of(*x, s) for x in {(size, edits) for n in set(counts) for _, size, edits in s.pieces(int(n)) if size}}
    shared = docs.sparkSession.sparkContext.broadcast((held, plans))  # item_bytes and some numbers for each size at most
    names = [c for c in docs.columns if c != "leaks"]
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*names).schema)
    fields = ("item_id", "first_word", "n_words", "edits")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(shared.value[0], s, shared.value[1])
        for batch in batches:
            texts = [x or "" for x in batch.column("text").to_pylist()]
            leaks = batch.column("leaks").to_pylist()
            for begin, end in slices([len(x) for x in texts]) if index.items else ():
                hashed, counts = word_hashes(texts[begin:end])
                closes = np.cumsum(counts + 1) - 1
                symbols = np.full(len(hashed) + len(counts), index.close, np.int32)
                inside = np.ones(len(symbols), bool)
                inside[closes] = False
                symbols[inside] = index.symbols(hashed)
                best: dict[tuple[int, int], tuple] = {}
                for piece, place, length, edits in index.search(symbols):
                    row = int(np.searchsorted(closes, place))
                    first = place - (int(closes[row - 1]) + 1 if row else 0)
                    for item in index.owners[piece]:
                        new = (edits, first, length)
                        best[row, item] = min(best.get((row, item), new), new)
                for (row, item), (edits, first, length) in sorted(best.items(), key=lambda x: (x[0][0], x[0][1] is None, x[0][1])):
                    leaks[begin + row].append(dict(zip(fields, (item, first, length, edits), strict=True)))
            kind = pa.list_(pa.struct([(f, pa.int64()) for f in fields]))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(leaks, kind)], names=[*names, "leaks"])

    return docs.select(*names, "leaks").mapInArrow(scan, f"{kinds}, leaks {LEAKS}")
