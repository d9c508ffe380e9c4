"""Periodic runs of words, found on grammars made by recompression.

Two consecutive copies of a period hold a point of the grid of its multiples,
so points one period apart with equal words are all the candidates there are;
how far each reaches is asked of the grammar.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.llm.recompression import Grammar

SPACES = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
BATCH_BYTES = 1 << 21
PAIRS = 1 << 20  # candidates looked at together
RUN = "struct<start: bigint, length: bigint, period: bigint>"


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of all texts, and the number of words of each (0 for null). Words lie between ASCII white space."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    _, places, data = texts.buffers()
    edges = np.frombuffer(places, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    letters = np.frombuffer(data or b"", np.uint8)[edges[0] : edges[-1]]
    edges = edges - edges[0]
    inside = ~SPACES[letters]
    fresh = np.ones(len(letters) + 1, bool)
    fresh[1:-1] = ~inside[:-1]
    fresh[edges] = True
    begin = np.flatnonzero(inside & fresh[:-1])
    counts = np.diff(np.searchsorted(begin, edges))
    kept = np.cumsum(inside)
    offsets = np.concatenate([kept[begin] - 1, kept[-1:] if len(kept) else [0]]).astype(np.int64)
    words = letters[inside]
    return pa.LargeStringArray.from_buffers(len(begin), pa.py_buffer(offsets), pa.py_buffer(words)), counts


class Texts:
    """Texts of a batch side by side, the longest first, parted by symbols that stand once."""

    def __init__(self, words: np.ndarray, counts: np.ndarray, which: np.ndarray, least: int):
        self.least = least
        self.order = which[np.argsort(-counts[which], kind="stable")]
        self.counts = counts[self.order]
        begin = np.cumsum(counts) - counts
        self.begin = np.cumsum(self.counts + 1) - self.counts
        n = len(self.order)
        self.ends = (int(words.max(initial=-1)) + 1, int(words.max(initial=-1)) + n + 2)
        size = int(self.counts.sum()) + n + 1
        self.symbols = np.empty(size, np.int64)
        parted = np.concatenate([[0], self.begin + self.counts])
        self.symbols[parted] = np.arange(self.ends[0], self.ends[1])
        inside = np.ones(size, bool)
        inside[parted] = False
        at = np.arange(int(self.counts.sum())) - np.repeat(np.cumsum(self.counts) - self.counts, self.counts)
        self.symbols[inside] = words[at + np.repeat(begin[self.order], self.counts)]

    def candidates(self):
        """(i, period) for grid points whose words stand again a period later, six in a row; periods rise."""
        least = self.least
        longest = int(self.counts.max(initial=0))
        periods = np.arange(1, longest // 2 + 1) if longest >= least else np.zeros(0, np.int64)
        # A run has that many words in a row that stand again one period later.
        steps = np.maximum(periods, least - periods)
        texts = np.searchsorted(-self.counts, -np.maximum(least, 2 * periods), side="right")
        reach = np.concatenate([[0], self.begin + self.counts])[texts]
        grid = np.maximum(0, (reach - periods - 1) // steps + 1)
        done = np.cumsum(grid)
        at = 0
        while at < len(periods):
            to = max(at + 1, int(np.searchsorted(done, (done[at - 1] if at else 0) + PAIRS, side="right")))
            size = grid[at:to]
            period = np.repeat(periods[at:to], size)
            k = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
            i = k * np.repeat(steps[at:to], size)
            yield self._standing(i, period, min(6, (least + 1) // 2))
            at = to

    def _standing(self, i: np.ndarray, period: np.ndarray, row: int) -> tuple[np.ndarray, np.ndarray]:
        """Those with ``row`` words in a row, around i, that stand again a period later."""
        s = self.symbols
        held = s[i] == s[i + period]
        i, period = i[held], period[held]
        count, open_after, open_before = np.ones(len(i), np.int64), np.ones(len(i), bool), np.ones(len(i), bool)
        for d in range(1, row):
            # Symbols that stand once end every row of words before the first or last place is passed.
            ahead, back = np.minimum(i + d, len(s) - 1), np.maximum(i - d, 0)
            open_after &= s[ahead] == s[np.minimum(ahead + period, len(s) - 1)]
            open_before &= s[back] == s[back + period]
            count += open_after
            count += open_before
            alive = open_after | open_before | (count >= row)
            if not alive.all():
                i, period, count, open_after, open_before = (x[alive] for x in (i, period, count, open_after, open_before))
        return i[count >= row], period[count >= row]


def runs(words: np.ndarray, counts: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, start, length, period) of all runs, by text, start and period.

    ``words`` are the numbered words of all texts, ``counts`` how many each has.
    """
    none = np.zeros(0, np.int64)
    every = Texts(words, counts, np.flatnonzero(counts >= least), least)
    asked = np.zeros(len(counts), bool)
    for i, _ in every.candidates():
        asked[every.order[np.searchsorted(every.begin, i, side="right") - 1]] = True
    if not asked.any():
        return none, none, none, none
    texts = Texts(words, counts, np.flatnonzero(asked), least)
    grammar = Grammar(texts.symbols, texts.ends)
    # The run known at each place that reaches furthest, to leave out its multiples and further points.
    until, known = np.zeros(len(texts.symbols), np.int64), np.ones(len(texts.symbols), np.int64)
    found = []
    for i, period in texts.candidates():
        new = (i + period >= until[i]) | (period % known[i] != 0)
        i, period = i[new], period[new]
        start = i - grammar.extension(i, i + period, forward=False)
        end = i + period + grammar.extension(i, i + period, forward=True)
        long = end - start >= np.maximum(least, 2 * period)
        if not long.any():
            continue
        rows = np.unique(np.stack([start[long], end[long], period[long]], axis=1), axis=0)
        # Multiples of the smallest period reach as far as it does.
        smallest = np.concatenate([[True], (rows[1:, :2] != rows[:-1, :2]).any(axis=1)])
        found.append(rows[smallest])
        for s, e, p in found[-1].tolist():
            further = until[s:e] < e
            until[s:e][further], known[s:e][further] = e, p
    if not found:
        return none, none, none, none
    rows = np.unique(np.concatenate(found), axis=0)
    rows = rows[np.concatenate([[True], (rows[1:, :2] != rows[:-1, :2]).any(axis=1)])]
    place = np.searchsorted(texts.begin, rows[:, 0], side="right") - 1
    text, start = texts.order[place], rows[:, 0] - texts.begin[place]
    order = np.lexsort((rows[:, 2], start, text))
    return text[order], start[order], (rows[:, 1] - rows[:, 0])[order], rows[order, 2]


def _collapsed(texts: pa.Array, least: int) -> tuple[pa.Array, pa.Array, pa.Array]:
    words, counts = split_words(texts)
    numbers = words.dictionary_encode().indices.to_numpy().astype(np.int64)
    text, start, length, period = runs(numbers, counts, least)
    begin = np.cumsum(counts) - counts
    change = np.zeros(len(numbers) + 1, np.int64)
    np.add.at(change, begin[text] + start + period, 1)
    np.add.at(change, begin[text] + start + length, -1)
    keep = np.cumsum(change)[:-1] == 0
    places = np.concatenate([[0], np.cumsum(keep)])[np.concatenate([begin, [len(numbers)]])]
    kept = pa.ListArray.from_arrays(pa.array(places, pa.int32()), words.filter(pa.array(keep)))
    rows = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (start, length, period)], ["start", "length", "period"])
    edges = np.searchsorted(text, np.arange(len(counts) + 1)).astype(np.int32)
    found = pa.ListArray.from_arrays(pa.array(edges), rows)
    return pa.array(counts, pa.int64()), found, pc.binary_join(kept, pa.scalar(" ", pa.large_string())).cast(pa.string())


def collapse_runs(docs: DataFrame, least: int = 12, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """``docs`` with ``n_words``, ``runs`` and ``collapsed``, its text without repetitions.

    A run is a stretch of consecutive words with smallest period q, of at least
    ``least`` (2 or more) and 2 * q words, that no neighbouring word extends;
    ``runs`` lists (start, length, period), by start and period, words counted
    from 0. ``collapsed`` has the words that no run holds beyond its first q,
    joined by one space. Words lie between ASCII white space. A null or empty
    text has 0 words, no runs and an empty ``collapsed``. All rows and columns
    are kept, but those with the new names, which are replaced. Texts are worked
    on in groups of about ``batch_bytes``; memory grows with the longest text.
    """
    if least < 2:
        raise ValueError("a run has two words at least")
    added = ("n_words", "runs", "collapsed")
    kept = [c for c in docs.columns if c.lower() not in added]
    text_at = [c.lower() for c in kept].index("text")

    def work(batches):
        for batch in batches:
            table = pa.Table.from_batches([batch])
            texts = table.column(text_at).combine_chunks()
            size = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            group = (np.cumsum(size) - size) // batch_bytes
            cuts = [0, *(np.flatnonzero(group[1:] != group[:-1]) + 1).tolist(), len(texts)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                if a < b:
                    columns = table.slice(a, b - a).combine_chunks().columns
                    yield pa.RecordBatch.from_arrays(
                        [*(c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in columns), *_collapsed(texts.slice(a, b - a), least)],
                        names=names,
                    )

    names = [*kept, *added]
    picked = docs.select(*(F.col(f"`{c}`") for c in kept))
    schema = picked.limit(0).select(
        "*", F.lit(0).cast("bigint").alias("n_words"), F.array().cast(f"array<{RUN}>").alias("runs"), F.lit("").alias("collapsed")
    ).schema
    return picked.mapInArrow(work, schema)
