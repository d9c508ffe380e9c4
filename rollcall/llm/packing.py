"""Best-fit packing of tokenised documents into sequences of fixed length.

Pieces come in the order of a hash, a few hundred at a time, the larger ones of
these first; each goes to the open bin it fills best. Few bins are open at a
time: when one more is needed, the fullest closes.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator, Mapping
from types import MappingProxyType

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.llm.bytebpe import shared_encoder, slices
from rollcall.llm.common import row_key
from rollcall.session import staged

CAPACITY = 2048
OPEN_BINS = 256
# Pieces that are looked at together, and the width of the classes of length they are taken by.
AHEAD = 512
CLASS_WIDTH = 128
# Pieces of one packing group; each group ends with the bins open then.
GROUP_ROWS = 65536

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PACKED = f"{PIECES}, sequence_id long, offset long"


def added_tokens(tokenizer_path: str) -> dict[str, int]:
    """The added tokens of a tokenizer file, by their texts."""
    with open(tokenizer_path, encoding="utf-8") as file:
        return {x["content"]: x["id"] for x in json.load(file)["added_tokens"]}


def with_added(encode, texts: list[str], added: Mapping[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts and where each text's end: added tokens first, ``encode`` for what is between them."""
    if not any(token in text for token in added for text in texts):
        return encode(texts)
    split = re.compile("(" + "|".join(map(re.escape, sorted(added, key=len, reverse=True))) + ")")
    parts = [split.split(x) for x in texts]  # texts and added tokens by turns
    ids, ends = encode([x for own in parts for x in own[::2]])
    own_ids, at, out, until = np.split(ids, ends[:-1]), 0, [], []
    for own in parts:
        for i, part in enumerate(own):
            out.append(np.array([added[part]], ids.dtype) if i % 2 else own_ids[at + i // 2])
        at += len(own) // 2 + 1
        until.append(sum(map(len, out[-len(own):])))
    return np.concatenate(out), np.cumsum(until)


def pieces(
    docs: DataFrame, ranks_path: str, pattern: str, capacity: int = CAPACITY, with_ids: bool = False,
    added: Mapping[str, int] = MappingProxyType({}),
) -> DataFrame:
    """One row per piece of each document's ids, the closing id 0 included.

    Null texts count as empty (one piece, the closing id alone). Only documents
    longer than ``capacity`` are cut: all pieces are full but the first.
    Repeated rows are packed as often as they occur; ``doc_id`` may be null.
    ``with_ids`` adds the ids themselves. Texts of ``added`` tokens become their
    ids, wherever they stand.
    """
    extra, special = ", ids array<int>" if with_ids else "", dict(added)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = shared_encoder(ranks_path, pattern)
        for batch in batches:
            names = batch.column("doc_id").to_pylist()
            texts = [x or "" for x in batch.column("text").to_pylist()]
            for begin, end in slices([len(x) for x in texts]):
                ids, ends = with_added(encoder.encode, texts[begin:end], special)
                out = []
                at = 0
                for name, until in zip(names[begin:end], ends.tolist(), strict=True):
                    own = np.append(ids[at:until], 0).astype("<u4")
                    at = until
                    first = (len(own) - 1) % capacity + 1
                    edges = [0, *range(first, len(own) + 1, capacity)]
                    for piece, (x, y) in enumerate(zip(edges, edges[1:], strict=False)):
                        part = own[x:y]
                        row = (name, piece, x, y - x, zlib.crc32(part.tobytes()))
                        out.append((*row, part.astype(np.int32)) if with_ids else row)
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())]
                labels = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
                columns = list(zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, type=k) for c, k in zip(columns, kinds, strict=False)], names=labels[: len(columns)]
                )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(cut, PIECES + extra)


class OpenBins:
    """A fixed number of open bins, found by free space through the bits of one integer."""

    def __init__(self, capacity: int, most: int):
        self.capacity, self.most = capacity, most
        self.by_space: dict[int, list[int]] = {}
        self.bits = 0
        self.count = 0
        self.made = 0

    def _take(self, space: int) -> int:
        held = self.by_space[space]
        number = held.pop()
        if not held:
            self.bits ^= 1 << space
        self.count -= 1
        return number

    def place(self, size: int) -> tuple[int, int]:
        """The bin of the next piece and the place in it: the open bin it fills best, else a new one."""
        fitting = self.bits >> size
        if fitting:
            space = size + (fitting & -fitting).bit_length() - 1
            number = self._take(space)
        else:
            if self.count == self.most:
                self._take((self.bits & -self.bits).bit_length() - 1)  # the fullest closes
            space, number = self.capacity, self.made
            self.made += 1
        left = space - size
        if left:
            self.by_space.setdefault(left, []).append(number)
            self.bits |= 1 << left
            self.count += 1
        return number, self.capacity - space


def best_fit(
    sized: DataFrame, capacity: int = CAPACITY, open_bins: int = OPEN_BINS, group_rows: int = GROUP_ROWS, ahead: int = AHEAD
) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to rows with a ``length`` of 1 to ``capacity``.

    Rows are dealt by ``_deal`` (a hash of the row's number) to groups of about
    ``group_rows``; each is packed on its own, in an order that depends on the
    rows alone, so a task that runs again gives the same numbers. A task streams
    its groups and holds ``ahead`` rows and ``open_bins`` bins. Full pieces take
    no part. An empty frame gives none.
    """
    whole = sized.where(F.col("length") == capacity)
    rest = sized.where(F.col("length") < capacity)
    names = [c for c in sized.columns if c != "_deal"]
    groups = max(1, -(-rest.count() // group_rows))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, bins, held = None, None, None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            held = rows if held is None else pa.concat_tables([held, rows])
            while held.num_rows >= ahead:
                first = held.slice(0, ahead)
                held = held.slice(ahead)
                group, bins, done = place(first, group, bins)
                yield from done.to_batches()
        if held is not None and held.num_rows:
            yield from place(held, group, bins)[2].to_batches()

    def place(rows: pa.Table, group, bins):
        """Places some rows, which may be of several groups, one after the other."""
        owner = rows.column("_group").to_numpy()
        size = rows.column("length").to_numpy()
        order = np.lexsort((-(size // CLASS_WIDTH), owner))
        sequence, offset = np.zeros(len(order), np.int64), np.zeros(len(order), np.int64)
        for i in order.tolist():
            if owner[i] != group:
                group, bins = int(owner[i]), OpenBins(capacity, open_bins)
            number, offset[i] = bins.place(int(size[i]))
            sequence[i] = (group << 32) + number
        out = rows.select(names).append_column("sequence_id", pa.array(sequence))
        return group, bins, out.append_column("offset", pa.array(offset)).combine_chunks()

    kinds = {f.name: f.dataType.simpleString() for f in sized.schema}
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in names) + ", sequence_id long, offset long"
    packed = (
        rest.withColumn("_group", F.pmod("_deal", F.lit(groups)).cast("long"))
        .repartition("_group")
        .sortWithinPartitions("_group", "_deal", "doc_id", "piece")
        .mapInArrow(pack, schema)
    )
    alone = whole.select(
        *names,
        (F.monotonically_increasing_id() + F.lit(1 << 62)).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
    )
    return packed.unionByName(alone)


def pack_documents(
    docs: DataFrame, ranks_path: str, pattern: str, capacity: int = CAPACITY, open_bins: int = OPEN_BINS,
    group_rows: int = GROUP_ROWS, added: Mapping[str, int] = MappingProxyType({}),
) -> DataFrame:
    """Documents cut into pieces and packed; see ``pieces`` and ``best_fit``."""
    cut = pieces(docs, ranks_path, pattern, capacity, added=added).withColumn("_deal", row_key())
    return best_fit(staged(cut, "pieces"), capacity, open_bins, group_rows)
