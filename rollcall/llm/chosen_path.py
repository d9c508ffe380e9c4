"""Similarity join of documents by the Jaccard similarity of their word n-grams.

Chosen-path join over MinHash signatures: a node's members are split by the
values of a few coordinates that the node's own hash chooses, level by level,
until a node is small. Small nodes are compared exactly, all pairs; runs with
other choices are repeated until the wanted share of similar pairs is found.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.llm.bytebpe import slices
from rollcall.llm.common import components
from rollcall.llm.words import mix, shingles, signatures, word_hashes
from rollcall.session import staged


@dataclass(frozen=True)
class Settings:
    words: int = 5
    threshold: float = 0.8
    coordinates: int = 64
    recall: float = 0.995
    small: int = 64  # a node of more members is split further
    depth: int = 4  # after so many splits a node is compared whatever its size, in blocks
    # Members of a node stay if a share of coordinates agrees with some other member's; a pair at the
    # threshold falls below it with a chance of 0.00003.
    sketch: float = 0.6
    block_tokens: int = 1 << 20  # n-grams of one side of a block comparison

    def second(self) -> float:
        """How often a node chooses a second coordinate, so that 1 / threshold are chosen on average."""
        return min(1.0, 1 / self.threshold - 1)

    def runs(self) -> int:
        """Runs until a pair at the threshold is found with probability ``recall`` at full depth."""
        p = 1.0
        for _ in range(self.depth):
            met = self.threshold * p
            p = 1 - (1 - met) * (1 - self.second() * met)
        return max(1, math.ceil(math.log(1 - self.recall) / math.log(1 - p)))


def set_rows(docs: DataFrame, s: Settings) -> DataFrame:
    """(doc_id, text_hash, key, n, signature): ``key`` names the set of n-grams, null if it is empty."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [x or "" for x in batch.column("text").to_pylist()]
            for begin, end in slices([len(x) for x in texts]):
                sets = shingles(*word_hashes(texts[begin:end]), s.words)
                keys = [int(_key(x)) if len(x) else None for x in sets]
                flat = signatures(sets, s.coordinates)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(c).slice(begin, end - begin) for c in ("doc_id", "text_hash")),
                        pa.array(keys, pa.int64()), pa.array([len(x) for x in sets], pa.int32()),
                        pa.ListArray.from_arrays(
                            pa.array(np.arange(len(sets) + 1) * s.coordinates, pa.int32()), pa.array(flat.ravel(), pa.int32())
                        ),
                    ],
                    names=["doc_id", "text_hash", "key", "n", "signature"],
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("text_hash"))
    return rows.mapInArrow(build, "doc_id long, text_hash long, key long, n int, signature array<int>")


def _key(tokens: np.ndarray) -> np.int64:
    return mix(np.array([np.add.reduce(mix(tokens ^ np.uint64(0x5851F42D4C957F2D)))], np.uint64)).view(np.int64)[0]


def _children(s: Settings, node, level: int):
    """The nodes that a member of ``node`` goes on to."""
    value = lambda label: F.element_at(
        "signature", (F.pmod(F.xxhash64(F.lit(label), node), F.lit(s.coordinates)) + 1).cast("int")
    )
    also = F.pmod(F.xxhash64(F.lit("also"), node), F.lit(1000)) < int(1000 * s.second())
    first = F.xxhash64(F.lit(level), node, F.lit(1), value("first"))
    second = F.when(also, F.xxhash64(F.lit(level), node, F.lit(2), value("second")))
    return F.array_compact(F.array(first, second))


def leaves(classes: DataFrame, s: Settings) -> DataFrame:
    """(node, key): the members of every node that is to be compared, two or more for each node."""
    roots = [F.xxhash64(F.lit("run"), F.lit(r)) for r in range(s.runs())]
    member = classes.select("key", F.explode(F.flatten(F.array(*(_children(s, r, 0) for r in roots)))).alias("node"))
    found = None
    for level in range(1, s.depth + 1):
        member = staged(member.select("node", "key"), "paths")
        counts = member.groupBy("node").count().where("count > 1")
        big = F.col("count") > s.small
        split = level < s.depth
        counted = staged(member.join(counts, "node"), "paths")
        done = counted.where(~big) if split else counted
        done = done.select("node", "key")
        found = done if found is None else found.unionByName(done)
        if not split or counted.where(big).isEmpty():
            return found
        open_rows = counted.where(big).select("node", "key").join(classes.select("key", "signature"), "key")
        member = open_rows.select("key", F.explode(_children(s, F.col("node"), level)).alias("node"))
    return found


def promising(found: DataFrame, classes: DataFrame, s: Settings) -> DataFrame:
    """The members (node, key) whose signature is near that of another member of their node.

    Nodes of more than ``_SKETCHED`` members are left as they are.
    """

    def near(keys: list[int], flat: list[np.ndarray]) -> list[int]:
        signed = np.stack(flat)
        agree = (signed[:, None, :] == signed[None, :, :]).mean(axis=2)
        np.fill_diagonal(agree, 0)
        return [k for k, kept in zip(keys, (agree >= s.sketch).any(axis=1).tolist(), strict=True) if kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, keys, flat, large = None, [], [], False
        for batch in batches:
            out: list[tuple[int, int]] = []
            signed = np.asarray(batch.column("signature").flatten()).reshape(-1, s.coordinates)
            for i, (own, key) in enumerate(zip(batch.column("node").to_pylist(), batch.column("key").to_pylist(), strict=True)):
                if own != node:
                    out += [(node, k) for k in (keys if large else near(keys, flat) if len(keys) > 1 else ())]
                    node, keys, flat, large = own, [], [], False
                keys.append(key)
                if not large:
                    flat.append(signed[i])
                if len(keys) > _SKETCHED:
                    out += [(node, k) for k in keys]
                    keys, flat, large = [], [], True
            yield _rows(out)
        yield _rows([(node, k) for k in (keys if large else near(keys, flat) if len(keys) > 1 else ())])

    def _rows(out: list[tuple[int, int]]) -> pa.RecordBatch:
        columns = zip(*out, strict=True) if out else ([], [])
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["node", "key"])

    return (
        found.join(classes.select("key", "signature"), "key").select("node", "key", "signature")
        .repartition("node").sortWithinPartitions("node", "key").mapInArrow(run, "node long, key long")
    )


_SKETCHED = 256


class Comparer:
    """Compares the members of one node, or of two of its blocks."""

    def __init__(self, s: Settings):
        self.s = s

    def pairs(self, a: dict, b: dict | None, node: int) -> Iterator[tuple[int, int, np.ndarray]]:
        """Similar pairs by tiles: (first row of a, first row of b, matrix of truth)."""
        step = 512
        own = a if b is None else b
        for i in range(0, len(a["key"]), step):
            for j in range(i if b is None else 0, len(own["key"]), step):
                left, right = slice(i, i + step), slice(j, j + step)
                near = self._near(a, left, own, right)
                if near.any():
                    near &= ~self._met_before(a["nodes"][left], own["nodes"][right], node)
                if b is None and i == j:
                    near = np.triu(near, 1)
                if near.any():
                    yield i, j, near

    def _near(self, a: dict, left: slice, b: dict, right: slice) -> np.ndarray:
        x, y = a["tokens"][left], b["tokens"][right]
        nx, ny = np.array([len(t) for t in x]), np.array([len(t) for t in y])
        if len(x) == len(y) == 1:
            both = np.array([[len(np.intersect1d(x[0], y[0], assume_unique=True))]])
        else:
            both = np.zeros((len(x), len(y)))
            flat = np.concatenate([*x, *y])
            row = np.repeat(np.arange(len(x) + len(y)), np.concatenate([nx, ny]))
            _, column, count = np.unique(flat, return_inverse=True, return_counts=True)
            kept = count[column] > 1
            row, column = row[kept], (np.cumsum(count > 1) - 1)[column[kept]]
            order = np.argsort(column, kind="stable")
            row, column = row[order], column[order]
            width = 4096
            for low in range(0, int(column[-1]) + 1 if len(column) else 0, width):
                part = slice(*np.searchsorted(column, [low, low + width]))
                ones = np.zeros((len(x) + len(y), width), np.float32)
                ones[row[part], column[part] - low] = 1
                both += ones[: len(x)] @ ones[len(x) :].T
        union = nx[:, None] + ny[None, :] - both
        return both >= self.s.threshold * union - 1e-9

    @staticmethod
    def _met_before(x: list[np.ndarray], y: list[np.ndarray], node: int) -> np.ndarray:
        """Pairs that share a node with a smaller number, and are counted there."""
        rows = [n[n < node] for n in [*x, *y]]
        flat = np.concatenate(rows)
        if not len(flat):
            return np.zeros((len(x), len(y)), bool)
        row = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
        _, column, count = np.unique(flat, return_inverse=True, return_counts=True)
        kept = count[column] > 1
        row, column = row[kept], (np.cumsum(count > 1) - 1)[column[kept]]
        met = np.zeros((len(x), len(y)), np.float32)
        for low in range(0, int(column.max()) + 1 if len(column) else 0, 4096):
            inside = (column >= low) & (column < low + 4096)
            ones = np.zeros((len(rows), 4096), np.float32)
            ones[row[inside], column[inside] - low] = 1
            met += ones[: len(x)] @ ones[len(x) :].T
        return met > 0

    def compare(self, a: dict, b: dict | None, node: int) -> Iterator[tuple[int, int, int]]:
        """Rows (key, smallest key linked to it here, number of linked documents)."""
        keys = a["key"] if b is None else np.concatenate([a["key"], b["key"]])
        weight = a["weight"] if b is None else np.concatenate([a["weight"], b["weight"]])
        shift = 0 if b is None else len(a["key"])
        links = np.zeros(len(keys), np.int64)
        root = np.arange(len(keys))

        def find(i: int) -> int:
            while root[i] != i:
                root[i] = root[root[i]]
                i = root[i]
            return i

        for i, j, near in self.pairs(a, b, node):
            h, w = near.shape
            j += shift
            links[i : i + h] += near @ weight[j : j + w]
            links[j : j + w] += weight[i : i + h] @ near
            # A forest of the tile: every row hangs its columns together.
            for r in np.flatnonzero(near.any(axis=1)).tolist():
                own = np.unique(_roots(root, j + np.flatnonzero(near[r])))
                top = min(find(i + r), int(own[0]))
                root[own] = top
                root[find(i + r)] = top
        for i in np.flatnonzero(links).tolist():
            yield int(keys[i]), int(keys[find(i)]), int(links[i])


def _roots(root: np.ndarray, nodes: np.ndarray) -> np.ndarray:
    while True:
        up = root[nodes]
        if (up == root[up]).all():
            return up
        root[nodes] = root[up]


def links(members: DataFrame, s: Settings) -> DataFrame:
    """(key, other, links) of members (node, blocks, block, key, weight, nodes, tokens).

    The members of a node with several blocks are copied to every pair of its
    blocks, so that no task holds more than two blocks. ``tokens`` are the
    bytes of the sorted n-grams. A pair is counted in one node only, the first
    that both have.
    """
    pairs = members.withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    ).select(
        "node", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "key", "weight", "nodes", "tokens"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        comparer, out = Comparer(s), []
        for (node, i, j), rows in _groups(batches, ("node", "i", "j")):
            sides = []
            for block in (i, j) if i != j else (i,):
                own = [r for r in rows if r[0] == block]
                sides.append(
                    {
                        "key": np.array([r[1] for r in own], np.int64), "weight": np.array([r[2] for r in own], np.int64),
                        "nodes": [r[3] for r in own], "tokens": [r[4] for r in own],
                    }
                )
            if len(sides[0]["key"]) and len(sides[-1]["key"]):
                out += comparer.compare(sides[0], sides[1] if i != j else None, node)
            if len(out) > 50_000:
                yield _long_rows(out)
                out = []
        yield _long_rows(out)

    return (
        pairs.repartition("node", "i", "j")
        .sortWithinPartitions("node", "i", "j", "key")
        .mapInArrow(run, "key long, other long, links long")
    )


def _long_rows(rows: list[tuple[int, int, int]]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else ([], [], [])
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["key", "other", "links"])


def _groups(batches: Iterator[pa.RecordBatch], names: tuple[str, ...]):
    """Rows (block, key, weight, nodes, tokens) of each run of equal names in sorted batches."""
    current, rows = None, []
    for batch in batches:
        heads = list(zip(*(batch.column(c).to_pylist() for c in names), strict=True))
        body = zip(
            batch.column("block").to_pylist(), batch.column("key").to_pylist(), batch.column("weight").to_pylist(),
            (np.asarray(x.values) for x in batch.column("nodes")),
            (np.frombuffer(x.as_buffer(), np.uint64) for x in batch.column("tokens")),
            strict=True,
        )
        for head, row in zip(heads, body, strict=True):
            if head != current:
                if len(rows) > 1:
                    yield current, rows
                current, rows = head, []
            rows.append(row)
    if len(rows) > 1:
        yield current, rows


def _classes(docs: DataFrame, s: Settings) -> tuple[DataFrame, DataFrame]:
    """The rows with the keys of their sets, and (key, root, weight, least, links) of every set."""
    rows = staged(set_rows(docs, s), "sets")
    classes = staged(
        rows.where("key is not null")
        .groupBy("key")
        .agg(
            F.count("*").alias("weight"), F.min("doc_id").alias("least"), F.max("n").alias("n"),
            F.min(F.struct("text_hash", "doc_id")).alias("one"), F.any_value("signature").alias("signature"),
        ),
        "classes",
    )
    found = staged(promising(leaves(classes, s), classes, s), "leaves")
    compared = found.groupBy("key").agg(F.sort_array(F.collect_set("node")).alias("nodes"))
    wanted = staged(
        compared.join(classes.select("key", "weight", "n", "one"), "key")
        .select("key", "weight", "n", "nodes", "one.*"),
        "wanted",
    )

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [x or "" for x in batch.column("text").to_pylist()]
            for begin, end in slices([len(x) for x in texts]):
                sets = shingles(*word_hashes(texts[begin:end]), s.words)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("key").slice(begin, end - begin), pa.array([x.tobytes() for x in sets], pa.binary())], names=["key", "tokens"]
                )

    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("text_hash"))
    same = (F.col("d.text_hash") == F.col("w.text_hash")) & F.col("d.doc_id").eqNullSafe(F.col("w.doc_id"))
    sets = (
        # Merged at every size, so that small inputs move what large ones do.
        text.alias("d").join(wanted.alias("w").hint("merge"), same).select("key", "text").dropDuplicates(["key"])
        .mapInArrow(tokens, "key long, tokens binary")
    )
    sizes = found.join(classes.select("key", "n"), "key").groupBy("node").agg(
        F.ceil(F.sum("n") / s.block_tokens).cast("int").alias("blocks")
    )
    members = (
        wanted.select("key", "weight", "nodes", F.explode("nodes").alias("node"))
        .join(sizes, "node")
        .join(sets, "key")
        .withColumn("block", F.pmod(F.xxhash64(F.lit("block"), "key"), F.col("blocks")).cast("int"))
    )
    linked = staged(links(members, s), "links")
    per_class = linked.groupBy("key").agg(F.sum("links").alias("links"))
    roots = components(linked.select("key", "other"))
    info = (
        classes.select("key", "weight", "least").join(per_class, "key", "left").join(roots, F.col("key") == F.col("node"), "left")
        .select("key", "weight", "least", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("root", "key").alias("root"))
    )
    return rows, staged(info, "info")


def similarity_classes(docs: DataFrame, s: Settings = Settings()) -> DataFrame:
    """(doc_id, class_id, n_links), one row for each row of ``docs``.

    Two rows are linked if the Jaccard similarity of their n-gram sets is at
    least the threshold; equal sets always are, found by a 64-bit key.
    ``class_id`` is the smallest doc_id that links lead to, ``n_links`` the
    number of rows linked directly. Texts of fewer words than an n-gram link
    with equal ones only; null texts and texts without words with none: they
    are classes of their own. Repeated rows count each. A null doc_id is kept;
    a class of such rows only has none. Other columns are left out.
    """
    rows, info = _classes(docs, s)
    least = info.groupBy("root").agg(F.min("least").alias("class_id"))
    info = info.join(least, "root").select("key", "class_id", (F.col("links") + F.col("weight") - 1).alias("n_links"))
    return rows.select("doc_id", "key").join(info, "key", "left").select(
        "doc_id", F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
    )


def keep_one(docs: DataFrame, s: Settings = Settings()) -> DataFrame:
    """The rows of ``docs`` without those that are similar to one that stays.

    Of each class the row of the smallest doc_id stays (null first, then by a
    hash of the text), once if it is repeated. Texts without words all stay.
    """
    rows, info = _classes(docs, s)
    name = F.struct("doc_id", "text_hash")
    one = rows.join(info.select("key", "root"), "key").groupBy("root").agg(F.min(name).alias("one")).select("one.*")
    alone = rows.where("key is null").select("doc_id", "text_hash").distinct()
    wanted = one.withColumn("_many", F.lit(False)).unionByName(alone.withColumn("_many", F.lit(True)))
    wanted = wanted.select(F.col("doc_id").alias("_doc_id"), F.col("text_hash").alias("_wanted_hash"), "_many")
    named = docs.withColumn("_text_hash", F.xxhash64("text"))
    same = (F.col("_text_hash") == F.col("_wanted_hash")) & F.col("doc_id").cast("long").eqNullSafe(F.col("_doc_id"))
    kept = staged(named.join(wanted, same).drop("_wanted_hash", "_doc_id"), "kept")
    once = kept.where(~F.col("_many")).dropDuplicates(["doc_id", "_text_hash"])
    return once.unionByName(kept.where("_many")).select(*docs.columns)
