"""Hard negatives by exact integer scores from a residue number system.

Rows and anchors are reduced modulo several small primes; for each prime one
matrix product in float32 is exact, as its sums stay below 2 ** 24. The scores
come back from their residues by Chinese remaindering, and a window over them
selects negatives near each positive.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollcall.session import staged

SHARD_ROWS = 1 << 14
LEAST_SHARDS = 24
ANCHOR_ROWS = 512
LARGEST_PRIME = 251
EXACT = 1 << 24  # float32 holds every whole number up to this
TILE = 128  # anchors whose scores are in memory together


def primes_for(bound: int) -> list[int]:
    """Primes from 251 downwards whose product is more than twice ``bound``."""
    out, product, p = [], 1, LARGEST_PRIME
    while product <= 2 * bound:
        if p < 3:
            raise ValueError("scores beyond the largest residue system")
        if all(p % q for q in range(2, math.isqrt(p) + 1)):
            out.append(p)
            product *= p
        p -= 1
    return out


def residues(x: np.ndarray, p: int) -> np.ndarray:
    """Residues around zero, as float32."""
    r = x % p
    return np.where(r > p // 2, r - p, r).astype(np.float32)


def product_mod(a: np.ndarray, b: np.ndarray, p: int) -> np.ndarray:
    """``a @ b.T`` modulo p, from 0 to p - 1, for residues in float32."""
    width = EXACT // (p // 2) ** 2
    out = np.zeros((len(a), len(b)), np.int32)
    for at in range(0, a.shape[1], width):
        out += np.rint(a[:, at : at + width] @ b[:, at : at + width].T).astype(np.int32) % p
    return out % p


class Rows:
    """The rows of a shard, reduced once for all anchors."""

    def __init__(self, vectors: np.ndarray):
        self.vectors, self.reduced = vectors, {}
        self.largest = largest(vectors)

    def scores(self, anchors: np.ndarray) -> np.ndarray:
        """Exact inner products of anchors and rows; beyond 64 bits they wrap around."""
        bound = max(1, anchors.shape[1] * self.largest * largest(anchors))
        primes = primes_for(bound)
        # Shifted by half the product, signed scores become the numbers from 0 on, so that no
        # comparison with the product is needed; all is modulo 2 ** 64.
        half = math.prod(primes) // 2
        total, scale, digits = np.zeros((len(anchors), len(self.vectors)), np.uint64), 1, []
        for i, p in enumerate(primes):
            if p not in self.reduced:
                self.reduced[p] = residues(self.vectors, p)
            digit = (product_mod(residues(anchors, p), self.reduced[p], p) + half % p) % p
            # Mixed radix: what the digits before give modulo p is taken off, then divided by their primes.
            before, known = 1, np.zeros_like(digit)
            for j in range(i):
                known += digits[j] * (before % p) % p
                before *= primes[j]
            digit = (digit - known) % p * pow(before, -1, p) % p
            digits.append(digit)
            total += digit.astype(np.uint64) * np.uint64(scale % (1 << 64))
            scale *= p
        return (total - np.uint64(half % (1 << 64))).view(np.int64)


def largest(vectors: np.ndarray) -> int:
    return max(abs(int(vectors.min())), abs(int(vectors.max()))) if vectors.size else 0


def first(score: np.ndarray, k: int) -> np.ndarray:
    """Places of the k largest scores, ties to the earlier place; in no order."""
    if len(score) <= k:
        return np.arange(len(score))
    least = np.partition(score, len(score) - k)[len(score) - k]
    above = np.flatnonzero(score > least)
    return np.concatenate([above, np.flatnonzero(score == least)[: k - len(above)]])


def scaled(embedding: Column, scale: int = 256) -> Column:
    """floor(scale * component) of each component, or null for vectors with null or non-finite ones."""
    x = F.transform(embedding, lambda v: v.cast("double"))
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return F.when(~bad, F.transform(x, lambda v: F.floor(v * scale).cast("long")))


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Vectors as rows; shorter ones are filled with zeros."""
    lists = column.combine_chunks()
    size = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(size), width), np.int64)
    begin = np.cumsum(size) - size
    at = np.arange(int(size.sum()))
    out[np.repeat(np.arange(len(size)), size), at - np.repeat(begin, size)] = lists.flatten().to_numpy()
    return out


def mine(
    vectors: DataFrame, anchors: Column, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100,
    shard_rows: int = SHARD_ROWS, least_shards: int = LEAST_SHARDS, anchor_rows: int = ANCHOR_ROWS,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``vectors`` has ``vec_id``, ``label`` and ``vector`` (array of longs); rows
    with a null in one of them take no part, other columns are left out. Rows of
    equal ``vec_id`` are one row, the one of smallest label and vector. Vectors
    of different length are filled up with zeros. ``anchors`` tells the rows to
    mine for. Scores are inner products; higher ones come first, ties by smaller
    id. An anchor's positives are its first ``positives`` other rows of its
    label; for each, the first ``negatives`` rows of other labels with ``low``
    to ``high`` percent of its score are returned, fewer or none if there are no
    more; ``rank`` counts them from 1. A negative positive's score has no such
    rows. Scores beyond 64 bits wrap around.

    Rows are dealt to shards of about ``shard_rows``, anchors to blocks; a task
    holds one of each, and only the best of a shard leave it.
    """
    usable = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull()
    rows = staged(
        vectors.where(usable)
        .select(F.col("vec_id").cast("long"), F.col("label").cast("long"), F.col("vector").cast("array<long>"))
        .where(~F.exists("vector", lambda x: x.isNull()))
        .groupBy("vec_id").agg(F.min(F.struct("label", "vector")).alias("row")).select("vec_id", "row.*"),
        "vectors",
    )
    asked = rows.where(anchors)
    count, width, n_anchors = rows.agg(F.count("*"), F.max(F.size("vector")), F.count_if(anchors)).first()
    width = max(1, width or 0)
    shards = max(least_shards, math.ceil(count / shard_rows))
    blocks = max(1, math.ceil(n_anchors / anchor_rows))
    part = lambda n, salt: F.pmod(F.xxhash64("vec_id", F.lit(salt)), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    dealt = rows.withColumn("shard", part(shards, 1)).withColumn("block", every(blocks))

    def met(questions: DataFrame, pick, schema: str) -> DataFrame:
        """``pick`` on every shard and block, each anchor with the scores of a shard's rows by id."""

        def work(left: pa.Table, right: pa.Table) -> pa.Table:
            left = left.sort_by("vec_id")
            ids, labels = left.column("vec_id").to_numpy(), left.column("label").to_numpy()
            held = Rows(_matrix(left.column("vector"), width))
            own = _matrix(right.column("vector"), width)
            questions, found = right.drop_columns(["vector"]).to_pylist(), []
            for at in range(0, len(questions) if len(ids) else 0, TILE):
                score = held.scores(own[at : at + TILE])
                for question, line in zip(questions[at : at + TILE], score, strict=False):
                    found += pick(question, ids, labels, line)
            columns = list(zip(*found, strict=True)) or [[]] * len(names)
            return pa.table([pa.array(c, pa.int64()) for c in columns], names=names)

        names = [c.split()[0] for c in schema.split(", ")]
        copied = questions.withColumn("block", part(blocks, 2)).withColumn("shard", every(shards))
        return dealt.groupBy("shard", "block").cogroup(copied.groupBy("shard", "block")).applyInArrow(work, schema)

    def same_label(question, ids, labels, score):
        at = np.flatnonzero((labels == question["label"]) & (ids != question["vec_id"]))
        for i in at[first(score[at], positives)].tolist():
            yield question["vec_id"], int(ids[i]), int(score[i])

    def in_window(question, ids, labels, score):
        wanted = [(x["positive_id"], x["positive_score"]) for x in question["positives"]]
        bounds = [(-(-low * s // 100), high * s // 100) for _, s in wanted]
        near = (score >= min(x for x, _ in bounds)) & (score <= max(y for _, y in bounds))
        other = np.flatnonzero(near & (labels != question["label"]) & (ids != question["vec_id"]))
        reach = score[other]
        for (positive, best), (least, most) in zip(wanted, bounds, strict=True):
            at = other[(reach >= least) & (reach <= most)]
            for i in at[first(score[at], negatives)].tolist():
                yield question["vec_id"], positive, best, int(ids[i]), int(score[i])

    order = Window.partitionBy("anchor_id").orderBy(F.col("positive_score").desc(), "positive_id")
    near = met(asked, same_label, "anchor_id long, positive_id long, positive_score long")
    near = near.withColumn("n", F.row_number().over(order)).where(F.col("n") <= positives)
    near = near.groupBy("anchor_id").agg(F.collect_list(F.struct("positive_id", "positive_score")).alias("positives"))
    again = staged(asked.join(near, F.col("vec_id") == F.col("anchor_id")).drop("anchor_id"), "positives")
    order = Window.partitionBy("anchor_id", "positive_id").orderBy(F.col("negative_score").desc(), "negative_id")
    found = met(
        again, in_window, "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long"
    )
    return (
        found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    )
