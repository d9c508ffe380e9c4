"""Exact top-k search by inner product, with MaxScore over shards of postings."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SHARD_ROWS = 1 << 16
LEAST_SHARDS = 24
QUERY_ROWS = 2048


class Shard:
    """Postings of some vectors: for each term the rows with it, and bounds of its weights."""

    def __init__(self, ids: np.ndarray, terms: np.ndarray, weights: np.ndarray, row: np.ndarray):
        self.ids = ids
        held = weights != 0
        self.terms, term = np.unique(terms[held], return_inverse=True)
        row, weights = row[held], weights[held]
        order = np.lexsort((weights, term))
        self.row, self.weight = row[order], weights[order]
        edge = np.searchsorted(term[order], np.arange(len(self.terms) + 1))
        # Within a term weights ascend, so that the rows of either sign are one stretch.
        self.begin, self.end = edge[:-1], edge[1:]
        negative = np.concatenate([[0], np.cumsum(self.weight < 0)])
        self.middle = self.begin + negative[self.end] - negative[self.begin]
        self.low = np.minimum(self.weight[self.begin], 0) if len(self.terms) else np.zeros(0, np.int64)
        self.high = np.maximum(self.weight[self.end - 1], 0) if len(self.terms) else np.zeros(0, np.int64)
        self.dense = None
        if len(self.terms) * len(ids) <= 4 * len(self.row):
            self.dense = np.zeros((len(self.terms), len(ids)), np.int64)
            self.dense[term, row] = weights
        else:
            place = term.astype(np.int64) * len(ids) + row
            order = np.argsort(place)
            self.place, self.at_place = place[order], weights[order]

    def probe(self, term: int, rows: np.ndarray) -> np.ndarray:
        """The weights of one term in some rows."""
        if self.dense is not None:
            return self.dense[term, rows]
        place = term * len(self.ids) + rows
        at = np.minimum(np.searchsorted(self.place, place), len(self.place) - 1)
        return np.where(self.place[at] == place, self.at_place[at], 0)

    def search(self, own: int, terms: np.ndarray, weights: np.ndarray, k: int) -> list[tuple[int, int]]:
        """The k best (id, score) for a query, ties to the smaller id; rows with the id ``own`` are left out."""
        at = np.minimum(np.searchsorted(self.terms, terms), max(0, len(self.terms) - 1))
        here = (self.terms[at] == terms) & (weights != 0) if len(self.terms) else np.zeros(len(terms), bool)
        at, weights = at[here], weights[here]
        bound = np.maximum(weights * self.high[at], weights * self.low[at])
        order = np.argsort(-bound, kind="stable")
        at, weights, bound = at[order], weights[order], bound[order]
        left = np.concatenate([np.cumsum(bound[::-1])[::-1], [0]])  # what terms from here on can add
        least = self._first_guess(own, at, weights, k)
        # Non-essential: the last terms, which together stay below the k-th score known.
        essential = int(np.searchsorted(-left, -least, side="right")) if least is not None and least > 0 else len(at)
        score = np.zeros(len(self.ids), np.int64)
        met = np.zeros(len(self.ids), bool)
        for t, w in zip(at[:essential].tolist(), weights[:essential].tolist(), strict=True):
            all_rows = slice(self.begin[t], self.end[t])
            score[self.row[all_rows]] += w * self.weight[all_rows]
            raising = slice(self.middle[t], self.end[t]) if w > 0 else slice(self.begin[t], self.middle[t])
            met[self.row[raising]] = True
        if least is None or least <= 0:
            met[:] = True  # rows that no posting raises compete as well
        rows = np.flatnonzero(met & (self.ids != own))
        total = score[rows]
        for i in range(essential, len(at)):
            if least is not None:
                near = total + left[i] >= least
                rows, total = rows[near], total[near]
            total = total + weights[i] * self.probe(int(at[i]), rows)
        if len(rows) > 4 * k:
            near = total >= -np.partition(-total, k - 1)[k - 1]
            rows, total = rows[near], total[near]
        best = np.lexsort((self.ids[rows], -total))[:k]
        return list(zip(self.ids[rows[best]].tolist(), total[best].tolist(), strict=True))

    def _first_guess(self, own: int, at: np.ndarray, weights: np.ndarray, k: int) -> int | None:
        """The k-th score among rows that the strongest terms favour; None if there are too few."""
        rows = []
        for t, w in zip(at[:4].tolist(), weights[:4].tolist(), strict=True):
            stretch = self.row[self.begin[t] : self.end[t]]
            rows.append(stretch[-4 * k :] if w > 0 else stretch[: 4 * k])
        rows = np.unique(np.concatenate([*rows, np.zeros(0, np.int64)]).astype(np.int64))
        rows = rows[self.ids[rows] != own]
        if len(rows) < k:
            return None
        total = np.zeros(len(rows), np.int64)
        for t, w in zip(at.tolist(), weights.tolist(), strict=True):
            total += w * self.probe(t, rows)
        return int(-np.partition(-total, k - 1)[k - 1])


def top_k(
    vectors: DataFrame, queries: DataFrame, k: int, shard_rows: int = SHARD_ROWS, least_shards: int = LEAST_SHARDS,
    query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k best vectors by integer inner product.

    Both frames have ``vec_id``, ``terms`` (distinct ints) and ``weights``
    (longs, as many); a term that a vector lacks counts 0. Rows with a null or
    of ``vec_id`` null take no part; a query never meets rows of its own id.
    Ties go to the smaller id; repeated rows rank each. Queries of equal id and
    vector count once. Scores are 64-bit sums. Vectors are dealt to shards of
    about ``shard_rows`` by a hash and copied to every block of queries, which
    are copied to every shard: a task holds one shard and one block.
    """
    usable = F.col("vec_id").isNotNull() & F.col("terms").isNotNull() & F.col("weights").isNotNull()
    vectors = vectors.where(usable).select(F.col("vec_id").cast("long").alias("vec_id"), "terms", "weights")
    queries = (
        queries.where(usable).select(F.col("vec_id").cast("long").alias("vec_id"), "terms", "weights")
        .dropDuplicates(["vec_id", "terms", "weights"])
    )
    shards = max(least_shards, math.ceil(vectors.count() / shard_rows))
    blocks = max(1, math.ceil(queries.count() / query_rows))
    deal = lambda label, n: F.pmod(F.xxhash64(F.lit(label), F.monotonically_increasing_id()), F.lit(n)).cast("int")
    dealt = vectors.withColumn("shard", deal("shard", shards)).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    query = F.xxhash64("vec_id", "terms", "weights")
    asked = (
        queries.withColumn("query", query).withColumn("block", F.pmod(query, F.lit(blocks)).cast("int"))
        .withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    )

    def search(left, right):
        columns = ([], [], [], [])
        if left.num_rows and right.num_rows:
            row, terms, weights = _flat(left)
            shard = Shard(left.column("vec_id").to_numpy(), terms, weights, row)
            row, terms, weights = _flat(right)
            edge = np.searchsorted(row, np.arange(right.num_rows + 1))
            ids, names = right.column("vec_id").to_pylist(), right.column("query").to_pylist()
            for i, own in enumerate(ids):
                part = slice(edge[i], edge[i + 1])
                for vec, score in shard.search(own, terms[part], weights[part], k):
                    for column, value in zip(columns, (own, names[i], vec, score), strict=True):
                        column.append(value)
        return pa.table([pa.array(c, pa.int64()) for c in columns], names=["query_id", "query", "vec_id", "score"])

    found = (
        dealt.groupBy("shard", "block").cogroup(asked.groupBy("shard", "block"))
        .applyInArrow(search, "query_id long, query long, vec_id long, score long")
    )
    order = Window.partitionBy("query_id", "query").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _flat(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The row, term and weight of every component."""
    terms, weights = (table.column(c).combine_chunks() for c in ("terms", "weights"))
    size = terms.value_lengths().to_numpy(zero_copy_only=False)
    return np.repeat(np.arange(len(size)), size), terms.flatten().to_numpy().astype(np.int64), weights.flatten().to_numpy().astype(np.int64)


def dense_terms(embeddings: DataFrame, scale: int = 256) -> DataFrame:
    """(vec_id, terms, weights) of dense vectors: weight floor(scale * component), its place the term.

    Vectors null or with null or non-finite components are left out.
    """
    x = F.transform("embedding", lambda v: v.cast("double"))
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    good = embeddings.where(F.col("embedding").isNotNull()).where(~bad)
    return good.select(
        "vec_id",
        F.when(F.size("embedding") > 0, F.sequence(F.lit(0), F.size("embedding") - 1)).otherwise(F.array().cast("array<int>")).alias("terms"),
        F.transform(x, lambda v: F.floor(v * scale)).alias("weights"),
    )
