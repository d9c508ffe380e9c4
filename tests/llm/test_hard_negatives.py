"""Hard negatives against all scores, and scores against whole-number products."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from rollcall.llm.hard_negatives import Rows, mine, primes_for, scaled


@pytest.mark.parametrize("width,size", [(1, 1), (3, 256), (64, 256), (3000, 127), (700, 1 << 24), (8, 1 << 28)])
def test_exact_scores(width, size):
    rng = np.random.default_rng(width)
    a, b = (rng.integers(-size, size + 1, (n, width)) for n in (7, 50))
    a[0], b[0] = -size, size
    want = np.array([[sum(int(x) * int(y) for x, y in zip(r, s)) for s in b] for r in a])
    assert (Rows(b).scores(a) == want).all()


def test_wraps_around():
    a = np.array([[1 << 40, 3]])
    want = ((1 << 80) + 9 + (1 << 63)) % (1 << 64) - (1 << 63)
    assert Rows(a).scores(a)[0, 0] == want
    assert Rows(np.zeros((2, 0), np.int64)).scores(np.zeros((1, 0), np.int64)).tolist() == [[0, 0]]
    assert len(set(primes_for(1 << 130))) == len(primes_for(1 << 130))


def brute(rows, anchors, positives, negatives, low, high):
    out = []
    for a in anchors:
        _, label, own = next(r for r in rows if r[0] == a)
        scored = sorted((-sum(x * y for x, y in zip(own, v)), i, k) for i, k, v in rows if i != a)
        same = [(i, -s) for s, i, k in scored if k == label][:positives]
        for i, s in same:
            near = [(j, -t) for t, j, k in scored if k != label and low * s <= -100 * t <= high * s][:negatives]
            out += [(a, i, rank, j, s, t) for rank, (j, t) in enumerate(near, 1)]
    return sorted(out)


@pytest.mark.parametrize("seed,low,high", [(1, 80, 100), (2, 80, 100), (3, -50, 90)])
def test_same_as_all_scores(spark, seed, low, high):
    rnd = random.Random(seed)
    rows = [(i, rnd.randint(0, 2), [rnd.randint(-3, 9) for _ in range(rnd.choice([0, 4, 5, 5, 5]))]) for i in range(300)]
    rows += [(300 + i, i % 3, rows[5][2]) for i in range(60)]  # ties
    frame = spark.createDataFrame(
        [(*r, "x") for r in rows] + [(*rows[7], "y"), (None, 1, [1], ""), (400, None, [1], ""), (401, 1, None, ""), (402, 1, [None], ""), (7, 99, [9], "")],
        "vec_id long, label int, vector array<long>, block string",
    )
    got = mine(frame, F.col("vec_id") % 10 == 0, 4, 3, low, high, shard_rows=50, least_shards=3, anchor_rows=9)
    assert sorted(map(tuple, got.collect())) == brute(rows, [r[0] for r in rows if r[0] % 10 == 0], 4, 3, low, high)


def test_no_rows(spark):
    frame = spark.createDataFrame([], "vec_id long, label int, vector array<long>")
    assert mine(frame, F.col("vec_id") >= 0).collect() == []
    alone = spark.createDataFrame([(1, 1, [1]), (2, 2, [1])], frame.schema)
    assert mine(alone, F.col("vec_id") >= 0).collect() == []


def test_scaled(spark):
    data = [([0.5, -0.01],), ([float("nan")],), (None,), ([None, 1.0],), ([],), ([float("-inf")],)]
    frame = spark.createDataFrame(data, "e array<float>")
    assert [r[0] for r in frame.select(scaled(F.col("e"))).collect()] == [[128, -3], None, None, None, [], None]
