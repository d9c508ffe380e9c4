"""MaxScore search against all scores."""

import random

import pytest

from rollcall.llm.maxscore import dense_terms, top_k


def brute(vectors, queries, k):
    out = []
    for qid, terms, weights in {(q[0], tuple(q[1]), tuple(q[2])) for q in queries if None not in q}:
        own = dict(zip(terms, weights))
        scored = [
            (-sum(own.get(t, 0) * w for t, w in zip(v[1], v[2])), v[0]) for v in vectors if None not in v and v[0] != qid
        ]
        out += [(qid, rank, vec, -score) for rank, (score, vec) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("seed,density,low", [(1, 1.0, -9), (2, 0.1, 1), (3, 0.02, -3), (4, 0.3, -9)])
def test_same_as_all_scores(spark, seed, density, low):
    rnd = random.Random(seed)
    vectors = []
    for i in range(300):
        terms = sorted(t for t in range(40) if rnd.random() < density)
        vectors.append((i, terms, [rnd.randint(low, 9) for _ in terms]))
    vectors += [(300 + i, *vectors[5][1:]) for i in range(40)]  # ties
    vectors += [vectors[7], vectors[7], (None, [1], [1]), (999, None, [1]), (998, [], [])]
    frame = spark.createDataFrame(vectors, "vec_id long, terms array<int>, weights array<long>").repartition(3)
    queries = [v for v in vectors if v[0] is not None and v[0] % 20 == 0] + [vectors[7], vectors[-1]]
    asked = spark.createDataFrame(queries, frame.schema)
    got = top_k(frame, asked, 5, shard_rows=60, least_shards=3, query_rows=7).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == brute(vectors, queries, 5)


def test_dense_vectors(spark):
    data = [(1, [0.5, -0.01], 3), (2, [float("nan"), 1.0], 3), (3, None, 3), (4, [None, 1.0], 3), (5, [], 3), (6, [float("inf")], 3)]
    frame = spark.createDataFrame(data, "vec_id long, embedding array<float>, terms int")
    assert sorted(map(tuple, dense_terms(frame).collect())) == [(1, [0, 1], [128, -3]), (5, [], [])]
    found = top_k(dense_terms(frame), dense_terms(frame), 5).collect()
    assert sorted((r.query_id, r.vec_id, r.score) for r in found) == [(1, 5, 0), (5, 1, 0)]
    assert top_k(dense_terms(frame.where("false")), dense_terms(frame.where("false")), 5).count() == 0
