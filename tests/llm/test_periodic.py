"""Periodic runs and the text without them, against all stretches of words."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from rollcall.llm.common import table
from rollcall.llm.periodic import collapse_runs
from rollcall.llm.queries import QUERIES
from rollcall.llm.recompression import Grammar


def brute(words, least=12):
    """All runs, period by period: stretches of equal words one period apart that reach as far as they can."""
    n, found = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i < n - q:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(least, 2 * q):
                found.setdefault((i, j + q), q)
            i = j
    return sorted((i, e - i, q) for (i, e), q in found.items())


def collapsed(words, runs):
    dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in dropped)


def text_of(rnd):
    kind = rnd.random()
    letters = "ab" if kind < 0.4 else "abcdefgh"
    words = [rnd.choice(letters) for _ in range(rnd.randint(0, 120))]
    for _ in range(rnd.randint(0, 3)):
        a = rnd.randint(0, len(words))
        words[a:a] = words[a : a + rnd.randint(1, 20)] * rnd.randint(1, 6)
    return words


def test_extensions():
    rnd = random.Random(3)
    for _ in range(60):
        words = [0] + sum(([1 + ord(w) - 97 for w in text_of(rnd)] for _ in range(3)), []) + [20]
        words = np.array([99, *words[1:-1], 100])
        grammar = Grammar(words, (99, 101))
        n = len(words)
        if n < 4:
            continue
        pairs = [sorted(rnd.sample(range(1, n), 2)) for _ in range(200)]
        x, y = np.array(pairs).T
        ahead, behind = grammar.extension(x, y, True), grammar.extension(x, y, False)
        for (i, j), f, b in zip(pairs, ahead.tolist(), behind.tolist()):
            k = 0
            while j + k < n and words[i + k] == words[j + k]:
                k += 1
            assert f == k
            k = 0
            while i - k > 0 and words[i - k - 1] == words[j - k - 1]:
                k += 1
            assert b == k


@pytest.mark.parametrize("seed,least", [(1, 12), (2, 12), (3, 2), (4, 5)])
def test_same_as_all_stretches(spark, seed, least):
    rnd = random.Random(seed)
    texts = [text_of(rnd) for _ in range(400)] + [["x"] * 3000, ["x", "y", "x"] * 700, []]
    data = [(i, rnd.choice([" ", "\n", " \t ", "\x0b"]).join(w), i % 3) for i, w in enumerate(texts)]
    data += [(None, None, 0), (5, "\t \n", None), (5, "\xa0 \u2003\xa0", None), data[7], data[7]]
    frame = spark.createDataFrame(data, "doc_id long, text string, runs int")
    got = collapse_runs(frame, least, batch_bytes=3000).collect()
    assert len(got) == len(data)
    by_id = {d[0]: re.findall(r"[^\x20\x09-\x0D]+", d[1] or "") for d in data if d[0] != 5}
    for r in got:
        if r.doc_id == 5:
            continue
        words = by_id[r.doc_id]
        want = brute(words, least)
        assert [tuple(x) for x in r.runs] == want
        assert r.n_words == len(words) and r.collapsed == collapsed(words, want)
    assert {r.collapsed for r in got if r.doc_id == 5} >= {"", "\xa0 \u2003\xa0"}


def test_no_rows(spark):
    assert collapse_runs(spark.createDataFrame([], "text string, Collapsed int, collapsed_2 int")).collect() == []


def test_whole_query(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").collect()
    got = {r.doc_id: r for r in QUERIES["op11_periodic_runs"](spark, sf_dir).collect()}
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    assert len(got) == len(docs)
    for d in docs:
        words = re.findall(r"[^\x20\x09-\x0D]+", d.text or "")
        h, n = zlib.crc32(str(d.doc_id).encode()), len(words)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        if n > 3000:
            continue  # too long for this check
        want, r = brute(words), got[d.doc_id]
        best = min(want, key=lambda x: (-x[1], x[0], x[2]), default=(None, None, None))
        milli = 1000 * best[1] // best[2] if want else None
        assert (r.n_runs, r.start, r.length, r.period, r.exponent_milli) == (len(want), *best, milli)
        assert r.runs_sha256 == sha("".join(f"{s},{k},{q}\n" for s, k, q in want))
        assert r.collapsed_sha256 == sha(collapsed(words, want))
