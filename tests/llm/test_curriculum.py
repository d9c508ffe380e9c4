"""The mix against a plain one, and its positions against integrals of the weights."""

import random
import re
from fractions import Fraction

import pytest

from rollcall.llm.curriculum import mix, segments, training_order

SCHEDULES = (((0, 7), (1, 3)), ((0, 2), (0.5, 2), (1, 2)), ((0, 0), (0.25, 0), (0.5, 2), (1, 1)))


def area(schedule, t):
    out = 0.0
    for (a, w), (b, v) in zip(schedule, schedule[1:]):
        u = min(max(t, a), b)
        out += (u - a) * (w + w + (v - w) * (u - a) / (b - a)) / 2
    return out


def plain_targets(sizes, weights, share, most):
    """Shares by weight; what is above a limit is shared out again."""
    left, open_, out = Fraction(share) * sum(sizes), set(range(len(sizes))), {}
    while open_:
        level = left / sum(weights[i] for i in open_)
        full = {i for i in open_ if level * weights[i] >= Fraction(most) * sizes[i]}
        if not full:
            return [float(out[i] if i in out else level * weights[i]) for i in range(len(sizes))]
        for i in full:
            out[i] = Fraction(most) * sizes[i]
            left -= out[i]
        open_ -= full
    return [float(out[i]) for i in range(len(sizes))]


def made(rnd, n, sources):
    return [
        (i, " ".join("w" * rnd.randint(1, 3) for _ in range(rnd.choice([0, 1, 5, 40]))) if rnd.random() < 0.95 else None,
         rnd.choice(sources), i % 3, "x") for i in range(n)
    ]


@pytest.mark.parametrize("seed,share,most", [(1, 1.5, 2.0), (2, 0.3, 2.0), (3, 2.5, 3.0), (4, 5.0, 2.0)])
def test_mix(spark, seed, share, most):
    rnd = random.Random(seed)
    data = made(rnd, 300, ["a", "B", "é", "\U0001f600", "￮", None, "a", "a", "a"])
    data += [data[5], data[5], (5, "other words here", data[5][2], 0, "y"), (None, "one two", "B", 0, ""), (None, None, None, 0, "")]
    data.append((900, "long " * 500, "B", 0, ""))
    frame = spark.createDataFrame(data, "doc_id long, text string, source string, size int, key string")
    got = mix(frame, SCHEDULES, share, most).collect()
    assert len(got) == len(data) and set(got[0].asDict()) >= {"doc_id", "text", "source", "key"}
    again = mix(frame.repartition(5), SCHEDULES, share, most).collect()
    shown = lambda rows: sorted(repr((r.doc_id, r.size, r.source, r.taken, r.first_position)) for r in rows)
    assert shown(got) == shown(again)
    names = sorted({d[2] for d in data}, key=lambda s: (s is None, (s or "").encode()))
    words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes = [sum(words(d[1]) for d in data if d[2] == s) for s in names]
    plans = [SCHEDULES[i % 3] for i in range(len(names))]
    targets = plain_targets(sizes, [Fraction(area(p, 1)) for p in plans], share, most)
    for name, size, target, plan in zip(names, sizes, targets, plans):
        mine = [r for r in got if r.source == name]
        assert all(r.size == words(r.text) and r.source_size == size for r in mine)
        assert all(r.target == pytest.approx(target) for r in mine)
        assert sum(r.taken for r in mine) == int(target + 1e-6)
        assert all(r.taken <= most * r.size and r.taken == sum(x.words for x in r.turns) for r in mine)
        # The words due before a position are the integral of the weights up to it.
        due = sorted((x.position, x.words) for r in mine for x in r.turns)
        before = 0
        for position, n in sorted(due, key=lambda x: x[0]):
            share_of = area(plan, position) / area(plan, 1)
            assert share_of * int(target + 1e-6) == pytest.approx(before, abs=1e-3 * max(1, target))
            before += n
    known = [r.first_position for r in got if r.first_position is not None]
    assert known == sorted(known) and [r.first_position is None for r in got].index(False) == len(got) - len(known)
    order = training_order(mix(frame, SCHEDULES, share, most)).collect()
    assert [r.position for r in order] == sorted(r.position for r in order)
    assert sum(r.words for r in order) == sum(r.taken for r in got)


def test_empty_and_wordless(spark):
    schema = "doc_id long, text string, source string"
    assert mix(spark.createDataFrame([], schema), SCHEDULES).collect() == []
    rows = mix(spark.createDataFrame([(1, None, "a"), (2, " ", None)], schema), SCHEDULES).collect()
    assert [(r.size, r.target, r.taken, r.first_position) for r in rows] == [(0, 0.0, 0, None)] * 2


@pytest.mark.parametrize("bad", [((0, 1),), ((0, 1), (0.5, 1)), ((0, -1), (1, 1)), ((0, 0), (1, 0)), ((0, 1), (0, 1), (1, 1))])
def test_bad_schedules(bad):
    with pytest.raises(ValueError):
        segments(bad)
