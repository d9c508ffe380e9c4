"""Windowed joins against a plain-Python reading of their rules."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from rollcall.operators.join import Side, windowed_left_join

HOUR = 3600


def sides(spark, lefts, *rights):
    """Rows are (uid, dn, seconds, seq); sides get columns s0, s1, ..."""
    made = []
    for i, rows in enumerate([lefts, *rights]):
        df = spark.createDataFrame(rows, f"uid int, dn string, sec bigint, s{i} bigint")
        df = df.withColumn("window", F.window(F.timestamp_seconds("sec"), "1 hour"))
        made.append(Side(df.select("uid", "dn", "window", f"s{i}"), f"s{i}"))
    return made


def result(df, count):
    rows = df.select("uid", "dn", *[f"s{i}" for i in range(count)]).collect()
    return Counter(tuple(r) for r in rows)


def spelled(part):
    return "null" if part is None else str(part)


def pair(lefts, right_rows, first_left, null_safe=False):
    """One join step; lefts are tuples (uid, dn, sec, seqs...) in emission order."""
    rights = defaultdict(list)
    for uid, dn, sec, seq in sorted(right_rows, key=lambda r: r[3]):
        if null_safe or (uid is not None and dn is not None):
            rights[(spelled(uid), spelled(dn), sec // HOUR)].append(seq)
    out, seen = [], set()
    for row in lefts:
        key = (spelled(row[0]), spelled(row[1]), row[2] // HOUR)
        whole = null_safe or (row[0] is not None and row[1] is not None)
        found = rights.get(key, []) if whole else []
        if not found:
            out.append((*row, None))
        elif not first_left or key not in seen:
            out += [(*row, seq) for seq in found]
        seen.add(key)
    return out


def expected(lefts, rights, first_left, null_safe=False):
    rows = sorted(lefts, key=lambda r: r[3])
    for right in rights:
        rows = pair(rows, right, first_left, null_safe)
    return Counter((r[0], r[1], *r[3:]) for r in rows)


def random_rows(rng, n, hot=0.4):
    rows = []
    for seq in rng.sample(range(10 * n), n):
        if rng.random() < hot:
            uid, dn, sec = 7, "webA", rng.randrange(HOUR)
        else:
            uid = rng.choice([None, 1, 2, 3, 4])
            dn = rng.choice([None, "webA", "webB", "null"])
            sec = rng.randrange(3 * HOUR)
        rows.append((uid, dn, sec, seq))
    return rows


@pytest.mark.parametrize("multiplicity", ["first_left", "left_outer"])
@pytest.mark.parametrize("rows_per_task", [1_000_000, 3])
@pytest.mark.parametrize("sizes", [(25, 20, 15), (30, 20, 0), (30, 0, 20), (3, 40, 2), (40, 2, 30)])
def test_random_rows(spark, multiplicity, rows_per_task, sizes):
    rng = random.Random(str((multiplicity, sizes)))
    tables = [random_rows(rng, n) if n else [] for n in sizes]
    if not tables[1]:
        tables[1] = [(99, "webA", 0, 1)]
    if not tables[2]:
        tables[2] = [(98, "webA", 0, 1)]
    joined = windowed_left_join(
        *sides(spark, *tables), multiplicity=multiplicity, rows_per_task=rows_per_task
    )
    assert result(joined, 3) == expected(tables[0], tables[1:], multiplicity == "first_left")


@pytest.mark.parametrize("multiplicity", ["first_left", "left_outer"])
def test_missing_site_groups_match_as_text(spark, multiplicity):
    rng = random.Random(5)
    tables = [random_rows(rng, 20, hot=0.1), random_rows(rng, 20, hot=0.1)]
    joined = windowed_left_join(
        *sides(spark, *tables), multiplicity=multiplicity, null_safe_keys=True, rows_per_task=3
    )
    want = expected(tables[0], tables[1:], multiplicity == "first_left", null_safe=True)
    assert result(joined, 2) == want


def test_two_members_two_registrations(spark):
    lefts = [(1, "webA", 0, 1), (1, "webA", 5, 2)]
    rights = [(1, "webA", 6, 3), (1, "webA", 7, 4)]
    first = windowed_left_join(*sides(spark, lefts, rights))
    assert result(first, 2) == Counter({(1, "webA", 1, 3): 1, (1, "webA", 1, 4): 1})
    alone = windowed_left_join(*sides(spark, lefts, [(2, "webA", 0, 9)]))
    assert result(alone, 2) == Counter({(1, "webA", 1, None): 1, (1, "webA", 2, None): 1})


def test_bucket_edge(spark):
    lefts, rights = [(1, "webA", HOUR - 1, 1)], [(1, "webA", HOUR + 1, 2)]
    joined = windowed_left_join(*sides(spark, lefts, rights), multiplicity="left_outer")
    assert result(joined, 2) == Counter({(1, "webA", 1, None): 1})


def test_unknown_multiplicity(spark):
    with pytest.raises(ValueError):
        windowed_left_join(*sides(spark, [(1, "a", 0, 1)], [(1, "a", 0, 2)]), multiplicity="all")


def test_hot_group_is_split(spark):
    """No part of a hot group gets much more than its share of rows."""
    from rollcall.operators.skew import hot_groups, part_of

    rows = spark.range(1000).select(F.lit(1).alias("k"), F.col("id").alias("seq"))
    hot = hot_groups(rows, ["k"], 100)
    assert [tuple(r) for r in hot.collect()] == [(1, 10)]
    sizes = (
        rows.join(hot, "k")
        .withColumn("p", part_of("seq", F.col("_parts"), ["k"]))
        .groupBy("p").count().collect()
    )
    assert len(sizes) == 10 and max(r["count"] for r in sizes) < 150
