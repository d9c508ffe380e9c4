"""The arrival changelog against a literal replay of every arrival."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from rollcall.operators.changelog import arrival_changelog, arrival_changelog_twice, expand, running, stretches
from rollcall.operators.join import Side
from rollcall.streaming.changelog import stream_changelog
from rollcall.streaming.retractions import folded, stream_changes
from rollcall.session import scratch_dir, stream_session


def replay(arrivals):
    """Every emission: after each arrival the whole group comes out again."""
    out, panes = [], {}
    for seq, side, uid, dn, sec in sorted(arrivals):
        if uid is None or dn is None:
            if side == "left":
                out.append((uid, dn, seq, None, 1))
            continue
        pane = panes.setdefault((uid, dn, sec // 3600), ([], []))
        pane[side == "right"].append(seq)
        lefts, rights = pane
        number = len(lefts) + len(rights)
        if lefts and rights:
            out += [(uid, dn, lefts[0], r, number) for r in rights]
        else:
            out += [(uid, dn, left, None, number) for left in lefts]
    return Counter(out)


def side(spark, arrivals, which):
    name = f"{which}_seq"
    rows = [(a[2], a[3], a[4], a[0]) for a in arrivals if a[1] == which]
    df = spark.createDataFrame(rows, f"uid int, dn string, sec bigint, {name} bigint")
    df = df.withColumn("window", F.window(F.timestamp_seconds("sec"), "1 hour"))
    return Side(df.select("uid", "dn", "window", name), name)


def arrivals(rng, n):
    return [
        (
            seq,
            rng.choice(["left", "right"]),
            rng.choice([1, 1, 1, 2, 3, None]),
            rng.choice(["webA", "webB"]),
            rng.randrange(2 * 3600),
        )
        for seq in rng.sample(range(5 * n), n)
    ]


@pytest.mark.parametrize("chunk", [1, 7, 1_000_000])
@pytest.mark.parametrize("n", [12, 60])
def test_replay(spark, chunk, n):
    rows = arrivals(random.Random(n), n)
    log = arrival_changelog(
        side(spark, rows, "left"), side(spark, rows, "right"), arrivals_per_chunk=chunk
    )
    columns = ["uid", "dn", "left_seq", "right_seq", "arrival"]
    got = Counter(tuple(r) for r in expand(log).select(*columns).collect())
    assert got == replay(rows)
    # The compact form has one row per distinct emitted row.
    assert log.count() == len({r[:4] for r in replay(rows)})


def test_stream_first_emissions(spark):
    """Fed in three rounds, the stream emits each row at its first arrival."""
    rows = [a for a in sorted(arrivals(random.Random(3), 60)) if a[2] is not None]
    want = {}
    for (uid, dn, left, right, number), _ in replay(rows).items():
        key = (uid, dn, left, right)
        want[key] = min(number, want.get(key, number))
    root = scratch_dir(spark, "changelog-test")
    sibling = stream_session(spark, 4)
    schema = "uid int, dn string, ts timestamp, seq bigint"
    for part in (rows[:20], rows[20:40], rows[40:]):
        for which in ("left", "right"):
            data = [(a[2], a[3], a[4], a[0]) for a in part if a[1] == which]
            df = spark.createDataFrame(data, "uid int, dn string, sec bigint, seq bigint")
            df = df.select("uid", "dn", F.timestamp_seconds("sec").alias("ts"), "seq")
            df.write.mode("append").parquet(f"{root}/{which}")
        inputs = []
        for which in ("left", "right"):
            df = sibling.readStream.schema(schema).parquet(f"{root}/{which}")
            df = df.withWatermark("ts", "3 hours").withColumn("window", F.window("ts", "1 hour"))
            inputs.append(df.drop("ts"))
        (
            stream_changelog(*inputs)
            .writeStream.format("parquet")
            .option("path", f"{root}/out")
            .option("checkpointLocation", f"{root}/cp")
            .trigger(availableNow=True)
            .start()
            .awaitTermination()
        )
    out = spark.read.parquet(f"{root}/out").select(
        "uid",
        "dn",
        F.get_json_object("left_row", "$.seq").cast("int"),
        F.get_json_object("right_row", "$.seq").cast("int"),
        "first_arrival",
    )
    got = Counter(tuple(r) for r in out.collect())
    assert got == Counter((*k, n) for k, n in want.items())


def replay_twice(arrivals):
    """Both joins fire at every arrival; each row the first emits is an arrival of the second."""
    out, panes = [], {}
    for seq, which, uid, dn, sec in sorted(arrivals):
        if uid is None:
            if which == "left":
                out.append((uid, seq, None, None, 1))
            continue
        lefts, rights, elements, paid = panes.setdefault((uid, dn, sec // 3600), ([], [], [], []))
        new = []
        if which == "last":
            new = [(None, None, seq)]
        else:
            (lefts if which == "left" else rights).append(seq)
            if rights:
                new = [(lefts[0], r, None) for r in rights if lefts]
            else:
                new = [(left, None, None) for left in lefts]
        for row in new:
            (paid if which == "last" else elements).append(row)
            number = len(paid) + len(elements)
            if not paid:
                out += [(uid, *e, number) for e in elements]
            elif elements:
                out += [(uid, *elements[0][:2], p[2], number) for p in paid]
    return Counter(out)


@pytest.mark.parametrize("chunk", [3, 1_000_000])
@pytest.mark.parametrize("seed", [1, 2, 3])
def test_replay_twice(spark, seed, chunk):
    rng = random.Random(seed)
    rows = [
        (seq, rng.choice(["left", "right", "last"]), rng.choice([1, 1, 2, 3, 4, 5, None]), "webA", rng.randrange(7200))
        for seq in rng.sample(range(10**12), 70)
    ]
    log = arrival_changelog_twice(*[side(spark, rows, w) for w in ("left", "right", "last")], arrivals_per_chunk=chunk)
    want = {}
    for (uid, *row, number), n in replay_twice(rows).items():
        first, last, count = want.get((uid, *row), (number, number, 0))
        want[(uid, *row)] = (min(first, number), max(last, number), count + n)
    got = {
        (r.uid, r.left_seq, r.right_seq, r.last_seq): (r.first_arrival, r.last_arrival, r.emissions) for r in log.collect()
    }
    assert got == want


def test_stretches_by_count(spark):
    """A group lies in as many stretches as its rows ask for, however far apart its order numbers are."""
    rows = spark.createDataFrame([(1, (i << 40) + i) for i in range(4000)] + [(2, 5)], "k int, o bigint").repartition(5)
    cut = stretches(rows, ["k"], "o", 500)
    assert 6 <= cut.where("k = 1").select("_chunk").distinct().count() <= 9
    sums = running(cut, ["k"], "o", n=F.lit(1), s=F.col("o") % 7).collect()
    total = 0
    for number, r in enumerate(sorted((r for r in sums if r.k == 1), key=lambda r: r.o), 1):
        total += r.o % 7
        assert (r.n, r.s) == (number, total)


def test_short_stretches_share_tasks(spark):
    """The number of tasks goes by rows, not by stretches."""
    rows = spark.createDataFrame([(i % 3, i) for i in range(4000)], "k int, o bigint").repartition(5)
    cut = stretches(rows, ["k"], "o", 10)
    assert cut.rdd.getNumPartitions() == 1
    sizes = cut.groupBy("k", "_chunk").count()
    assert sizes.agg(F.max("count")).first()[0] <= 10 and sizes.count() <= 403
    sums = running(cut, ["k"], "o", n=F.lit(1))
    assert sums.where("n <> floor(o / 3) + 1").count() == 0


@pytest.mark.parametrize("make", [stream_changelog, stream_changes])
def test_members_share_states(spark, make):
    """A call and a state for many members, with the rows that each member would have alone; no uid is one of them."""
    root = scratch_dir(spark, "shares-test")
    uids = [None, *range(60)]
    for which, step in (("left", 0), ("right", 1)):
        data = [(u, "a", 10 + step, 10 * i + step) for i, u in enumerate(uids) if which == "left" or i % 2]
        df = spark.createDataFrame(data, "uid int, dn string, sec bigint, seq bigint")
        df.select("uid", "dn", F.timestamp_seconds("sec").alias("ts"), "seq").write.parquet(f"{root}/{which}")
    sibling = stream_session(spark, 2)
    inputs = []
    for which in ("left", "right"):
        df = sibling.readStream.schema("uid int, dn string, ts timestamp, seq bigint").parquet(f"{root}/{which}")
        inputs.append(df.withWatermark("ts", "3 hours").withColumn("window", F.window("ts", "1 hour")).drop("ts"))
    query = (
        make(*inputs, shares=8).writeStream.format("parquet").option("path", f"{root}/out")
        .option("checkpointLocation", f"{root}/cp").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert 1 < max(p.stateOperators[0].numRowsTotal for p in query.recentProgress) <= 8
    seq = [F.get_json_object(f"{side}_row", "$.seq").cast("int").alias(side) for side in ("left", "right")]
    got = spark.read.parquet(f"{root}/out").select("*", *seq)
    if make is stream_changes:
        got = folded(got, "uid", "left", "right").where("present")
    else:
        got = got.where("right is not null or left % 20 = 0")
    want = [(u, 10 * i, 10 * i + 1 if i % 2 else None) for i, u in enumerate(uids)]
    assert Counter((r.uid, r.left, r.right) for r in got.collect()) == Counter(want)
