"""Standing jobs and streaming joins on small inputs fed in several rounds."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from rollcall.operators.join import Side
from rollcall.operators.lookup import LOOKUPS
from rollcall.operators.wide import JOINED_ORDER, total_row
from rollcall.session import scratch_dir, stream_session
from rollcall.streaming.facts import (
    DELAY, LATE_DELAY, SHORT_WINDOW, join_closed, stream_closed_rows, stream_first_left_join, stream_left_join,
)
from rollcall.streaming.jobs import ALL_AVAILABLE, once_per_batch, total_table

SCHEMA = "uid int, dn string, ts timestamp, seq bigint"


def put(spark, path, rows):
    df = spark.createDataFrame(rows, "uid int, dn string, sec bigint, seq bigint")
    df.select("uid", "dn", F.timestamp_seconds("sec").alias("ts"), "seq").write.mode("append").parquet(path)


def stream(sibling, path, name, size="10 minutes", delay="10 seconds"):
    df = sibling.readStream.schema(SCHEMA).parquet(path).withWatermark("ts", delay)
    return df.select("uid", "dn", F.window("ts", size).alias("window"), F.col("seq").alias(name))


@pytest.mark.parametrize("parts", [1, 3])
def test_left_join_in_parts(spark, parts):
    root, sibling = scratch_dir(spark, "parts-test"), stream_session(spark, 2)
    lefts = [(1, "webA", i, i) for i in range(6)] + [(2, "webA", 5, 10), (3, "webB", 700, 11)]
    rights = [(1, "webA", 7, 20), (1, "webA", 8, 21), (3, "webB", 100, 22)]
    want = Counter({(1, i, r): 1 for i in range(6) for r in (20, 21)})
    want.update({(2, 10, None): 1, (3, 11, None): 1})
    put(spark, f"{root}/l", lefts)
    put(spark, f"{root}/r", rights)
    joined = stream_left_join(
        stream(sibling, f"{root}/l", "l_seq"), stream(sibling, f"{root}/r", "r_seq"),
        parts=parts, order="l_seq",
    ).select("uid", "l_seq", "r_seq")

    def run():
        writer = joined.writeStream.format("parquet").option("path", f"{root}/out")
        writer = writer.option("checkpointLocation", f"{root}/cp").trigger(availableNow=True)
        writer.start().awaitTermination()

    run()
    put(spark, f"{root}/l", [(-1, "webA", 10_000, 90)])
    put(spark, f"{root}/r", [(-2, "webA", 10_000, 91)])
    run()
    rows = spark.read.parquet(f"{root}/out").collect()
    assert Counter(tuple(r) for r in rows) == want


@pytest.mark.parametrize("delay, kept", [(LATE_DELAY, range(5)), (DELAY, [])])
def test_two_minutes_of_lateness(spark, delay, kept):
    """Ten members; half the registrations come 90 seconds late, half much later."""
    root, sibling = scratch_dir(spark, "late-test"), stream_session(spark, 2)
    put(spark, f"{root}/l", [(u, "webA", 1000 + u, u) for u in range(10)])
    joined = None

    def run(lefts, rights):
        nonlocal joined
        put(spark, f"{root}/l", lefts)
        put(spark, f"{root}/r", rights)
        if joined is None:
            joined = stream_left_join(
                stream(sibling, f"{root}/l", "l_seq", SHORT_WINDOW, delay),
                stream(sibling, f"{root}/r", "r_seq", SHORT_WINDOW, delay),
            ).select("uid", "r_seq")
        writer = joined.writeStream.format("parquet").option("path", f"{root}/out")
        writer = writer.option("checkpointLocation", f"{root}/cp").trigger(availableNow=True)
        writer.start().awaitTermination()

    run([(-1, "webA", 1100, 90)], [(-2, "webA", 1100, 91)])
    run([], [(u, "webA", 1001, 20 + u) for u in range(5)])
    run([(-3, "webA", 2000, 92)], [(-4, "webA", 2000, 93)])
    run([], [(u, "webA", 1001, 20 + u) for u in range(5, 10)])
    run([(-5, "webA", 9000, 94)], [(-6, "webA", 9000, 95)])
    rows = spark.read.parquet(f"{root}/out").where("uid >= 0").collect()
    assert {r.uid: r.r_seq for r in rows} == {u: 20 + u if u in kept else None for u in range(10)}
    assert len(rows) == 10


def looked_up(spark, rows):
    names = [
        "uid", "dn", "paymoney", "fullname", "ad_id", "siteid", "vip_id", "createtime", *JOINED_ORDER,
    ]
    ints = {"uid", "ad_id", "siteid", "vip_id"}
    schema = ", ".join(
        f"{n} {'bigint' if n in JOINED_ORDER else 'int' if n in ints else 'string'}" for n in names
    )
    df = spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schema)
    rest = [
        "birthday", "email", "iconurl", "lastlogin", "mailaddr", "memberlevel", "password", "phone",
        "qq", "register", "regupdatetime", "unitname", "userip", "zipcode", "appkey", "appregurl",
        "bdp_uuid", "isranreg", "regsource", "websiteid", "dt",
    ] + [c for s in LOOKUPS for c in s.columns.values()]
    return df.withColumns({c: F.lit("-") for c in rest})


def test_totals_add_up_and_first_row_stays(spark):
    table = total_table(scratch_dir(spark, "totals-test"), buckets=2)
    batches = [
        [{"uid": 1, "dn": "webA", "paymoney": "10.50", "fullname": "a", "seq": 1, "member_seq": 1, "paymoney_seq": 1}],
        [
            {"uid": 1, "dn": "webA", "paymoney": "10.50", "fullname": "b", "seq": 2, "member_seq": 1, "paymoney_seq": 2},
            {"uid": 1, "dn": "webA", "paymoney": "10.50", "fullname": "b", "seq": 2, "member_seq": 2, "paymoney_seq": 2},
            {"uid": 1, "dn": "webA", "paymoney": "", "fullname": "c", "seq": 3, "member_seq": 1},
            {"uid": 2, "dn": "webA", "paymoney": None, "fullname": "d", "seq": 4, "member_seq": 4},
        ],
    ]
    for version, rows in enumerate(batches):
        batch = total_row(looked_up(spark, rows), carry=JOINED_ORDER)
        assert table.apply(batch, version)
        assert not table.apply(batch, version)
    got = {r.uid: (r.fullname, str(r.paymoney)) for r in table.current(spark).collect()}
    assert got == {1: ("a", "21.00"), 2: ("d", "0.00")}
    assert len(table.current(spark).columns) == 41


def test_rows_of_closed_windows_join_as_the_stream_does(spark):
    """Three sides in rounds: a hot member, missing keys, a late row, a restart before a window closes."""
    root, sibling = scratch_dir(spark, "closed-test"), stream_session(spark, 2)
    names = ("a_seq", "b_seq", "c_seq")
    rounds = [
        [
            [(1, "webA", i, i) for i in range(20)] + [(None, "webA", 5, 50), (2, None, 6, 51), (3, "webA", 7, 52)],
            [(1, "webA", 9, 61), (1, "webA", 8, 60), (4, "webA", 9, 62), (2, None, 9, 63)],
            [(1, "webA", i, 70 + i) for i in range(5)],
        ],
        [[(3, "webA", 300, 53), (5, "webB", 650, 54)], [(3, "webA", 310, 64)], [(5, "webB", 660, 80)]],
        [[(-1, "webA", 10_000, 90)], [(-2, "webA", 10_000, 91)], [(-3, "webA", 10_000, 92)]],
        [[(1, "webA", 3, 93)], [(1, "webA", 3, 94)], [(5, "webB", 661, 95)]],
        [[(-4, "webA", 20_000, 96)], [(-5, "webA", 20_000, 97)], [(-6, "webA", 20_000, 98)]],
    ]
    shown = ["uid", "dn", "window.start", *names]
    got, operators = Counter(), set()

    def handle(frame, batch_id, query_id):
        got.update(tuple(r) for r in join_closed(frame, names).select(*shown).collect())

    for fed in rounds:
        for name, rows in zip(names, fed):
            put(spark, f"{root}/{name}", rows)
        sides = [Side(stream(sibling, f"{root}/{name}", name), name) for name in names]
        closed = once_per_batch(stream_closed_rows(*sides), f"{root}/closed", handle, ALL_AVAILABLE)
        closed.awaitTermination()
        operators |= {len(p["stateOperators"]) for p in closed.recentProgress}
        joined = stream_first_left_join(*sides).select(*shown).writeStream.format("parquet").option("path", f"{root}/out")
        joined.option("checkpointLocation", f"{root}/joined").trigger(**ALL_AVAILABLE).start().awaitTermination()
    assert got == Counter(tuple(r) for r in spark.read.parquet(f"{root}/out").collect())
    hot = {r[3:] for r in got if r[0] == 1}
    assert hot == {(0, 60, 70 + i) for i in range(5)} and sum(got.values()) == 10
    assert operators == {1}
