"""Lookups: both join strategies, guards, refresh."""

import os
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from rollcall.operators.lookup import AD_LOOKUP, DimSpec, enrich, fill_blank, latest_per_key, lookup, measure
from rollcall.session import scratch_dir, staged, stream_session
from rollcall.streaming.refresh import DimSnapshots


@pytest.fixture(scope="module")
def ads(spark):
    rows = [(i, f"ad{i}", dn, i) for i in range(10) for dn in ("webA", "webB")]
    return spark.createDataFrame(rows, "adid int, adname string, dn string, seq bigint")


def facts(spark):
    rng = random.Random(1)
    rows = [
        (
            rng.choice([3, 3, 3, None, 12, 1, 5]),
            rng.choice(["webA", "webA", "webB", "webC", None]),
            seq,
        )
        for seq in range(200)
    ]
    return rows, spark.createDataFrame(rows, "ad_id int, dn string, seq bigint")


@pytest.mark.parametrize("bounds", [{}, {"max_rows": 0, "rows_per_task": 7}, {"max_bytes": 1}])
def test_each_strategy_gives_every_fact_once(spark, ads, bounds):
    rows, df = facts(spark)
    got = Counter(tuple(r) for r in lookup(df, ads, AD_LOOKUP, **bounds).select("ad_id", "dn", "seq", "adname").collect())
    known = {(i, dn): f"ad{i}" for i in range(10) for dn in ("webA", "webB")}
    assert got == Counter((a, dn, s, known.get((a, dn))) for a, dn, s in rows)


def test_size_check(spark, ads):
    width = 20 * 4 * 16 + 20 * (len("ad1") + len("webA"))
    assert measure([ads, ads.limit(0)]) == [(20, width), (0, 0)]


def test_large_dimension_is_not_broadcast(spark, ads):
    _, df = facts(spark)
    small = lookup(df, ads, AD_LOOKUP)
    assert "BroadcastHashJoin" in small._jdf.queryExecution().toString()
    hint = lookup(df, ads, AD_LOOKUP, max_rows=0)
    plan = hint._jdf.queryExecution().logical().toString()
    assert "broadcast" not in plan.lower()


@pytest.mark.parametrize("bounds", [{"max_rows": 0}, {"max_bytes": 1, "rows_per_task": 7}])
def test_large_dimension_of_small_files_is_shuffled(spark, ads, bounds):
    """Spark would broadcast it for the size of its files, which repeated texts make small."""
    _, df = facts(spark)
    plan = lookup(df, staged(ads, "ads"), AD_LOOKUP, **bounds)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin [ad_id" in plan
    assert "BroadcastHashJoin [ad_id" not in plan.partition("SortMergeJoin [ad_id")[0]


def test_large_dimension_of_a_stream_is_shuffled(spark, ads):
    root = scratch_dir(spark, "stream-lookup")
    rows, df = facts(spark)
    df.write.parquet(f"{root}/facts")
    sibling = stream_session(spark, 2)
    dim = sibling.read.parquet(staged(ads, "ads").staged_path)
    found = lookup(sibling.readStream.schema(df.schema).parquet(f"{root}/facts"), dim, AD_LOOKUP, max_rows=0)
    query = (
        found.writeStream.format("parquet").option("path", f"{root}/out")
        .option("checkpointLocation", f"{root}/cp").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    plan = query._jsq.explainInternal(False)
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    assert spark.read.parquet(f"{root}/out").count() == len(rows)


def test_last_row_of_a_key_wins(spark):
    dim = spark.createDataFrame(
        [(1, "old", "webA", 1), (1, "new", "webA", 5), (1, "older", "webA", 0)],
        "adid int, adname string, dn string, seq bigint",
    )
    assert [r.adname for r in latest_per_key(dim, ["adid", "dn"]).collect()] == ["new"]


def test_fill_blank(spark):
    df = spark.createDataFrame([(None, 1), ("x", None)], "a string, b int")
    assert {tuple(r) for r in fill_blank(df, ["a", "b"]).collect()} == {("", "1"), ("x", "")}


def test_snapshots_are_read_again_after_the_interval(spark):
    now, loads = [0.0], []
    load = lambda: loads.append(1) or {"n": spark.range(len(loads))}
    snapshots = DimSnapshots(load, 10, clock=lambda: now[0])
    first = snapshots.get()["n"]
    assert first.count() == 1
    now[0] = 9.9
    assert snapshots.get()["n"] is first
    now[0] = 10.0
    assert snapshots.get()["n"].count() == 2
    assert not os.path.exists(first.staged_path)


def test_zero_interval_reads_every_time(spark):
    loads = []
    snapshots = DimSnapshots(lambda: loads.append(1) or {"n": spark.range(len(loads))}, 0)
    assert [snapshots.get()["n"].count() for _ in range(3)] == [1, 2, 3]


def test_chain_keeps_facts(spark, ads):
    spec = DimSpec("basead", "ad_id", "adid", {"adname": "first"})
    again = DimSpec("basead", "ad_id", "adid", {"adname": "second"})
    rows, df = facts(spark)
    out = enrich(df, {"basead": ads}, specs=(spec, again))
    assert out.count() == len(rows)
    assert out.where(~F.col("first").eqNullSafe(F.col("second"))).count() == 0
