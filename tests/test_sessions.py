"""Sessions made in stretches are those of Spark's session windows."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from rollcall.operators.sessions import session_counts, sliding_counts


def rows(df):
    return Counter(tuple(r) for r in df.select("k", "session.start", "session.end", "n").collect())


@pytest.mark.parametrize("stretch", ["10 seconds", "1 minute", "1 hour"])
@pytest.mark.parametrize("spread", [60, 600])
def test_stretches(spark, stretch, spread):
    rng = random.Random(spread)
    data = [(rng.choice("aab"), rng.randrange(spread)) for _ in range(80)]
    df = spark.createDataFrame(data, "k string, sec bigint").select(
        "k", F.timestamp_seconds("sec").alias("ts")
    )
    plain = df.groupBy("k", F.session_window("ts", "5 seconds").alias("session")).agg(
        F.count(F.lit(1)).alias("n")
    )
    assert rows(session_counts(df, ["k"], stretch=stretch)) == rows(plain)


def test_sliding(spark):
    df = spark.createDataFrame([("a", 12)], "k string, sec bigint")
    df = df.select("k", F.timestamp_seconds("sec").alias("ts"))
    starts = sliding_counts(df, ["k"]).select(F.unix_timestamp("window.start").alias("s"), "n")
    assert sorted(tuple(r) for r in starts.collect()) == [(5, 1), (10, 1)]
