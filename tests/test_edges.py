"""Options of outside systems, console, log decoding."""

import pytest
from pyspark.sql import functions as F

from rollcall.functions.times import event_time
from rollcall.operators.skew import part_of
from rollcall.session import scratch_dir, stream_session
from rollcall.sinks.topics import console_writer, file_writer, kafka_write_options
from rollcall.sources.envelope import decode, file_envelope, kafka_read_options
from rollcall.sources.jdbc import jdbc_options


def test_kafka_options():
    options = kafka_read_options("h1:9092,h2:9092", "basead, member", max_offsets=500, group_id="g")
    assert options == {
        "kafka.bootstrap.servers": "h1:9092,h2:9092",
        "subscribe": "basead,member",
        "startingOffsets": "earliest",
        "maxOffsetsPerTrigger": "500",
        "kafka.group.id": "g",
    }
    assert kafka_read_options("h", ["a", "b"], starting="latest")["subscribe"] == "a,b"
    with pytest.raises(ValueError):
        kafka_read_options("h", "a")
    assert kafka_write_options("h", "/c")["checkpointLocation"] == "/c"


def test_jdbc_options():
    options = jdbc_options(
        "jdbc:postgresql://h/db", "dim", partition_column="id", bounds=(0, 99), partitions=4, user="u"
    )
    assert options["dbtable"] == "dim" and options["pushDownPredicate"] == "true"
    assert (options["lowerBound"], options["upperBound"], options["numPartitions"]) == ("0", "99", "4")
    assert options["user"] == "u"


def test_decode(spark):
    log = spark.createDataFrame(
        [("member", bytearray('{"n":"王"}', "utf-8"), 2, 5), ("member", None, 0, 6)],
        "topic string, value binary, partition int, offset bigint",
    )
    rows = decode(log).collect()
    assert [r.value for r in rows] == ['{"n":"王"}', None]
    assert len({r.seq for r in rows}) == 2


def test_console_and_files(spark):
    root = scratch_dir(spark, "edges-test")
    rows = spark.range(10).select(
        F.concat(F.lit("t"), F.col("id") % 2).alias("topic"), F.lit("{}").alias("value"),
        F.col("id").alias("seq"),
    )
    rows.repartition(4).write.parquet(f"{root}/in")
    assert file_envelope(spark, f"{root}/in", stream=False).count() == 10
    stream = file_envelope(stream_session(spark, 2), f"{root}/in", max_files=2)
    console_writer(stream, lines=1).trigger(availableNow=True).start().awaitTermination()
    query = file_writer(stream, f"{root}/cp", f"{root}/out").trigger(availableNow=True).start()
    query.awaitTermination()
    out = spark.read.parquet(f"{root}/out")
    assert {r.topic: r.n for r in out.groupBy("topic").agg(F.count("*").alias("n")).collect()} == {"t0": 5, "t1": 5}


def test_times_out_of_range_are_null(spark):
    df = spark.createDataFrame([("9223372036854775807",), ("-9223372036854775808",), ("1000",), ("x",)], "t string")
    got = [r[0] for r in df.select(event_time("t").cast("bigint")).collect()]
    assert got == [None, None, 1, None]


def test_bad_bytes_are_replaced(spark):
    df = spark.createDataFrame([("t", b"a\xffb", 1, 2)], "topic string, value binary, partition int, offset bigint")
    assert decode(df).first().value == "a\ufffdb"


def test_parts_of_one_partition_are_even(spark):
    keys = F.lit(1).alias("k")
    rows = spark.range(1000).select(keys, (F.col("id") * 65536 + 3).alias("seq"))
    counts = rows.groupBy(part_of("seq", F.lit(8), ["k"])).count().collect()
    assert len(counts) == 8 and max(r["count"] for r in counts) < 200
