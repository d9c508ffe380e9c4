"""Scalar functions on hand-picked values."""

import pytest
from pyspark.sql import functions as F

from rollcall import functions as R
from rollcall.operators.route import (
    dimension_side, fact_side, keep_json_objects, quarantine, to_second_layer, unknown_dimensions,
)
from rollcall.schemas import FULL_COLUMNS, MEMBER, PAYMONEY, RECORDS, WIDE_COLUMNS
from rollcall.sources.tables import scan_rowkeys, scan_where
from rollcall.sources.typed import parse_record

OBJECTS = ['{"a":1}', "{}", ' {"a":{"b":1}} \n', '{"a":[{"b":1}]}', "{'a':1}", "{a:1}", '{"a":[{"b":1},{"c":2}]}']
OTHERS = [
    "[1]", "null", "", "{bad", "5", '"s"', '[{"a":1}]', None, '{"a":1}x', '{"a":1}]', '{"a":1}}',
    '{"a":1},{"b":2}', '{"a":1}]}', '{"a":1', '{"a":1} {"b":2}', '{"a":1},"x":2}', '{"a":tru}',
    '{"a":1}]}]', '{"a":1}, {"b":2}]x', "   ", '{"a":1},"v":{"b":2}',
]


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


@pytest.mark.parametrize("text", OBJECTS + OTHERS)
def test_json_objects(spark, text):
    assert one(spark, R.is_json_object(F.lit(text).cast("string"))) is (text in OBJECTS)


def test_records_drop_what_is_no_object(spark):
    rows = [("memberpaymoney", '{"uid":"1","createtime":"5"}' + t, i) for i, t in
            enumerate(["", " ", "x", ',{"uid":"2","createtime":"5"}', "]", "}", '],{"uid":"3"}'])]
    df = spark.createDataFrame(rows, "topic string, value string, seq bigint")
    assert sorted(r.seq for r in parse_record(df, PAYMONEY).collect()) == [0, 1]
    assert sorted(r.seq for r in keep_json_objects(df).collect()) == [0, 1]
    assert sorted(r.seq for r in quarantine(df).collect()) == [2, 3, 4, 5, 6]


def test_typed_record(spark):
    rows = [
        ("member", '{"uid":"12","ad_id":3,"register":"1000","username":"x","dn":"webA"}', 1),
        ("member", '{"uid":" 13 ","ad_id":"","register":"1000"}', 2),
        ("member", '{"uid":"abc","register":"1000"}', 3),
        ("member", '{"register":"1000"}', 4),
        ("member", '{"uid":"5","register":"soon"}', 5),
        ("other", '{"uid":"5","register":"1000"}', 6),
    ]
    df = spark.createDataFrame(rows, "topic string, value string, seq bigint")
    typed = parse_record(df, MEMBER)
    assert typed.columns == [*MEMBER.fields, "seq"]
    got = {r.seq: (r.uid, r.ad_id, r.dn) for r in typed.collect()}
    assert got == {1: (12, 3, "webA"), 2: (13, None, None)}
    reasons = {r.seq: r.reason for r in quarantine(df).collect()}
    assert reasons == {3: "bad uid", 4: "no uid", 5: "bad register"}


def test_routing(spark):
    rows = [("basead", "{}", 1), ("member", "{}", 2), ("new", "{}", 3), (None, "{}", 4)]
    df = spark.createDataFrame(rows, "topic string, value string, seq bigint")
    assert [r.seq for r in dimension_side(df).collect()] == [1]
    assert sorted(r.seq for r in fact_side(df).collect()) == [2, 3, 4]
    assert {r.seq: r.reason for r in unknown_dimensions(df).collect()} == dict.fromkeys(
        (2, 3, 4), "no dimension topic"
    )
    second = to_second_layer(fact_side(df)).orderBy("seq").collect()
    assert [(r.topic, r.key) for r in second] == [("dwdmember", None), ("dwdnew", None), (None, None)]


@pytest.mark.parametrize(
    "number, text",
    [(607649792, "36.56.0.0"), (-1950089216, "139.196.0.0"), (0, "0.0.0.0"), (-1, "255.255.255.255")],
)
def test_ipv4(spark, number, text):
    assert one(spark, R.int_to_ipv4(F.lit(number))) == text


def test_keys(spark):
    assert one(spark, R.salted_row_key(F.lit(12), F.lit("webA"))) == "c20ad12webA"
    assert one(spark, R.composite_key(F.lit(3), F.lit("webB"))) == "3_webB"
    assert one(spark, R.composite_key(F.lit(3), F.lit(None).cast("string"))) is None


@pytest.mark.parametrize(
    "amount, text", [(1.015, "1.01"), (0.125, "0.12"), (0.375, "0.38"), (1234567.891, "1234567.89"), (0.0, "0.00")]
)
def test_money_text(spark, amount, text):
    assert one(spark, R.money_text(F.lit(amount))) == text


def test_money_and_times(spark):
    assert one(spark, R.money(F.lit(""))) is None
    assert str(one(spark, R.money(F.lit(" 10.50 ")))) == "10.50"
    assert one(spark, R.to_time(F.lit("soon"))) is None
    stamp = F.lit("2024-01-02 03:04:05").cast("timestamp")
    assert one(spark, R.timestamp_text(stamp)) == "2024-01-02 03:04:05.0"
    assert one(spark, R.timestamp_text(F.lit("2024-01-02 03:04:05.120").cast("timestamp"))) == "2024-01-02 03:04:05.12"
    assert one(spark, R.partition_date(F.lit("2024-01-05").cast("date"))) == "20231228"
    assert one(spark, R.to_millis(R.event_time(F.lit("1704067200123")))) == 1704067200123
    assert one(spark, R.event_time(F.lit("x"))) is None


def test_json_fields(spark):
    body = F.lit('{"a":" 7 ","b":""}')
    assert one(spark, R.json_int(body, "a")) == 7
    assert one(spark, R.json_int(body, "b")) is None
    assert one(spark, R.json_int(body, "c", default=0)) == 0
    assert one(spark, R.json_text(body, "b")) == ""
    assert one(spark, R.record_json(F.lit(1).alias("x"), F.lit(None).cast("string").alias("y"))) == '{"x":1}'


def test_layouts():
    assert len(WIDE_COLUMNS) == 37 and len(FULL_COLUMNS) == 41
    assert [len(RECORDS[t].fields) for t in RECORDS] == [20, 10, 7, 3, 7, 10]


def test_point_scans_reach_the_files(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/supplier.parquet")
    df = scan_where(table, ["s_name"], s_suppkey=3, s_nationkey=5)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(s_suppkey,3)" in plan and "EqualTo(s_nationkey,5)" in plan
    assert "s_acctbal" not in plan
    keyed = table.withColumn("rowkey", R.composite_key("s_suppkey", F.lit("webA")))
    rows = scan_rowkeys(keyed, ["1_webA", "2_webA", "none"], ["s_name"])
    assert {r.rowkey for r in rows.collect()} == {"1_webA", "2_webA"}
    assert len(scan_rowkeys(keyed, ["1_webA"]).columns) == 5
