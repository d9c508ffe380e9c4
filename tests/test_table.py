"""Merging rules and keyed tables."""

import random
from decimal import Decimal

import pytest
from pyspark.sql.types import StructType

from rollcall.operators.merge import MergeRules, merge_rows, split_by_existence, upsert
from rollcall.operators.wide import wide_row, wide_rules
from rollcall.session import scratch_dir
from rollcall.sinks.dims import DimTables, by_rowkey, stored_site, stored_vip
from rollcall.sinks.table import KeyedTable, arrival_schema
from rollcall.schemas import BASE_SITE
from rollcall.streaming.jobs import wide_table

RULES = MergeRules(last=("a",), first=("b",), last_set=("c",), total=("d",))
SCHEMA = (
    StructType().add("k", "integer").add("a", "string").add("b", "string").add("c", "string").add("d", "long")
)
ROW = "k int, a string, b string, c string, d bigint, seq bigint"


def expected(rows):
    out = {}
    for k, a, b, c, d, seq in sorted(rows, key=lambda r: r[-1]):
        if k in out:
            old = out[k]
            out[k] = (a, old[1], old[2] if c is None else c, old[3] + (d or 0))
        else:
            out[k] = (a, b, c, d or 0)
    return out


def make(rng, n):
    def text():
        return rng.choice([None, "x", "y", "z"])

    return [
        (rng.choice([1, 1, 1, 2, 3, 4]), text(), text(), text(), rng.choice([None, 5, 7]), seq)
        for seq in rng.sample(range(10 * n), n)
    ]


def as_dict(df):
    return {r.k: (r.a, r.b, r.c, r.d) for r in df.collect()}


@pytest.mark.parametrize("seed", range(4))
def test_merge_rows(spark, seed):
    rows = make(random.Random(seed), 40)
    merged = merge_rows(spark.createDataFrame(rows, ROW), ["k"], ["seq"], RULES)
    assert as_dict(merged) == expected(rows)


@pytest.mark.parametrize("compact_every", [1, 2, 10])
def test_batches_in_any_order_of_arrival(spark, compact_every):
    """Rows of older arrivals in a later batch do not replace newer ones."""
    rows = make(random.Random(9), 60)
    table = KeyedTable(
        scratch_dir(spark, "table-test"), SCHEMA, ("k",), RULES, buckets=3, compact_every=compact_every
    )
    assert table.version(spark) == -1 and table.current(spark).count() == 0
    for version in range(4):
        batch = spark.createDataFrame(rows[version * 15 : version * 15 + 15], ROW)
        assert table.apply(batch, version)
        assert not table.apply(batch, version)
        assert as_dict(table.current(spark)) == expected(rows[: version * 15 + 15])
    assert not table.apply(batch, 1)
    assert table.version(spark) == 3
    if compact_every < 10:
        assert table.superseded(spark)
    assert as_dict(table.point(spark, k=1)) == {1: expected(rows)[1]}
    table.compact(spark)
    assert as_dict(table.current(spark)) == expected(rows)
    assert table.vacuum(spark) > 0 and not table.superseded(spark)
    assert as_dict(table.current(spark)) == expected(rows)
    assert not table.apply(batch, 3)


def test_empty_batch_counts(spark):
    table = KeyedTable(scratch_dir(spark, "table-test"), SCHEMA, ("k",), RULES)
    assert table.apply(spark.createDataFrame([], ROW), 0)
    assert table.version(spark) == 0 and table.current(spark).count() == 0
    assert not table.apply(spark.createDataFrame([(1, "a", "b", "c", 1, 1)], ROW), 0)


def test_unfinished_batch_is_ignored(spark):
    table = KeyedTable(scratch_dir(spark, "table-test"), SCHEMA, ("k",), RULES)
    rows = [(1, "a", "b", "c", 1, 1)]
    table.apply(spark.createDataFrame(rows, ROW), 0)
    broken = spark.createDataFrame([(1, "lost", "b", "c", 9, 2)], ROW)
    spark.conf.set("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
    try:
        table._write(broken.limit(0), f"batch-{1:012d}--1")
    finally:
        spark.conf.unset("mapreduce.fileoutputcommitter.marksuccessfuljobs")
    assert table.version(spark) == 0
    assert as_dict(table.current(spark)) == expected(rows)


def test_point_opens_one_bucket(spark):
    table = KeyedTable(scratch_dir(spark, "table-test"), SCHEMA, ("k",), RULES, buckets=8)
    table.apply(spark.createDataFrame([(i, "a", "b", "c", 1, i) for i in range(50)], ROW), 0)
    plan = table.point(spark, k=7)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_bucket" in plan
    assert [r.k for r in table.point(spark, k=7).collect()] == [7]


def test_insert_only_columns(spark):
    rules = MergeRules.latest(["a", "b"]).with_rule(first=("b",))
    stored = spark.createDataFrame([(1, "a0", "b0")], "k int, a string, b string")
    incoming = spark.createDataFrame(
        [(1, "a2", "b2", 2), (1, "a1", "b1", 1), (2, "c1", "d1", 1), (2, "c3", "d3", 3)],
        "k int, a string, b string, seq bigint",
    )
    got = {tuple(r) for r in upsert(stored, incoming, ["k"], rules).select("k", "a", "b").collect()}
    assert got == {(1, "a2", "b0"), (2, "c3", "d1")}
    updates, inserts = split_by_existence(stored, incoming, ["k"])
    assert {r.k for r in updates.collect()} == {1} and {r.k for r in inserts.collect()} == {2}


def wide_input(spark, rows):
    names = [
        "uid", "ad_id", "fullname", "iconurl", "mailaddr", "memberlevel", "password", "phone", "qq",
        "register", "regupdatetime", "unitname", "userip", "zipcode", "appkey", "appregurl",
        "bdp_uuid", "regsource", "adname", "siteid", "sitename", "siteurl", "delete",
        "site_createtime", "site_creator", "vip_id", "vip_level", "vip_start_time", "vip_end_time",
        "last_modify_time", "max_free", "min_free", "operator", "paymoney", "dt", "dn",
    ]
    kinds = {"uid": "int", "ad_id": "int", "siteid": "int", "vip_id": "int"}
    schema = ", ".join(f"`{n}` {kinds.get(n, 'string')}" for n in names)
    order = "seq bigint, paymoney_seq bigint, regtype_seq bigint, member_seq bigint"
    data = [tuple(r.get(n) for n in names) + (r["seq"], None, None, r["seq"]) for r in rows]
    return spark.createDataFrame(data, f"{schema}, {order}")


def test_wide_table_keeps_what_blanks_leave_out(spark):
    table = wide_table(scratch_dir(spark, "wide-test"), buckets=2)
    order = ["seq", "paymoney_seq", "regtype_seq", "member_seq"]
    full = {
        "uid": 12, "dn": "webA", "fullname": "n", "sitename": "s", "siteid": 3, "paymoney": "10.50",
        "vip_start_time": "2015-01-01 00:00:00.0", "vip_end_time": "2016-01-01 10:00:00.0", "seq": 1,
    }
    bare = {"uid": 12, "dn": "webA", "fullname": "m", "paymoney": "", "vip_start_time": "", "seq": 2}
    for version, row in enumerate((full, bare)):
        table.apply(wide_row(wide_input(spark, [row]), carry=order), version)
    (row,) = table.current(spark).collect()
    assert row.id == "c20ad12webA"
    assert (row.fullname, row.sitename, row.siteid) == ("m", None, None)
    assert str(row.paymoney) == "10.50"
    assert str(row.vip_start_time) == "2015-01-01 00:00:00"
    assert len(row) == 37
    assert set(wide_rules(dynamic=True).last_set) == set(wide_rules().columns)
    zero = wide_row(wide_input(spark, [bare]), missing_id_as_zero=True).first()
    assert (zero.siteid, zero.vip_id) == (0, 0)


def test_dimension_tables(spark):
    def site(name, creator, seq, delete="0"):
        value = (
            f'{{"siteid":"1","sitename":"{name}","siteurl":"u","delete":"{delete}",'
            f'"createtime":"2000-01-01","creator":"{creator}","dn":"webA"}}'
        )
        return ("basewebsite", value, seq)

    def vip(end, seq, vip_id=1):
        value = (
            f'{{"vip_id":"{vip_id}","vip_level":"gold","start_time":"2015-01-01 00:00:00",'
            f'"end_time":"{end}","last_modify_time":"2016-01-01 00:00:00","dn":"webA","vip_name":"x"}}'
        )
        return ("membervip", value, seq)

    schema = "topic string, value string, seq bigint"
    rows = [site("a", "admin", 1), site("b", "other", 2), vip("2016-01-01 00:00:00", 1),
            vip("soon", 2, vip_id=2), ("unknown", '{"vip_id":"7"}', 3)]
    batch = spark.createDataFrame(rows, schema)
    plain = DimTables(scratch_dir(spark, "dims-test"))
    keeping = DimTables(scratch_dir(spark, "dims-test"), site_insert_only=("createtime", "creator"))
    for tables in (plain, keeping):
        tables.apply(batch, 0)
        tables.apply(batch, 0)
    last = plain.current(spark, "basewebsite").first()
    first = keeping.current(spark, "basewebsite").first()
    assert (last.sitename, last.creator) == ("b", "other")
    assert (first.sitename, first.creator) == ("b", "admin")
    assert sorted(r.vip_id for r in plain.current(spark, "membervip").collect()) == [1, 2]
    times = {r.vip_id: r.end_time for r in plain.lookups(spark)["membervip"].collect()}
    assert times == {1: "2016-01-01 00:00:00.0", 2: None}
    stored = stored_site(plain.current(spark, "basewebsite")).first()
    assert stored.site_id == 1 and stored.delete == 0
    assert str(stored_vip(plain.current(spark, "membervip")).where("vip_id = 1").first().start_time) == "2015-01-01 00:00:00"
    assert by_rowkey(plain.current(spark, "basewebsite"), BASE_SITE).first().rowkey == "1_webA"


def test_arrival_schema_names():
    assert arrival_schema("a", "b").fieldNames() == ["a", "b"]


def test_a_new_writer_goes_on(spark):
    """Another query's batches count from their first; repeated rows change nothing."""
    schema = StructType.fromDDL("k int, v string, amount decimal(38,2)")
    rules = MergeRules(last=("v",), total=("amount",))
    table = KeyedTable(scratch_dir(spark, "writers-test"), schema, ("k",), rules, buckets=2, compact_every=2)
    make = lambda *rows: spark.createDataFrame(
        [(k, v, Decimal(a), seq) for k, v, a, seq in rows], "k int, v string, amount decimal(38,2), seq bigint"
    )
    assert table.apply(make((1, "a", 1, 1), (2, "b", 2, 2)), 0, "one")
    assert table.apply(make((1, "c", 4, 3), (1, "c", 4, 3)), 1, "one")
    assert not table.apply(make((1, "z", 9, 9)), 1, "one")
    assert table.apply(make((1, "a", 1, 1), (1, "c", 4, 3), (3, "d", 8, 4)), 0, "two")
    assert table.apply(make((3, "e", 16, 5)), 1, "two")
    assert (table.version(spark, "one"), table.version(spark, "two"), table.version(spark)) == (1, 1, -1)
    want = [(1, "c", 5), (2, "b", 2), (3, "e", 24)]
    assert sorted((r.k, r.v, int(r.amount)) for r in table.current(spark).collect()) == want
    assert table.vacuum(spark) > 0
    assert not table.apply(make((1, "z", 9, 9)), 1, "one")
    assert sorted((r.k, r.v, int(r.amount)) for r in table.current(spark).collect()) == want
