"""Tables whose columns come with the data."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rollcall.session import scratch_dir
from rollcall.sinks import columns
from rollcall.sinks.columns import OpenTable, json_cells

KEY = StructType().add("uid", "integer").add("dn", "string")
ROW = "uid int, dn string, seq bigint, value string"


def batch(spark, *rows):
    return spark.createDataFrame(rows, ROW).withColumn("cells", json_cells("value")).drop("value")


@pytest.fixture
def table(spark):
    return OpenTable(scratch_dir(spark, "open-test"), KEY, buckets=3, compact_every=2)


def as_dict(df):
    return {(r.uid, r.dn): {c: r[c] for c in df.columns if c not in ("uid", "dn")} for r in df.collect()}


def test_columns_appear(spark, table):
    assert table.current(spark).columns == ["uid", "dn"] and table.current(spark).count() == 0
    first = batch(spark, (1, "a", 1, '{"uid":"1","x":"old"}'), (2, "a", 2, '{"x":""}'), (3, None, 3, "{}"), (4, "a", 4, None))
    assert table.apply(first, 0) and not table.apply(first, 0)
    assert as_dict(table.current(spark)) == {(1, "a"): {"x": "old"}, (2, "a"): {"x": ""}, (3, None): {"x": None}, (4, "a"): {"x": None}}
    table.apply(batch(spark, (1, "a", 9, '{"x":null,"y":5}'), (3, None, 8, '{"y":{"z":[1]}}')), 1)
    table.apply(batch(spark, (1, "a", 7, '{"y":"late","w":true,"x":"new"}'), (1, "a", 6, '{"x":"older"}')), 2)
    want = {
        (1, "a"): {"w": "true", "x": "new", "y": "5"},
        (2, "a"): {"w": None, "x": "", "y": None},
        (3, None): {"w": None, "x": None, "y": '{"z":[1]}'},
        (4, "a"): {"w": None, "x": None, "y": None},
    }
    assert as_dict(table.current(spark)) == want
    assert as_dict(table.point(spark, uid=1, dn="a")) == {(1, "a"): want[1, "a"]}
    assert as_dict(table.point(spark, uid=3, dn=None)) == {(3, None): want[3, None]}
    assert table.point(spark, uid=7, dn="a").count() == 0
    since = {r["_name"]: r["_since"] for r in table.names.current(spark).collect()}
    assert since == {"x": 0, "y": 1, "w": 2}
    assert table.cells.vacuum(spark) and as_dict(table.current(spark)) == want


def test_a_batch_lost_between_the_tables(spark, table, monkeypatch):
    rows = batch(spark, (1, "a", 1, '{"x":"v"}'))

    def lost(self, *_):
        raise OSError("executor lost")

    whole = columns.KeyedTable.apply
    monkeypatch.setattr(columns.KeyedTable, "apply", lambda self, *a: whole(self, *a) if self.path.endswith("names") else lost(self))
    with pytest.raises(OSError):
        table.apply(rows, 0)
    assert table.current(spark).columns == ["uid", "dn", "x"] and table.current(spark).count() == 0
    monkeypatch.undo()
    assert table.apply(rows, 0)
    assert as_dict(table.current(spark)) == {(1, "a"): {"x": "v"}}


def test_names_that_clash(spark, table, monkeypatch):
    table.apply(batch(spark, (1, "a", 1, '{"X":"1","x":"2","UID":"3","x":"4","cells":"5","_name":"6","a.b`c":"7","":"8"}')), 0)
    got = table.current(spark)
    assert table.columns(spark) == {n: n for n in ("", "X", "_name", "a.b`c", "cells")} | {"UID": "UID_2", "x": "x_2"}
    row = dict(zip(got.columns, got.first()))
    assert row == {"uid": 1, "dn": "a", "": "8", "X": "1", "x_2": "4", "UID_2": "3", "cells": "5", "_name": "6", "a.b`c": "7"}
    monkeypatch.setattr(columns, "MAX_COLUMNS", 3)
    with pytest.raises(ValueError, match="rows"):
        table.current(spark)
    assert len(table.rows(spark).select(F.explode("cells")).collect()) == 7


def test_older_files_stay(spark, table):
    """A new column rewrites no file of an older batch, and a point read opens one bucket."""
    table.apply(batch(spark, *[(i, "a", i, '{"x":"v"}') for i in range(30)]), 0)
    before = [f.path for f in table.cells._live(spark)]
    table.apply(batch(spark, (5, "a", 99, '{"new":"v"}')), 1)
    assert [f.path for f in table.cells._live(spark)][:1] == before
    buckets = {f.split("_bucket=")[1].split("/")[0] for f in table.point(spark, uid=5, dn="a").inputFiles()}
    plan = table.point(spark, uid=5, dn="a")._jdf.queryExecution().executedPlan().toString()
    assert buckets and "PartitionFilters: [isnotnull(_bucket" in plan
