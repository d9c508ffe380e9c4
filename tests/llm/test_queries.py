"""The queries of the training-data operators over the small tables."""

import pytest

import __spark_entry__ as entry
from compare import connect, difference

llm = pytest.importorskip("rollcall.llm.queries")


@pytest.mark.parametrize("name", sorted(llm.ORACLES))
def test_same_rows_as_sql(spark, sf_dir, name):
    assert difference(llm.QUERIES[name](spark, sf_dir), connect(sf_dir), llm.ORACLES[name]) is None


def test_all_are_registered():
    names = set(entry.queries())
    assert set(llm.QUERIES) < names and "pipeline" in names
    assert sorted(int(n[2:].split("_")[0]) for n in llm.QUERIES) == list(range(1, 14))
