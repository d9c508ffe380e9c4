"""Keyed tables whose columns come with the data.

Each field of a JSON object is a cell of its row; a name nobody has seen before
is a new column. Cells are stored in long form, one state per row and name, so
neither files nor readers of older batches change when a column appears.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from rollcall.functions.json import READ_OPTIONS
from rollcall.operators.merge import MergeRules
from rollcall.session import remove, staged
from rollcall.sinks.table import KeyedTable, arrival_schema

# A frame of more columns than this is no longer planned in reasonable time; ``rows`` has no bound.
MAX_COLUMNS = 2000
NAME, VALUE, PLACE, SINCE, NUMBER = "_name", "_value", "_place", "_since", "_number"


def json_cells(value) -> Column:
    """The fields of a JSON object as a map of texts; numbers, lists and objects stay as written."""
    return F.from_json(value, "map<string,string>", READ_OPTIONS)


@dataclass(frozen=True)
class OpenTable:
    """A table at ``path`` with one row per ``key`` and a text column per name seen.

    A cell keeps the latest value that is not null, by the ``order`` columns; of a
    name that one object holds twice the last value counts. Null cells, and
    names an object leaves out, change nothing; blank texts are values. Names of
    the key columns are no cells. A row whose object is empty or null exists
    without cells.
    """

    path: str
    key: StructType
    order: StructType = arrival_schema("seq")
    buckets: int = 16
    compact_every: int = 20

    @property
    def cells(self) -> KeyedTable:
        """One state per row and name, in the bucket of the row; the row's own one has a null name."""
        schema = StructType([*self.key.fields, StructField(NAME, StringType()), StructField(VALUE, StringType())])
        keys = tuple(self.key.fieldNames())
        return KeyedTable(
            f"{self.path}/cells", schema, (*keys, NAME), MergeRules(last_set=(VALUE,)),
            arrival_schema(*self.order.fieldNames(), PLACE),
            self.buckets, self.compact_every, spread=keys,
        )

    @property
    def names(self) -> KeyedTable:
        """The names seen, with the number of the batch that brought each."""
        schema = StructType([StructField(NAME, StringType()), StructField(SINCE, LongType())])
        return KeyedTable(
            f"{self.path}/names", schema, (NAME,), MergeRules(first=(SINCE,)),
            arrival_schema(NUMBER), buckets=1, compact_every=self.compact_every,
        )

    def apply(self, batch: DataFrame, version: int, writer: str = "") -> bool:
        """Merges rows of key, order and a map ``cells`` once; False if that was done before.

        Names go in before the cells: a batch lost between the two is repeated by
        its query, and meanwhile a reader sees a column that is still empty.
        """
        keys, order = self.key.fieldNames(), self.order.fieldNames()
        if self.cells.version(batch.sparkSession, writer) >= version:
            return False
        fields = F.filter(F.map_entries("cells"), lambda e: e["value"].isNotNull() & ~e["key"].isin(keys))
        own = F.array(F.struct(F.lit(None).cast("string").alias("key"), F.lit(None).cast("string").alias("value")))
        rows = staged(
            batch.select(
                *[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.key],
                *order,
                F.posexplode(F.concat(own, F.coalesce(fields, F.slice(own, 1, 0)))).alias(PLACE, "_cell"),
            ).select(*keys, *order, PLACE, F.col("_cell.key").alias(NAME), F.col("_cell.value").alias(VALUE)),
            "cells",
        )
        seen = rows.select(NAME).where(F.col(NAME).isNotNull()).distinct()
        numbered = seen.select(NAME, *[F.lit(version).cast("long").alias(c) for c in (SINCE, NUMBER)])
        try:
            self.names.apply(numbered, version, writer)
            return self.cells.apply(rows, version, writer)
        finally:
            remove(rows)

    def columns(self, spark: SparkSession) -> dict[str, str]:
        """Names seen in code point order, each with the column that shows it.

        Spark does not tell columns apart by case: of names equal but for it, and of
        those equal to a key column, the later ones get a number behind them.
        """
        found = self.names.current(spark).select(NAME).limit(MAX_COLUMNS + 1).collect()
        if len(found) > MAX_COLUMNS:
            raise ValueError(f"more than {MAX_COLUMNS} names are too many columns: use rows()")
        taken = {k.lower() for k in self.key.fieldNames()}
        shown = {}
        for name in sorted(r[0] for r in found):
            column, number = name, 1
            while column.lower() in taken:
                number += 1
                column = f"{name}_{number}"
            taken.add(column.lower())
            shown[name] = column
        return shown

    def rows(self, spark: SparkSession, where=None) -> DataFrame:
        """The table now, all cells of a row in a map ``cells``; ``where`` may test key columns only."""
        cell = F.when(F.col(NAME).isNotNull(), F.struct(NAME, VALUE))
        packed = self.cells.current(spark, where).groupBy(*self.key.fieldNames())
        return packed.agg(F.map_from_entries(F.collect_list(cell)).alias("cells"))

    def current(self, spark: SparkSession, where=None) -> DataFrame:
        """The table now with a column for each name seen so far."""
        columns = [F.try_element_at("cells", F.lit(n)).alias(c) for n, c in self.columns(spark).items()]
        return self.rows(spark, where).select(*self.key.fieldNames(), *columns)

    def point(self, spark: SparkSession, **key) -> DataFrame:
        """The row of one key; opens the folders of its bucket only."""
        return self.current(spark, self.cells.located(spark, **key))
