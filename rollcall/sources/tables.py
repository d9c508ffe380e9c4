"""Point reads of stored tables; filters and columns reach the scan."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, functions as F


# Row keys that are handed to a scan as values; beyond it they are joined.
PUSHED_KEYS = 10_000


def scan_where(table: DataFrame, columns: Iterable[str] | None = None, **equals) -> DataFrame:
    """Rows whose named columns equal the given values, narrowed to ``columns``."""
    for name, value in equals.items():
        table = table.where(F.col(name) == F.lit(value))
    return table.select(*columns) if columns else table


def scan_rowkeys(
    table: DataFrame, keys: Iterable[str], columns: Iterable[str] | None = None
) -> DataFrame:
    """Rows stored under the given row keys, with some or all columns."""
    found = table.where(F.col("rowkey").isin(list(keys)))
    return found.select("rowkey", *columns) if columns else found


def scan_many_rowkeys(
    table: DataFrame, keys: DataFrame, columns: Iterable[str] | None = None, pushed_keys: int = PUSHED_KEYS
) -> DataFrame:
    """Rows stored under the row keys of a frame, each row once; null keys find nothing.

    Up to ``pushed_keys`` keys become a filter of the scan, which row groups answer
    from their ranges, dictionaries and Bloom filters. More keys are joined.
    """
    batch = keys.select("rowkey").where(F.col("rowkey").isNotNull()).distinct()
    few = [r[0] for r in batch.limit(pushed_keys + 1).collect()]
    if len(few) <= pushed_keys:
        return scan_rowkeys(table, few, columns)
    found = table.join(batch, "rowkey", "left_semi")
    return found.select("rowkey", *columns) if columns else found
