"""Relational stores: reads with pushed filters, appends from a micro-batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rollcall.sources.tables import scan_where


def jdbc_options(
    url: str,
    table: str,
    driver: str = "org.postgresql.Driver",
    partition_column: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int | None = None,
    **extra: str,
) -> dict[str, str]:
    """Reader and writer options; the login comes in through ``extra``."""
    options = {"url": url, "dbtable": table, "driver": driver, "pushDownPredicate": "true"}
    if partition_column:
        low, high = bounds
        options.update(
            partitionColumn=partition_column,
            lowerBound=str(low),
            upperBound=str(high),
            numPartitions=str(partitions),
        )
    options.update(extra)
    return options


def jdbc_scan(spark: SparkSession, options: dict[str, str], columns=None, **equals) -> DataFrame:
    return scan_where(spark.read.format("jdbc").options(**options).load(), columns, **equals)


def jdbc_append(batch: DataFrame, options: dict[str, str]) -> None:
    """Append to a staging table, to be merged by the store."""
    batch.write.format("jdbc").options(**options).mode("append").save()
