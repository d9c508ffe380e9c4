"""Splitting of hot groups.

A group is hot when it has more rows than one task should take. There are at
most ``rows / rows_per_task`` such groups, so their list may be broadcast.
Every row of a hot group gets a part number from a hash of its arrival and the
other side of a join is repeated once per part; cold groups are left alone.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from rollcall.session import keep

ROWS_PER_TASK = 2_000_000
NULL_PARTS = 4096


def hot_groups(rows: DataFrame, on: Sequence[str], rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Keys of the hot groups and the number of parts each is split into."""
    return (
        rows.where(~any_null(on))
        .groupBy(*on)
        .agg(F.count(F.lit(1)).alias("_n"))
        .where(F.col("_n") > rows_per_task)
        .select(*on, F.ceil(F.col("_n") / rows_per_task).cast("int").alias("_parts"))
    )


def any_null(on: Sequence[str]) -> Column:
    test = F.lit(False)
    for key in on:
        test = test | F.col(key).isNull()
    return test


def part_of(order: str, parts: Column, on: Sequence[str]) -> Column:
    """Part number of a row; rows without a key never match and are spread out."""
    return (
        F.when(any_null(on), F.pmod(F.xxhash64(order), F.lit(NULL_PARTS)))
        .otherwise(F.pmod(F.xxhash64(order), F.coalesce(parts, F.lit(1))))
        .cast("int")
    )


def each_part(parts: Column) -> Column:
    return F.explode(F.sequence(F.lit(0), F.coalesce(parts, F.lit(1)) - 1))


def split_left_join(
    rows: DataFrame,
    lookup: DataFrame,
    on: Sequence[str],
    order: str,
    rows_per_task: int = ROWS_PER_TASK,
    counted: DataFrame | None = None,
    shuffled: bool = False,
) -> DataFrame:
    """Left join of skewed rows with a lookup that has one row per key.

    Hot keys are counted on ``counted``, or on the rows themselves: pass the
    stored frame the rows were made from to save making them twice. Spark may
    broadcast a lookup whose files look small to it, unless it is ``shuffled``.
    """
    hot = keep(hot_groups(rows if counted is None else counted, on, rows_per_task))
    parts = F.col("_parts")
    if hot.isEmpty():
        # Rows without a key still have to be spread out.
        left = rows.withColumn("_part", part_of(order, F.lit(1), on))
        right = lookup.withColumn("_part", F.lit(0))
    else:
        hot = F.broadcast(hot)
        left = rows.join(hot, list(on), "left").withColumn("_part", part_of(order, parts, on))
        right = lookup.join(hot, list(on), "left").withColumn("_part", each_part(parts))
        left, right = left.drop("_parts"), right.drop("_parts")
    if shuffled:
        right = right.hint("merge")
    return left.join(right, [*on, "_part"], "left").drop("_part")
