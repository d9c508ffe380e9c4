"""Keyed merging of rows under per-column rules.

All rules combine partial results: a hot key shrinks to one row per task before
the shuffle, and stored states can be merged with later ones in any order.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, functions as F

from rollcall.operators.skew import ROWS_PER_TASK, split_left_join


@dataclass(frozen=True)
class MergeRules:
    """What becomes of each non-key column when rows of one key meet.

    ``last``: value of the latest row, null included. ``first``: value of the
    earliest row. ``last_set``: latest value that is not null. ``total``: sum,
    null counting as zero.
    """

    last: tuple[str, ...] = ()
    first: tuple[str, ...] = ()
    last_set: tuple[str, ...] = ()
    total: tuple[str, ...] = ()

    @property
    def columns(self) -> tuple[str, ...]:
        return self.last + self.first + self.last_set + self.total

    @classmethod
    def latest(cls, columns: Sequence[str]) -> MergeRules:
        return cls(last=tuple(columns))

    def with_rule(self, **rules: Sequence[str]) -> MergeRules:
        """The same rules with the named columns moved to other rules."""
        moved = {c for names in rules.values() for c in names}
        rest = {
            f: tuple(c for c in getattr(self, f) if c not in moved)
            for f in ("last", "first", "last_set", "total")
        }
        return replace(self, **{f: rest[f] + tuple(rules.get(f, ())) for f in rest})


def lift(
    rows: DataFrame, key: Sequence[str], order: Sequence[str], rules: MergeRules
) -> DataFrame:
    """Rows as mergeable states: each value next to the arrival it came with."""
    at = F.struct(*order).alias("at")
    columns = [*key]
    if rules.last:
        columns.append(F.struct(at, F.struct(*rules.last).alias("v")).alias("_last"))
    if rules.first:
        columns.append(F.struct(at, F.struct(*rules.first).alias("v")).alias("_first"))
    for c in rules.last_set:
        columns.append(F.when(F.col(c).isNotNull(), F.struct(at, F.col(c).alias("v"))).alias(f"_set_{c}"))
    types = {f.name: f.dataType for f in rows.schema}
    for c in rules.total:
        columns.append(F.coalesce(F.col(c), F.lit(0).cast(types[c])).alias(f"_total_{c}"))
    return rows.select(*columns)


def combine(states: DataFrame, key: Sequence[str], rules: MergeRules, repeats: bool = False) -> DataFrame:
    """One state per key; states of one key may come in any order.

    With ``repeats`` the states of a key are of one and the same counted row.
    """
    aggregates = []
    if rules.last:
        aggregates.append(F.max_by("_last", "_last.at").alias("_last"))
    if rules.first:
        aggregates.append(F.min_by("_first", "_first.at").alias("_first"))
    for c in rules.last_set:
        aggregates.append(F.max_by(f"_set_{c}", f"_set_{c}.at").alias(f"_set_{c}"))
    types = {f.name: f.dataType for f in states.schema}
    for c in rules.total:
        name = f"_total_{c}"
        total = F.max(name) if repeats else F.sum(name)
        aggregates.append(total.cast(types[name]).alias(name))
    return states.groupBy(*key).agg(*aggregates)


def lower(states: DataFrame, key: Sequence[str], rules: MergeRules) -> DataFrame:
    """States as plain rows: key columns, then the columns of the rules."""
    shown = [F.col(k) for k in key]
    for c in rules.columns:
        if c in rules.last:
            shown.append(F.col(f"_last.v.{c}").alias(c))
        elif c in rules.first:
            shown.append(F.col(f"_first.v.{c}").alias(c))
        elif c in rules.last_set:
            shown.append(F.col(f"_set_{c}.v").alias(c))
        else:
            shown.append(F.col(f"_total_{c}").alias(c))
    return states.select(*shown)


def merge_rows(
    rows: DataFrame, key: Sequence[str], order: Sequence[str], rules: MergeRules
) -> DataFrame:
    """One row per key from rows ordered by the ``order`` columns, unique per key."""
    return lower(combine(lift(rows, key, order, rules), key, rules), key, rules)


def upsert(
    existing: DataFrame,
    incoming: DataFrame,
    key: Sequence[str],
    rules: MergeRules,
    order: Sequence[str] = ("seq",),
) -> DataFrame:
    """The table after the incoming rows; every existing row is older than them."""
    columns = [*key, *rules.columns]
    old = existing.select(*columns, F.lit(0).alias("_batch"))
    new = incoming.select(*columns, F.lit(1).alias("_batch"), *order)
    both = old.unionByName(new, allowMissingColumns=True)
    return merge_rows(both, key, ["_batch", *order], rules)


def mark_existing(
    existing: DataFrame,
    incoming: DataFrame,
    key: Sequence[str],
    order: str = "seq",
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Incoming rows with ``stored``: whether their key is in the table."""
    keys = existing.select(*key).distinct().withColumn("_found", F.lit(True))
    marked = split_left_join(incoming, keys, key, order, rows_per_task)
    return marked.withColumn("stored", F.col("_found").isNotNull()).drop("_found")


def split_by_existence(
    existing: DataFrame, incoming: DataFrame, key: Sequence[str], order: str = "seq", **options
) -> tuple[DataFrame, DataFrame]:
    """Incoming rows as (updates, inserts), by whether their key is stored."""
    marked = mark_existing(existing, incoming, key, order, **options)
    columns = incoming.columns
    return (
        marked.where(F.col("stored")).select(*columns),
        marked.where(~F.col("stored")).select(*columns),
    )
