"""Left joins of fact tables within event-time windows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from rollcall.operators.skew import ROWS_PER_TASK, any_null, each_part, part_of
from rollcall.session import keep

KEYS = ("uid", "dn")
NULL_TEXT = "null"


@dataclass(frozen=True)
class Side:
    """One join input: a frame with keys, ``window``, payload and arrival order.

    ``order`` is an integer column, unique within the frame.
    """

    df: DataFrame
    order: str


def _tagged(sides: Sequence[Side], on: Sequence[str]) -> DataFrame:
    parts = [
        s.df.select(*on, F.lit(i).alias("_side"), F.col(s.order).alias("_o"))
        for i, s in enumerate(sides)
    ]
    return reduce(DataFrame.unionByName, parts)


def _group_summary(sides: Sequence[Side], on: Sequence[str]) -> DataFrame:
    """Per group and side: number of rows and first arrival, as plain numbers.

    Fixed-width aggregates, so hot groups shrink to one row per task before the
    shuffle.
    """
    columns = []
    for i in range(len(sides)):
        here = F.col("_side") == i
        columns += [
            F.count_if(here).alias(f"_n{i}"),
            F.min(F.when(here, F.col("_o"))).alias(f"_first{i}"),
        ]
    return _tagged(sides, on).groupBy(*on).agg(*columns)


def _parts_of_side(i: int, rows_per_task: int) -> Column:
    return F.greatest(F.ceil(F.col(f"_n{i}") / rows_per_task), F.lit(1)).cast("int")


def _driving_size(count: int) -> Column:
    size = F.col("_n0")
    for i in range(1, count):
        size = F.when(F.col(f"_n{i}") > 0, F.col(f"_n{i}")).otherwise(size)
    return size


def _driving_side(count: int) -> Column:
    side = F.lit(0)
    for i in range(1, count):
        side = F.when(F.col(f"_n{i}") > 0, F.lit(i)).otherwise(side)
    return side


def _hot_groups(
    summary: DataFrame, on: Sequence[str], count: int, rows_per_task: int
) -> DataFrame | None:
    """Summaries of the groups too large for a task, or None if there are none.

    One pass over the key columns. The list has at most rows / rows_per_task
    entries; it is kept in the checkpoint folder, so that its users do not count
    again.
    """
    too_large = reduce(lambda a, b: a | b, [F.col(f"_n{i}") > rows_per_task for i in range(count)])
    hot = keep(summary.where(too_large & ~any_null(on)))
    return None if hot.isEmpty() else hot


def _cut_and_split(sides, summary, hot, on, rows_per_task):
    """Sides of a first-left join with one part number ``_part``.

    The last side that has rows in a group drives it: its rows all show, the
    sides before it give their first row only. Hot groups are cut down before
    the shuffle and split along the driving side.
    """
    count = len(sides)
    plan = F.broadcast(
        hot.select(
            *on,
            _driving_side(count).alias("_d"),
            F.ceil(_driving_size(count) / rows_per_task).cast("int").alias("_s"),
            *[F.col(f"_first{i}").alias(f"_h{i}") for i in range(count)],
        )
    )
    extra = ["_d", "_s", *[f"_h{i}" for i in range(count)]]
    frames = []
    for i, side in enumerate(sides):
        df = side.df.join(plan, on, "left")
        whole = F.col("_d").isNull() | (F.col("_d") == i)
        df = df.where(whole | (F.col(side.order) == F.col(f"_h{i}")))
        own = F.array(part_of(side.order, F.col("_s"), on))
        repeated = F.sequence(F.lit(0), F.coalesce(F.col("_s"), F.lit(1)) - 1)
        marks = {
            f"_split{j}": F.coalesce((F.col("_d") == j) & (F.col("_s") > 1), F.lit(False))
            for j in range(1, count)
        }
        df = df.withColumn("_part", F.explode(F.when(whole, own).otherwise(repeated)))
        frames.append((df.withColumns(marks) if i == 0 else df).drop(*extra))
    summary = (
        summary.join(plan.select(*on, "_s"), on, "left")
        .withColumn("_part", each_part(F.col("_s")))
        .drop("_s")
    )
    return frames, summary, ["_part"]


def _grid_split(sides, hot, on, rows_per_task):
    """Sides of a chain of left joins with a part number per side: hot groups
    become a grid of parts, each row meeting every row of the other sides once."""
    count = len(sides)
    plan = F.broadcast(
        hot.select(*on, *[_parts_of_side(i, rows_per_task).alias(f"_s{i}") for i in range(count)])
    )
    frames = []
    for i, side in enumerate(sides):
        df = side.df.join(plan, on, "left")
        for j in range(count):
            parts = F.col(f"_s{j}")
            df = df.withColumn(
                f"_part{j}", part_of(side.order, parts, on) if i == j else each_part(parts)
            )
        if i == 0:
            df = df.withColumns(
                {
                    f"_split{j}": F.coalesce(F.col(f"_s{j}") > 1, F.lit(False))
                    for j in range(1, count)
                }
            )
        frames.append(df.drop(*[f"_s{j}" for j in range(count)]))
    return frames, [f"_part{j}" for j in range(count)]


def windowed_left_join(
    left: Side,
    *rights: Side,
    keys: Sequence[str] = KEYS,
    window: str = "window",
    multiplicity: str = "first_left",
    null_safe_keys: bool = False,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """``left`` joined with each of ``rights`` on the keys and the same window.

    ``left_outer`` is the chain of ordinary left joins. With ``first_left`` (the
    default) a group that has rows on a right side pairs only its first row so
    far, by arrival, with them; its other rows so far are left out. A group
    without right rows keeps all its left rows. The output of ``first_left`` is
    never larger than its inputs, however hot a key is.

    All sides are shuffled once, on the same keys. Groups larger than
    ``rows_per_task`` are cut into parts; finding them takes a pass over the
    keys when the join is built.
    """
    if multiplicity not in ("first_left", "left_outer"):
        raise ValueError(f"unknown multiplicity {multiplicity!r}")
    first_left = multiplicity == "first_left"
    sides = [left, *rights]
    names = list(keys)
    if null_safe_keys:
        # Text keys spell a missing part "null", so two missing parts match.
        names = [f"_k_{k}" for k in keys]
        spelled = {
            f"_k_{k}": F.coalesce(F.col(k).cast("string"), F.lit(NULL_TEXT)) for k in keys
        }
        sides = [Side(s.df.withColumns(spelled), s.order) for s in sides]
    on = [*names, window]
    count = len(sides)

    summary = _group_summary(sides, on)
    hot = _hot_groups(summary, on, count, rows_per_task)
    frames, parts = [s.df for s in sides], []
    if hot is not None and first_left:
        frames, summary, parts = _cut_and_split(sides, summary, hot, on, rows_per_task)
    elif hot is not None:
        frames, parts = _grid_split(sides, hot, on, rows_per_task)
    shared = [*on, *parts]

    joined = frames[0]
    if first_left:
        joined = joined.join(summary, shared, "left")
        has_right = F.greatest(*[F.col(f"_n{i}") for i in range(1, count)], F.lit(0)) > 0
        joined = joined.where(~has_right | (F.col(left.order) == F.col("_first0")))
    for i in range(1, count):
        right = frames[i].drop(*keys) if null_safe_keys else frames[i]
        right = right.withColumnsRenamed({c: f"_r_{c}" for c in shared})
        match = reduce(lambda a, b: a & b, [F.col(c) == F.col(f"_r_{c}") for c in shared])
        if first_left and i + 1 < count:
            later = F.greatest(*[F.col(f"_n{j}") for j in range(i + 1, count)], F.lit(0)) > 0
            match = match & (~later | (F.col(sides[i].order) == F.col(f"_first{i}")))
        joined = joined.join(right, match, "left")
        if parts:
            # A part without rows of a split side is no miss: another part has them.
            joined = joined.where(F.col(f"_r_{window}").isNotNull() | ~F.col(f"_split{i}"))
        joined = joined.drop(*[f"_r_{c}" for c in shared])
    return joined.select(*[c for c in joined.columns if not c.startswith("_")])
