"""Watermarked joins of fact streams."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from rollcall.functions import event_time
from rollcall.operators.join import KEYS, Side, windowed_left_join
from rollcall.operators.skew import any_null
from rollcall.schemas import RecordSpec
from rollcall.sources.typed import JOIN_WINDOW

# Watermark delay and lateness of the fact joins, the short window.
DELAY = "10 seconds"
SHORT_WINDOW = "10 seconds"
LATE_DELAY = "130 seconds"  # the delay and two minutes of allowed lateness


def watermarked(
    typed: DataFrame, spec: RecordSpec, window: str = JOIN_WINDOW, delay: str = DELAY
) -> DataFrame:
    """Adds the window; the watermark rides on it, the raw time is dropped."""
    return (
        typed.withColumn("_ts", event_time(spec.event_time))
        .withWatermark("_ts", delay)
        .withColumn("window", F.window("_ts", window))
        .drop("_ts")
    )


def stream_left_join(
    left: DataFrame, *rights: DataFrame, keys: Sequence[str] = KEYS, parts: int = 1, order: str | None = None
) -> DataFrame:
    """Chained left joins of watermarked streams within windows.

    Matches come out as they arrive, misses when the watermark passes the
    window. A key that gets too large a share of a window is cut into ``parts``:
    each left row goes to one of them by ``order`` and right rows go to all.
    """
    on = [*keys, "window"]
    if parts > 1:
        on = [*on, "_part"]
        left = left.withColumn("_part", F.pmod(F.xxhash64(order), F.lit(parts)).cast("int"))
    joined = left
    for right in rights:
        if parts > 1:
            right = right.withColumn(
                "_part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
            )
        renamed = right.withColumnsRenamed({c: f"_r_{c}" for c in on})
        match = F.lit(True)
        for c in on:
            match = match & (F.col(c) == F.col(f"_r_{c}"))
        joined = joined.join(renamed, match, "left").drop(*[f"_r_{c}" for c in on])
    return joined.drop("_part")


def _payload(sides: Sequence[Side], on: Sequence[str]) -> list[list[str]]:
    return [[c for c in s.df.columns if c not in on] for s in sides]


def _tagged(sides: Sequence[Side], on: Sequence[str]) -> list[DataFrame]:
    """Each side's rows with ``_side``, ``_o`` and a struct for every side, null but for its own."""
    payload = _payload(sides, on)
    empty = [F.lit(None).cast(StructType([s.df.schema[c] for c in p])) for s, p in zip(sides, payload)]

    def tagged(i: int) -> DataFrame:
        rows = [(F.struct(*p) if i == j else empty[j]).alias(f"_row{j}") for j, p in enumerate(payload)]
        return sides[i].df.select(*on, F.lit(i).alias("_side"), F.col(sides[i].order).alias("_o"), *rows)

    return [tagged(i) for i in range(len(sides))]


def stream_closed_rows(*sides: Side, keys: Sequence[str] = KEYS) -> DataFrame:
    """The rows of all sides, each when the watermark passes its window, for ``join_closed``.

    All rows of a window come out in one micro-batch, those that are late never.
    Every row is a state of its own, by its arrival, so that a hot key is spread
    and nothing is written again. Rows without a key come out at once.
    """
    on = [*keys, "window"]
    tagged = _tagged(sides, on)
    names = [c for c in tagged[0].columns if c.startswith("_row")]
    keyless = any_null(keys)
    rows = reduce(DataFrame.unionByName, tagged).where(~keyless)
    # A list, so that an arrival number that comes twice loses no row.
    held = rows.groupBy(*on, "_side", "_o").agg(F.collect_list(F.struct(*names)).alias("_rows"))
    closed = held.select(*on, "_side", F.explode("_rows").alias("_row")).select(*on, "_side", "_row.*")
    return closed.unionByName(tagged[0].where(keyless).drop("_o"))


def join_closed(closed: DataFrame, orders: Sequence[str], keys: Sequence[str] = KEYS, **options) -> DataFrame:
    """The first-left join of a micro-batch of ``stream_closed_rows``; ``orders`` names each side's arrival."""
    sides = [
        Side(closed.where(F.col("_side") == i).select(*keys, "window", f"_row{i}.*"), order)
        for i, order in enumerate(orders)
    ]
    return windowed_left_join(*sides, keys=keys, **options)


def stream_first_left_join(*sides: Side, keys: Sequence[str] = KEYS) -> DataFrame:
    """Of each group only the first left row pairs with the rows of the right sides.

    The last side that has rows in a group shows all of them, the sides before it
    their first row by arrival; ``sides[0]`` is the left one. Groups come out
    when the watermark passes the window: one summary of them is joined with the
    rows of all sides. A left row without a key joins nothing and comes out at
    once; rows of the other sides without a key never show.
    """
    on = [*keys, "window"]
    count = len(sides)
    payload = _payload(sides, on)
    tagged = _tagged(sides, on)
    keyless = any_null(keys)
    rows = reduce(DataFrame.unionByName, tagged).where(~keyless)
    firsts = [
        F.min_by(f"_row{i}", F.when(F.col("_side") == i, F.col("_o"))).alias(f"_first{i}")
        for i in range(count - 1)
    ]
    lefts = F.count_if(F.col("_side") == 0).alias("_lefts")
    groups = rows.groupBy(*on).agg(F.max("_side").alias("_drive"), lefts, *firsts)
    groups = groups.withColumnsRenamed({c: f"_g_{c}" for c in on})
    match = F.col("_side") == F.col("_drive")
    for c in on:
        match = match & (F.col(c) == F.col(f"_g_{c}"))
    shown = rows.join(groups, match).where(F.col("_lefts") > 0)
    columns = []
    for j, names in enumerate(payload):
        for c in names:
            own = F.when(F.col("_side") == j, F.col(f"_row{j}.{c}"))
            if j < count - 1:
                own = own.when(F.col("_side") > j, F.col(f"_first{j}.{c}"))
            columns.append(own.alias(c))
    alone = tagged[0].where(keyless)
    lone = [F.col(f"_row{j}.{c}").alias(c) for j, names in enumerate(payload) for c in names]
    return shown.select(*on, *columns).unionByName(alone.select(*on, *lone))
