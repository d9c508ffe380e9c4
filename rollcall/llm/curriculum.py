"""Mixing of sources by a curriculum whose weights change over time, in DataFrame functions only.

Every source has a schedule of weights over training time. Its integral gives
the words the source contributes, its inverse the time at which each of its
documents is due; documents are then sorted by that time.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollcall.session import staged

WORDS = r"[^\x20\x09-\x0D]+"
KEY_DIGITS = 13  # hexadecimal digits of a document's place in its source
Schedule = Sequence[tuple[float, float]]


def segments(schedule: Schedule) -> list[tuple[float, float, float, float]]:
    """(begin, weight, slope, area before) of each stretch of a schedule of (time, weight) knots.

    Times rise from 0 to 1, weights are straight lines between knots.
    """
    times, weights = zip(*schedule, strict=True)
    rising = all(a < b for a, b in zip(times, times[1:], strict=False))
    if times[0] != 0 or times[-1] != 1 or not rising or min(weights) < 0 or max(weights) <= 0:
        raise ValueError(f"not a schedule of weights from time 0 to 1: {schedule}")
    out, area = [], 0.0
    for (t, w), (u, v) in zip(schedule, schedule[1:], strict=False):
        out.append((float(t), float(w), (v - w) / (u - t), area))
        area += (v + w) / 2 * (u - t)
    return [*out, (1.0, 0.0, 0.0, area)]


def due(stretches: Column, area: Column) -> Column:
    """The time at which the integral of the weights reaches ``area``."""
    at = F.try_element_at(F.filter(stretches, lambda x: x["area"] <= area), F.lit(-1))
    found = F.transform(F.array(at), lambda x: x["begin"] + F.coalesce(_step(x, area - x["area"]), F.lit(0.0)))
    return found[0]


def _step(x: Column, rest: Column) -> Column:
    root = F.sqrt(F.greatest(x["weight"] * x["weight"] + 2 * x["slope"] * rest, F.lit(0.0)))
    return F.when(rest > 0, 2 * rest / F.nullif(x["weight"] + root, F.lit(0.0)))


def numbered(distinct: DataFrame, order: Sequence[Column]) -> DataFrame:
    """``distinct`` with ``number``, its place in the order from 0; sorted by ranges, never in one task."""
    part = F.shiftrightunsigned("_place", 33)
    rows = staged(distinct.orderBy(*order).withColumn("_place", F.monotonically_increasing_id()), "order")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # One row for each range of the sort.
    parts = rows.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    starts = parts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    place = F.col("_start") + F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    return rows.withColumn("_part", part).join(starts, "_part").withColumn("number", place).drop("_part", "_place", "_start")


def water_level(sources: DataFrame, share: float, most: float) -> float:
    """The words per unit of weight at which all sources together give ``share`` of all words.

    No source gives more than ``most`` times its words; what is above is shared
    out again by weight, until none is above. Each round is one aggregate.
    """
    limit = F.lit(float(most)) * F.col("source_size")
    demand = float(share) * (sources.agg(F.sum("source_size")).first()[0] or 0)
    full, level = -1, None
    while True:
        above = F.lit(False) if level is None else limit <= F.lit(level) * F.col("weight")
        count, held, weight = sources.agg(
            F.count_if(above), F.coalesce(F.sum(F.when(above, limit)), F.lit(0.0)), F.sum(F.when(~above, F.col("weight")))
        ).first()
        if weight is None:
            return math.inf
        if count == full:
            return level
        full, level = count, (demand - held) / weight


def mix(
    docs: DataFrame, schedules: Sequence[Schedule], share: float = 1.5, most: float = 2.0,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """What the mix takes of each document, and when; sorted by the time of the first word.

    The schedules go to the sources in turn, sources in order of code points,
    null last. Adds ``size`` (words, 0 for a null text), ``source_size``,
    ``target`` (words the mix wants of the source), ``taken`` (words it takes of
    the document, repeats counted), ``first_position`` (null if none) and
    ``turns``, one (turn, position, words) for every time the document is read.
    Columns of ``docs`` with these names are replaced; ``keep`` names the ones
    that are carried along, all by default.

    A source is read from its first document on, again from the beginning when
    it ends, up to its target rounded down; so only its last document is cut.
    Its documents are in the order of a hash of ``doc_id`` (null like the empty
    text), ties by id, size and text; fully equal rows may change places. Reruns
    give the same rows. Empty tables give no rows. Two levels of prefix sums
    number the words of a source, so that no task holds more than about the
    square root of all rows, however large the source.
    """
    added = ("size", "source_size", "target", "taken", "first_position", "turns")
    kept = [c for c in (docs.columns if keep is None else keep) if c.lower() not in added]
    doc = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    rows = staged(
        docs.select(
            F.struct(*(F.col(f"`{c}`") for c in kept), F.lit(None).alias("_")).alias("row"), doc.alias("doc"),
            F.coalesce(F.col("source").cast("string"), F.lit("")).alias("name"), F.col("source").isNull().alias("nameless"),
            F.conv(F.substring(F.md5(doc.cast("binary")), 1, KEY_DIGITS), 16, 10).cast("long").alias("key"),
            F.coalesce(F.regexp_count("text", F.lit(WORDS)), F.lit(0)).cast("long").alias("size"),
            F.xxhash64("text").alias("tie"),
        ),
        "sizes",
    )
    buckets = max(1, math.isqrt(rows.count()))
    rows = rows.withColumn("bucket", F.floor(F.col("key") / F.lit(float(16**KEY_DIGITS)) * buckets))
    parts = staged(rows.groupBy("nameless", "name", "bucket").agg(F.sum("size").alias("part_size")), "parts")
    plans = [segments(x) for x in schedules]
    stretches = F.array(*(
        F.array(*(F.struct(*(F.lit(v).alias(n) for v, n in zip(x, ("begin", "weight", "slope", "area"), strict=True))) for x in plan))
        for plan in plans
    ))
    totals = parts.groupBy("nameless", "name").agg(F.sum("part_size").alias("source_size"))
    turn_of = F.pmod("number", F.lit(len(plans))).cast("int")
    sources = staged(
        numbered(totals, (F.col("nameless"), F.col("name")))
        .withColumn("weight", F.array(*(F.lit(plan[-1][-1]) for plan in plans))[turn_of])
        .withColumn("schedule", turn_of),
        "sources",
    )
    level = water_level(sources, share, most)
    target = F.least(F.lit(float(most)) * F.col("source_size"), F.lit(level) * F.col("weight"))
    before = Window.partitionBy("nameless", "name").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        parts.withColumn("start", F.coalesce(F.sum("part_size").over(before), F.lit(0))).drop("part_size")
        .join(sources.withColumn("target", target).drop("number"), ["nameless", "name"])
    )
    own = (
        Window.partitionBy("nameless", "name", "bucket").orderBy("key", "doc", "size", "tie")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    wanted = F.floor(F.col("target") + 1e-6)
    begun = rows.join(starts, ["nameless", "name", "bucket"]).withColumn(
        "start", F.col("start") + F.sum("size").over(own) - F.col("size")
    )

    def turn(k: Column) -> Column:
        first = F.col("start") + k * F.col("source_size")
        area = first / F.nullif(wanted, F.lit(0)) * F.col("weight")
        words = F.greatest(F.lit(0), F.least("size", wanted - first))
        return F.struct(
            k.cast("int").alias("turn"), due(stretches[F.col("schedule")], area).alias("position"), words.cast("long").alias("words")
        )

    turns = F.filter(F.transform(F.sequence(F.lit(0), F.lit(math.ceil(most) - 1)), turn), lambda x: x["words"] > 0)
    taken = F.aggregate("turns", F.lit(0).cast("long"), lambda n, x: n + x["words"])
    # Documents that are not taken are sorted too, so that they do not meet in one range.
    return (
        begun.withColumn("turns", turns).orderBy(F.get("turns", F.lit(0))["position"], "key", "tie")
        .select(
            *(F.col("row")[c].alias(c) for c in kept), "size", "source_size", "target", taken.alias("taken"),
            F.when(F.size("turns") > 0, F.col("turns")[0]["position"]).alias("first_position"), "turns",
        )
    )


def training_order(mixed: DataFrame) -> DataFrame:
    """One row for every time a document of ``mix`` is read, sorted by position."""
    rest = [c for c in mixed.columns if c not in ("turns", "turn", "position", "words")]
    return mixed.select(*rest, F.explode("turns").alias("turns")).select(*rest, "turns.*").orderBy("position")
