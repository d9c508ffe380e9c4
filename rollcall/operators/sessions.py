"""Sliding and session windows over keyed events."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

# The window shapes offered besides the tumbling join windows.
SLIDE_SIZE, SLIDE_STEP = "10 seconds", "5 seconds"
SESSION_GAP = "5 seconds"


def sliding_counts(
    events: DataFrame, keys: Sequence[str], moment: str = "ts", size: str = SLIDE_SIZE, step: str = SLIDE_STEP
) -> DataFrame:
    """Events per key and sliding window; each event counts in size / step windows."""
    return events.groupBy(*keys, F.window(moment, size, step)).agg(F.count(F.lit(1)).alias("n"))


def session_counts(
    events: DataFrame,
    keys: Sequence[str],
    moment: str = "ts",
    gap: str = SESSION_GAP,
    stretch: str = "1 hour",
) -> DataFrame:
    """Events per key and session: runs of events less than ``gap`` apart.

    For streams these are Spark's session windows. A batch first makes sessions
    within each ``stretch`` of time, so that a hot key is spread over tasks;
    only sessions that reach over the border of a stretch, at most two for each
    stretch and key, are then put together.
    """
    session = F.session_window(moment, gap)
    if events.isStreaming:
        return events.groupBy(*keys, session.alias("session")).agg(F.count(F.lit(1)).alias("n"))
    width = F.expr(f"interval {gap}")
    # Bounds come from the times themselves: a test on the session's own bounds
    # would be pushed below the grouping, where sessions are still single events.
    parts = (
        events.withColumn("_stretch", F.window(moment, stretch))
        .groupBy(*keys, "_stretch", session)
        .agg(
            F.min(moment).alias("_from"),
            (F.max(moment) + width).alias("_to"),
            F.count(F.lit(1)).alias("_n"),
        )
        .drop("session_window")
    )
    at_border = (F.col("_to") >= F.col("_stretch.end")) | (
        F.col("_from") <= F.col("_stretch.start") + width
    )
    inner = parts.where(~at_border).select(*keys, "_from", "_to", "_n")
    by_time = Window.partitionBy(*keys).orderBy("_from")
    fresh = F.when(F.col("_from") <= F.lag("_to").over(by_time), 0).otherwise(1)
    run = F.sum("_fresh").over(by_time.rowsBetween(Window.unboundedPreceding, 0))
    merged = (
        parts.where(at_border)
        .withColumn("_fresh", fresh)
        .withColumn("_run", run)
        .groupBy(*keys, "_run")
        .agg(F.min("_from").alias("_from"), F.max("_to").alias("_to"), F.sum("_n").alias("_n"))
        .drop("_run")
    )
    return inner.unionByName(merged).select(
        *keys, F.struct(F.col("_from").alias("start"), F.col("_to").alias("end")).alias("session"),
        F.col("_n").alias("n"),
    )
