"""Epoch milliseconds in text and event time."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from rollcall.functions.json import _col


# Microseconds of a timestamp are a long.
MOST_MILLIS = (2**63 - 1) // 1000


def event_time(millis_text) -> Column:
    """The time of a millisecond text, null if it is no number or no time can hold it."""
    millis = _col(millis_text).try_cast("bigint")
    return F.timestamp_millis(F.when(millis.between(-MOST_MILLIS, MOST_MILLIS), millis))


def to_millis(moment) -> Column:
    return F.unix_millis(_col(moment).cast("timestamp"))
