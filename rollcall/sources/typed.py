"""Envelopes to typed records, for batch and streaming frames alike."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from rollcall.functions.json import ends_with_first_object, json_rows
from rollcall.functions.times import event_time
from rollcall.schemas import RecordSpec

# Fixed value: the window of the fact joins.
JOIN_WINDOW = "10 minutes"


def typed_columns(spec: RecordSpec) -> list:
    """Columns of a record whose fields are still text; ids become int or null."""
    return [
        F.trim(f).try_cast("int").alias(f) if f in spec.ints else F.col(f) for f in spec.fields
    ]


def parse_record(envelope: DataFrame, spec: RecordSpec, topic: str | None = None) -> DataFrame:
    """Rows of one topic as typed columns plus ``seq``.

    Unknown fields drop out, and so do texts that are no JSON object and records
    without a usable id or event time: see ``quarantine`` for those.
    """
    named = envelope.where(F.col("topic") == (topic or spec.topic))
    typed = (
        named.where(ends_with_first_object("value"))
        .select(json_rows("value", spec.wire_schema), "seq")
        .select(*typed_columns(spec), "seq")
        .where(F.col(spec.key[0]).isNotNull())
    )
    if spec.event_time:
        typed = typed.where(event_time(spec.event_time).isNotNull())
    return typed


def with_window(typed: DataFrame, spec: RecordSpec, size: str = JOIN_WINDOW) -> DataFrame:
    """Adds the event time ``ts`` and the ``window`` it falls into, aligned to the epoch."""
    return typed.withColumn("ts", event_time(spec.event_time)).withColumn(
        "window", F.window("ts", size)
    )
