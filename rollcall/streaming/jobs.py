"""The two standing jobs: splitting the log, and building the wide table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery
from pyspark.sql.types import StructType

from rollcall.operators.lookup import enrich
from rollcall.operators.route import (
    dimension_side, fact_side, keep_json_objects, quarantine, to_second_layer,
)
from rollcall.operators.join import KEYS
from rollcall.operators.wide import (
    JOINED_ORDER, member_side, paymoney_side, regtype_side, total_rules, wide_row, wide_rules,
)
from rollcall.schemas import FULL_COLUMNS, WIDE_COLUMNS
from rollcall.session import STREAM_CONF
from rollcall.sinks.columns import OpenTable, json_cells
from rollcall.sinks.dims import DimTables
from rollcall.sinks.table import KeyedTable, arrival_schema
from rollcall.sinks.topics import TRIGGER_SECONDS
from rollcall.streaming.facts import join_closed, stream_closed_rows, stream_first_left_join, stream_left_join
from rollcall.streaming.refresh import DimSnapshots, TableSnapshots

EVERY_MINUTE = {"processingTime": f"{TRIGGER_SECONDS} seconds"}
ALL_AVAILABLE = {"availableNow": True}


def once_per_batch(rows: DataFrame, checkpoint: str, handle: Callable, trigger: dict) -> StreamingQuery:
    """Runs ``handle(frame, batch id, query id)`` per micro-batch; the frame is computed once.

    Batch ids start again with a new checkpoint, and so does the query's id. State
    lives in RocksDB, whatever the session says.
    """

    def run(frame: DataFrame, batch_id: int) -> None:
        frame.persist()
        try:
            query_id = frame.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
            handle(frame, batch_id, query_id)
        finally:
            frame.unpersist()

    for key, value in STREAM_CONF.items():
        rows.sparkSession.conf.set(key, value)
    return (
        rows.writeStream.foreachBatch(run)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def start_split(
    envelope: DataFrame,
    dims: DimTables,
    write_facts: Callable[[DataFrame, str], DataStreamWriter],
    checkpoint: str,
    trigger: dict = EVERY_MINUTE,
    *,
    write_bad: Callable[[DataFrame, str], DataStreamWriter],
) -> list[StreamingQuery]:
    """Keeps JSON objects; dimension topics go into tables, all others to the second layer.

    ``write_facts(rows, checkpoint)`` makes the second layer's writer, such as
    ``kafka_writer`` or ``file_writer`` with their target filled in.
    ``write_bad`` makes the writer of the rows that this job or the next one
    cannot use, with the reason.
    """
    good = keep_json_objects(envelope)
    facts = write_facts(to_second_layer(fact_side(good)), f"{checkpoint}/facts")
    bad = write_bad(quarantine(envelope), f"{checkpoint}/bad")
    return [
        facts.trigger(**trigger).start(),
        bad.trigger(**trigger).start(),
        once_per_batch(dimension_side(good), f"{checkpoint}/dims", dims.apply, trigger),
    ]


def wide_table(path: str, dynamic: bool = False, **options) -> KeyedTable:
    """The table of wide member rows, one per row key."""
    schema = ", ".join(f"`{name}` {kind}" for name, _, kind in WIDE_COLUMNS)
    return KeyedTable(
        path,
        StructType.fromDDL(schema),
        ("id",),
        wide_rules(dynamic),
        arrival_schema(*JOINED_ORDER),
        **options,
    )


def total_table(path: str, **options) -> KeyedTable:
    """The table of full member records whose payments add up, one per member.

    A payment counts once, however many joined rows it is in.
    """
    kinds = {"uid": "int", "ad_id": "int", "siteid": "int", "vip_id": "int", "paymoney": "decimal(38,2)"}
    schema = ", ".join(f"`{name}` {kinds.get(name, 'string')}" for name in FULL_COLUMNS)
    return KeyedTable(
        path,
        StructType.fromDDL(schema),
        KEYS,
        total_rules(),
        arrival_schema(*JOINED_ORDER),
        unit=("paymoney_seq",),
        **options,
    )


def joined_stream(
    members: DataFrame,
    regtypes: DataFrame,
    payments: DataFrame,
    multiplicity: str = "first_left",
    parts: int = 1,
) -> DataFrame:
    """Left joins of the three watermarked facts, with the arrival columns.

    ``first_left`` gives everything when a window closes, and never more rows
    than came in; ``left_outer`` gives matches as they arrive, cut into ``parts``.
    """
    if multiplicity not in ("first_left", "left_outer"):
        raise ValueError(f"unknown multiplicity {multiplicity!r}")
    sides = (member_side(members), regtype_side(regtypes), paymoney_side(payments))
    if multiplicity == "first_left":
        joined = stream_first_left_join(*sides)
    else:
        joined = stream_left_join(*[s.df for s in sides], parts=parts, order="member_seq")
    return joined.withColumn("seq", _completing())


def _completing() -> Column:
    return F.greatest("member_seq", "regtype_seq", "paymoney_seq")


def closed_stream(members: DataFrame, regtypes: DataFrame, payments: DataFrame) -> DataFrame:
    """The watermarked facts of closed windows, for ``first_left_of_closed``."""
    return stream_closed_rows(member_side(members), regtype_side(regtypes), paymoney_side(payments))


def first_left_of_closed(closed: DataFrame) -> DataFrame:
    """What ``joined_stream`` gives by ``first_left``, from a micro-batch of ``closed_stream``."""
    return join_closed(closed, ("member_seq", "regtype_seq", "paymoney_seq")).withColumn("seq", _completing())


def start_wide(
    joined: DataFrame,
    snapshots: DimSnapshots | TableSnapshots,
    table: KeyedTable,
    checkpoint: str,
    trigger: dict = EVERY_MINUTE,
    row: Callable = wide_row,
    join: Callable[[DataFrame], DataFrame] = lambda frame: frame,
) -> StreamingQuery:
    """Looks up each micro-batch of joined rows and merges it into the table.

    With ``join=first_left_of_closed`` the stream is that of ``closed_stream``
    and its micro-batches are joined here: one state for each row instead of
    those of a summary and a join.

    ``row`` shapes the rows: ``wide_row`` for a ``wide_table``, ``total_row`` for
    a ``total_table``.
    """

    def handle(frame: DataFrame, batch_id: int, query_id: str) -> None:
        found = enrich(join(frame), snapshots.get(), unique=True)
        table.apply(row(found, carry=JOINED_ORDER), batch_id, query_id)

    return once_per_batch(joined, checkpoint, handle, trigger)


def start_columns(
    envelope: DataFrame,
    topic: str,
    table: OpenTable,
    checkpoint: str,
    trigger: dict = EVERY_MINUTE,
) -> StreamingQuery:
    """Merges the JSON objects of a topic into a table that gets a column for each new field.

    Texts that are no JSON object, and objects without a usable first key column, are left out.
    """
    cells = F.col("cells")
    objects = keep_json_objects(envelope.where(F.col("topic") == topic)).select(json_cells("value").alias("cells"), "seq")
    rows = objects.select(
        *[F.trim(F.try_element_at(cells, F.lit(f.name))).try_cast(f.dataType).alias(f.name) for f in table.key],
        "seq", "cells",
    ).where(F.col(table.key.fieldNames()[0]).isNotNull())
    return once_per_batch(rows, checkpoint, table.apply, trigger)
