"""Multi-topic log envelopes: (topic, value, seq)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, functions as F

from rollcall.schemas import ENVELOPE


def kafka_read_options(
    servers: str,
    topics: str | Iterable[str],
    starting: str = "earliest",
    max_offsets: int | None = None,
    group_id: str | None = None,
) -> dict[str, str]:
    """Options of the log's reader; from the earliest offset on, a batch needs a limit."""
    if starting == "earliest" and not max_offsets:
        raise ValueError("max_offsets is needed when a stream starts at the earliest offset")
    names = topics.split(",") if isinstance(topics, str) else list(topics)
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": ",".join(n.strip() for n in names),
        "startingOffsets": starting,
    }
    if max_offsets:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    if group_id:
        options["kafka.group.id"] = group_id
    return options


def decode(log: DataFrame) -> DataFrame:
    """Kafka rows to envelopes; the record key is ignored, bad bytes become the replacement sign.

    ``seq`` is unique within a topic: the offset, then the partition number.
    """
    return log.select(
        "topic",
        F.make_valid_utf8(F.col("value").cast("string")).alias("value"),
        (F.shiftleft(F.col("offset"), 16) + F.col("partition")).alias("seq"),
    )


def kafka_envelope(spark: SparkSession, **options) -> DataFrame:
    reader = spark.readStream.format("kafka").options(**kafka_read_options(**options))
    return decode(reader.load())


def file_envelope(
    spark: SparkSession, path: str, stream: bool = True, max_files: int | None = None
) -> DataFrame:
    """Envelopes kept as Parquet files, as a stream or as a batch."""
    if not stream:
        return spark.read.schema(ENVELOPE).parquet(path)
    reader = spark.readStream.schema(ENVELOPE)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)
