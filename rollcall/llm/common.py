"""Small helpers of the operators in this package."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.session import remove, staged

DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def is_held_out(doc_id: Column) -> Column:
    """Documents that no model may learn from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def row_key() -> Column:
    """A number of the row, the same whenever the same files are read again."""
    return F.xxhash64(F.monotonically_increasing_id())


def components(edges: DataFrame) -> DataFrame:
    """The smallest node reachable from each node, as (node, root).

    ``edges`` has two long columns. Distributed union-find: by turns every
    node's larger neighbours, then its smaller ones, are hung on the smallest
    neighbour, until nothing changes; no task holds a node's neighbours.
    """
    a, b = edges.columns
    now = staged(
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u > v").distinct(), "edges"
    )
    seen = _fingerprint(now)
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (
            both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v")
        ).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(low, "u")
            .select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
            .where("u > v")
            .distinct()
        )
        last, now = now, staged(small, "edges")
        remove(last)
        before, seen = seen, _fingerprint(now)
        if before == seen:
            tops = now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(tops)


def _fingerprint(edges: DataFrame) -> tuple:
    hashed = F.xxhash64("u", "v")
    return tuple(edges.agg(F.count("*"), F.bit_xor(hashed), F.sum(F.shiftrightunsigned(hashed, 24))).first())
