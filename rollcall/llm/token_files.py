"""Token counts of documents in flat token files without an index.

A file is nothing but ids of fixed width, each document closed by an
end-of-document id. Blocks of a file are searched on their own; what they
found is joined by a prefix scan over small block summaries.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow.fs import FileSystem, LocalFileSystem
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rollcall.llm.bytebpe import shared_encoder, slices
from rollcall.session import staged

END_ID = 50256
BLOCK_TOKENS = 1 << 20
# Blocks whose summaries are scanned by one task before their totals are.
SPAN_BLOCKS = 1024
# Blocks that one task reads from the store, one after another.
TASK_BLOCKS = 64


def write_token_files(docs: DataFrame, path: str, ranks_path: str, pattern: str, end_id: int = END_ID) -> None:
    """Writes the documents' ids as flat little-endian 16-bit files.

    Null and empty texts become empty documents, an end id alone. One file per
    task; nothing marks where a document is but the end id.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = shared_encoder(ranks_path, pattern)
        for batch in batches:
            texts = [x or "" for x in batch.column("text").to_pylist()]
            for begin, end in slices([len(x) for x in texts]):
                ids, ends = encoder.encode(texts[begin:end])
                raw = ids.astype("<u2").tobytes()
                edges = [0, *(2 * ends).tolist()]
                rows = [raw[x:y] for x, y in zip(edges, edges[1:], strict=False)]
                yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], names=["ids"])

    # The text writer puts the bytes of each row and then those of the separator.
    (
        docs.select("text")
        .mapInArrow(encode, "ids binary")
        .select(F.col("ids").cast("string").alias("value"))
        .write.option("encoding", "ISO-8859-1")
        .option("lineSep", end_id.to_bytes(2, "little").decode("latin-1"))
        .text(path)
    )


def open_file(uri: str) -> pa.NativeFile:
    """A file of random access; Spark names local ones without escapes."""
    if uri.startswith("file:"):
        return LocalFileSystem().open_input_file("/" + uri.removeprefix("file:").lstrip("/"))
    store, place = FileSystem.from_uri(uri)
    return store.open_input_file(place)


def read_blocks(spark: SparkSession, path: str, block_tokens: int = BLOCK_TOKENS, width: int = 2) -> DataFrame:
    """The files below ``path`` as rows (file, block, data).

    Spark lists the files with their lengths and deals out ranges of them; a task
    reads no more than one block at a time, however long its file is. Ranges are
    opened by Arrow's file systems: local or mounted folders, HDFS, S3, GCS. Empty
    files have no rows. ``scan_blocks`` takes blocks from anywhere.
    """
    size = block_tokens * width
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    # Without the content column no file is opened here.
    ranges = files.where("length > 0").select(
        F.col("path").alias("file"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(length - 1) div {size}"))).alias("block"),
    )

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri, block in zip(batch.column("file").to_pylist(), batch.column("block").to_pylist(), strict=True):
                with open_file(uri) as source:
                    data = source.read_at(min(size, source.size() - block * size), block * size)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([uri]), pa.array([block], pa.int64()), pa.array([data], pa.binary())], names=["file", "block", "data"]
                )

    # A width of its own: these rows are too small for Spark to tell how much is behind them.
    tasks = max(spark.sparkContext.defaultParallelism, -(-ranges.count() // TASK_BLOCKS))
    return ranges.repartition(tasks, "file", "block").mapInArrow(fetch, "file string, block long, data binary")


def scan_blocks(blocks: DataFrame, end_id: int = END_ID, width: int = 2, span: int = SPAN_BLOCKS) -> DataFrame:
    """Every document of the files: (file, doc_no, start, n_tokens, closed).

    ``doc_no`` counts from 0 in a file, ``start`` is the place of its first id,
    ``n_tokens`` leaves the end id out. Ids behind the last end id are one more
    document with ``closed`` false; a file that ends with an end id has none.
    Null data counts as an empty block; blocks of a file must be numbered in
    order and, except the last, may have any length of whole ids. Further
    columns are left out. No blocks give no rows.
    """

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [np.frombuffer(x or b"", dtype=f"<u{width}") for x in batch.column("data").to_pylist()]
            ends = [np.flatnonzero(x == end_id) for x in ids]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("file"), batch.column("block"),
                    pa.array([len(x) for x in ids], pa.int64()), pa.array([len(x) for x in ends], pa.int64()),
                    pa.array(ends, pa.list_(pa.int64())),
                ],
                names=["file", "block", "n", "n_ends", "ends"],
            )

    found = blocks.select("file", F.col("block").cast("long").alias("block"), "data").mapInArrow(
        search, "file string, block long, n long, n_ends long, ends array<long>"
    )
    found = staged(found, "ends")
    spans = found.withColumn("span", F.floor(F.col("block") / span))
    inside = Window.partitionBy("file", "span").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    # The place behind the last end id so far; places count from the span's first id.
    local = spans.withColumns(
        {
            "_n": F.coalesce(F.sum("n").over(inside), F.lit(0)),
            "_ends": F.coalesce(F.sum("n_ends").over(inside), F.lit(0)),
        }
    ).withColumn("_last", F.col("_n") + F.try_element_at("ends", F.lit(-1)) + 1)
    local = local.withColumn("_open", F.max("_last").over(inside))
    totals = local.groupBy("file", "span").agg(
        F.sum("n").alias("t_n"), F.sum("n_ends").alias("t_ends"), F.max("_last").alias("t_last")
    )
    over = Window.partitionBy("file").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.withColumns(
        {
            "b_n": F.coalesce(F.sum("t_n").over(over), F.lit(0)),
            "b_ends": F.coalesce(F.sum("t_ends").over(over), F.lit(0)),
            "size": F.sum("t_n").over(Window.partitionBy("file")),
            "all_ends": F.sum("t_ends").over(Window.partitionBy("file")),
            "tail": F.lit(0),
        }
    )
    totals = totals.withColumn("_at", F.col("b_n") + F.col("t_last"))
    totals = totals.withColumns(
        {
            "b_open": F.coalesce(F.max("_at").over(over), F.lit(0)),
            "tail": F.coalesce(F.max("_at").over(Window.partitionBy("file")), F.lit(0)),
        }
    )
    joined = local.join(totals.select("file", "span", "b_n", "b_ends", "b_open"), ["file", "span"])
    base = F.col("b_n") + F.col("_n")
    first = F.coalesce(F.col("b_n") + F.col("_open"), F.col("b_open"))
    closed = joined.where("n_ends > 0").select(
        "file",
        (F.col("b_ends") + F.col("_ends")).alias("doc_base"),
        base.alias("base"),
        F.concat(F.array(first - base), F.transform(F.slice("ends", 1, F.col("n_ends").cast("int") - 1), lambda x: x + 1)).alias("starts"),
        "ends",
    )
    rows = closed.select("file", "doc_base", "base", F.posexplode(F.arrays_zip("starts", "ends")).alias("i", "x")).select(
        "file",
        (F.col("doc_base") + F.col("i")).alias("doc_no"),
        (F.col("base") + F.col("x.starts")).alias("start"),
        (F.col("x.ends") - F.col("x.starts")).alias("n_tokens"),
        F.lit(True).alias("closed"),
    )
    open_rows = (
        totals.groupBy("file")
        .agg(F.max("size").alias("size"), F.max("all_ends").alias("doc_no"), F.max("tail").alias("start"))
        .where("size > start")
        .select("file", "doc_no", "start", (F.col("size") - F.col("start")).alias("n_tokens"), F.lit(False).alias("closed"))
    )
    return rows.unionByName(open_rows)
