"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings every job relies on.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Session windows are merged inside each input partition before the shuffle.
    "spark.sql.sessionWindow.merge.sessions.in.local.partition": "true",
}

# Settings that only a new session can take. Call sites are not recorded for
# every column, so that long plans build faster.
START_CONF = {"spark.python.sql.dataFrameDebugging.enabled": "false"}

# Shuffle files go when the command that wrote them has ended, not when the driver collects its garbage.
_SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# Whether stored states are counted.
COUNTED = "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows"

# State of the stateful queries lives in RocksDB with incremental changelogs.
STREAM_CONF = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # Counting the stored rows costs a read before every write and removal; only queries with few states do it.
    COUNTED: "false",
    # One store instead of four per join and partition.
    "spark.sql.streaming.join.stateFormatVersion": "3",
}


def build_session(app: str = "rollcall", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**START_CONF, **RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    return prepare(builder.getOrCreate())


def prepare(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def stream_session(spark: SparkSession, state_partitions: int | None = None) -> SparkSession:
    """A sibling session for stateful queries.

    The number of state partitions is fixed for the life of a checkpoint, so it
    is set apart from the batch session's shuffle width.
    """
    sibling = prepare(spark.newSession())
    for key, value in STREAM_CONF.items():
        sibling.conf.set(key, value)
    width = state_partitions or spark.sparkContext.defaultParallelism
    sibling.conf.set("spark.sql.shuffle.partitions", str(width))
    return sibling


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new folder name below the shared folder of ``spark.checkpoint.dir``."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="run-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/rollcall/{label}-{uuid.uuid4().hex}"


def keep(df: DataFrame) -> DataFrame:
    """The frame computed once and kept in the shared checkpoint folder."""
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(scratch_dir(spark, "checkpoints"))
    return df.checkpoint()


def staged(df: DataFrame, label: str, compression: str | None = None) -> DataFrame:
    """The frame written to a table in the shared folder and read back.

    For frames that are costly to make and read several times, by few columns.
    The shuffle files of the job are removed once the table is written.
    """
    path = scratch_dir(df.sparkSession, label)
    conf = df.sparkSession.conf
    before = conf.get(_SHUFFLES_GO, None)
    conf.set(_SHUFFLES_GO, "true")
    try:
        df.write.parquet(path, compression=compression)
    finally:
        conf.unset(_SHUFFLES_GO) if before is None else conf.set(_SHUFFLES_GO, before)
    stored = df.sparkSession.read.schema(df.schema).parquet(path)
    stored.staged_path = path
    passed = _PASSED.get()
    if passed is not None:
        passed.append(stored)
    return stored


_PASSED: ContextVar[list[DataFrame] | None] = ContextVar("passed", default=None)


@contextmanager
def passing() -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Frames staged in the block are removed at its end, but for those given to the function it yields.

    Those are left to the block around it, if any. What outlives the block may
    read none of the removed ones. After an error all stay.
    """
    outer, passed = _PASSED.get(), []
    mark = _PASSED.set(passed)

    def kept(stored: DataFrame) -> DataFrame:
        passed[:] = [frame for frame in passed if frame is not stored]
        if outer is not None:
            outer.append(stored)
        return stored

    try:
        yield kept
    finally:
        _PASSED.reset(mark)
    for stored in passed:
        remove(stored)


def remove(stored: DataFrame) -> None:
    """Removes the files of a staged frame that nobody reads any more."""
    spark = stored.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(stored.staged_path)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
