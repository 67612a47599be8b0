"""Helpers shared by the training-data operators."""

from __future__ import annotations

import tempfile
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

#: A set of ids is broadcast only when it has at most this many rows (about
#: 30 MB as a hash table); beyond it the same join runs as a shuffle join.
BROADCAST_ROWS = 1_000_000
#: Bytes of an Arrow batch on its way to Python, in sessions that set no limit.
BATCH_BYTES = 4 << 20
#: Setting under which a query's shuffle files are deleted at its end.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Words are runs of anything but the six ASCII white-space bytes.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a local master, where driver and executors are one machine, may fall
    back to a temporary folder; a cluster without the setting is refused.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not (spark.sparkContext.master + "[").startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tidemart-shared-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def publish(df: DataFrame, name: str, codec: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and return it re-read: cuts lineage,
    is computed once, and survives the loss of any executor.  Its shuffle files
    go when it is written, not when the driver next collects garbage.  ``codec``
    is the files' compression, the session's if None."""
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"
    writer = df.write.option("compression", codec) if codec else df.write
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        writer.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before) if before is not None else spark.conf.unset(CLEANUP)
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch_path = path
    return out


def discard(published: DataFrame) -> None:
    """Delete the files of a published table that nothing reads any more."""
    sc = published.sparkSession.sparkContext
    path = sc._jvm.org.apache.hadoop.fs.Path(published.scratch_path)
    path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def filter_by_keys(df: DataFrame, keys: DataFrame, on: list[str], how: str) -> DataFrame:
    """Semi or anti join with a published key table.  Its row count is read
    first: up to BROADCAST_ROWS it is broadcast, above that it is shuffled."""
    if keys.count() <= BROADCAST_ROWS:
        keys = F.broadcast(keys)
    return df.join(keys, on, how)


def bound_batches(spark: SparkSession) -> None:
    """Rows with whole texts go to Python in batches of BATCH_BYTES instead of
    Spark's 64 MB, of which the JVM and each Python worker hold several.  It is
    a setting of the session, read when a query runs; the user's own stays."""
    limit = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(limit, None) is None:
        spark.conf.set(limit, f"{BATCH_BYTES}b")


def text_buffers(column) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of an Arrow string column and the offsets of its rows; a null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    if not len(column):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)
    offsets = offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if data is None:
        return np.empty(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def row_blocks(offsets: np.ndarray, limit: int = 1 << 20):
    """Ranges of rows whose texts have about ``limit`` bytes together (one row at least)."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)
