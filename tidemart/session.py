"""Spark session defaults for the analytics layer.

All timestamps in this package are ``TIMESTAMP_NTZ`` holding UTC wall-clock
time, so no result depends on ``spark.sql.session.timeZone``.  The session
zone is still pinned to UTC for anything a user adds on top.
"""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable, Iterable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

T = TypeVar("T")
#: Independent jobs that the driver runs side by side, at most.
MOST_JOBS = 6

# Settings that matter for the plans in this package.  AQE re-plans joins
# from runtime sizes (broadcast only when the measured side is small),
# coalesces small shuffle partitions and splits skewed join partitions.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.sources.partitionOverwriteMode": "static",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(
    master: str | None = "local[*]",
    app_name: str = "tidemart",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the package defaults.

    On a cluster pass ``master=None`` and let spark-submit decide; size
    ``shuffle_partitions`` so one partition is ~128-256 MB of shuffle data.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


TARGET_SHUFFLE_PARTITION_BYTES = 256 * 1024**2


def shuffle_partitions_for(input_bytes: int, target_bytes: int = TARGET_SHUFFLE_PARTITION_BYTES,
                           min_partitions: int = 8) -> int:
    """Shuffle partition count that keeps a partition near ``target_bytes``
    for the largest shuffle (at most the size of the largest input, e.g.
    line items).  AQE coalesces partitions that come out smaller, and splits
    skewed ones, so this is the upper bound a stage starts from.

    100 TB of line items -> 409,600 partitions; 600 k test rows (tens of MB)
    -> the minimum.
    """
    n = -(-int(input_bytes) // int(target_bytes))
    return max(min_partitions, n)


def plan_bytes(df: DataFrame) -> int:
    """Size of the files under ``df`` by the optimizer's statistics (a listing,
    no data is read); 0 if the plan does not know its size."""
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return 0 if size >= int(df.sparkSession.conf.get("spark.sql.defaultSizeInBytes", str(2**62))) else size


def size_shuffles(spark: SparkSession, inputs: Iterable[DataFrame]) -> int:
    """Set ``spark.sql.shuffle.partitions`` from the largest input (a runtime
    SQL setting), never below what is set; returns the value set."""
    n = shuffle_partitions_for(max((plan_bytes(df) for df in inputs), default=0),
                               min_partitions=int(spark.conf.get("spark.sql.shuffle.partitions")))
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    return n


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints.

    A cluster names it in ``spark.checkpoint.dir`` (a static setting, read
    from the session); that value is always used.  Only when it is unset —
    local runs and tests — a fresh temporary folder is made.  The context's
    checkpoint directory is set once; later calls reuse it.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured and not (sc.master + "[").startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    sc.setCheckpointDir(configured or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints")
    return sc.getCheckpointDir()


def shared_dir(spark: SparkSession) -> str:
    """Stable shared folder for state that must survive an application
    restart (e.g. stream checkpoints): the configured
    ``spark.checkpoint.dir`` itself.  ``SparkContext.getCheckpointDir`` adds
    a per-application subfolder and is only right for RDD checkpoints.  Falls
    back to ``checkpoint_dir`` when nothing is configured (local runs)."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    return configured or checkpoint_dir(spark)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder for an intermediate table under the shared folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/tables/{name}-{uuid.uuid4().hex}"


#: Setting under which a query's shuffle files are deleted at its end, not when the driver next collects garbage.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_releasing: dict[str, tuple[int, str | None]] = {}  # session -> blocks it is in, and its own setting
_releasing_lock = threading.Lock()


@contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the queries started within the block are deleted as each
    ends.  Blocks may nest and overlap in threads.  Don't return a DataFrame made
    in the block that shuffles: its files would go with its first action."""
    session = spark._jsparkSession.sessionUUID()
    with _releasing_lock:
        blocks, own = _releasing.get(session, (0, spark.conf.get(SHUFFLE_CLEANUP, None)))
        _releasing[session] = (blocks + 1, own)
        spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        with _releasing_lock:
            blocks, own = _releasing.pop(session)
            if blocks > 1:
                _releasing[session] = (blocks - 1, own)
            elif own is None:
                spark.conf.unset(SHUFFLE_CLEANUP)
            else:
                spark.conf.set(SHUFFLE_CLEANUP, own)


def together(jobs: Sequence[Callable[[], T]]) -> list[T]:
    """Results of independent Spark jobs started side by side: the tasks of one
    fill the cores that another, with few tasks or in its last ones, leaves idle.
    All are waited for; the first error is raised."""
    if len(jobs) < 2:
        return [job() for job in jobs]
    with ThreadPoolExecutor(max_workers=min(len(jobs), MOST_JOBS)) as pool:
        inherit = inheritable_thread_target(SparkSession.active())
        return [started.result() for started in [pool.submit(inherit(job)) for job in jobs]]


@contextmanager
def runtime_filters(spark: SparkSession, least_bytes: int = 0):
    """Within the block, joins of a selective side with scans of ``least_bytes``
    or more (Spark's default: 10 GB) get a Bloom filter of the selective side's
    keys, evaluated right above the scan: rows without a partner are neither
    shuffled nor computed any further."""
    settings = {
        "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
        "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": str(least_bytes),
    }
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
