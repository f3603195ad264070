"""Session settings the jobs are tuned for, and the shared work folder."""

from __future__ import annotations

import atexit
import logging
import tempfile
import threading
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from functools import lru_cache

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Size-checked automatic broadcast: dimension slices up to 64 MB.
    "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def side_by_side(spark: SparkSession, jobs: dict[str, Callable[[], object]]) -> dict[str, object]:
    """Run independent Spark jobs at the same time, so that small ones do not leave the cluster idle.

    Waits for all of them; the first failure is raised then.
    """
    with ThreadPoolExecutor(max_workers=len(jobs)) as pool:
        running = {name: pool.submit(inheritable_thread_target(spark)(job)) for name, job in jobs.items()}
    return {name: job.result() for name, job in running.items()}


#: With this setting Spark deletes the shuffle files of a query when it ends, not when the driver collects garbage.
TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_tidying, _one = {}, threading.Lock()  # how many writes of a session go on, and what was set before the first


@contextmanager
def tidy(spark: SparkSession) -> Iterator[None]:
    """Writes in here free their shuffle files at their end: what they moved does not lie beside what the next ones move.

    For writes, which are planned and run once; they may go on side by side.
    """
    key = spark.sparkContext.applicationId
    with _one:
        before, running = _tidying.get(key, (None, 0))
        _tidying[key] = (spark.conf.get(TIDY, "false") if not running else before, running + 1)
        spark.conf.set(TIDY, "true")
    try:
        yield
    finally:
        with _one:
            before, running = _tidying[key]
            _tidying[key] = (before, running - 1)
            if running == 1:
                spark.conf.set(TIDY, before)


SHUFFLE_TARGET_BYTES = 256 * 1024 * 1024


def shuffle_partitions(shuffled_bytes: int) -> int:
    """Shuffle partitions to start from, so that each holds about 256 MB; adaptive execution merges small ones."""
    return max(8, -(-shuffled_bytes // SHUFFLE_TARGET_BYTES))


def build_session(app_name: str = "starmill", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the settings above; ``extra`` keys use ``__`` for dots.

    For a large load pass ``spark__sql__shuffle__partitions=str(shuffle_partitions(bytes))``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


@lru_cache(maxsize=None)
def _local_folder(application_id: str) -> str:
    return tempfile.mkdtemp(prefix="starmill-")


@lru_cache(maxsize=None)
def _cleaned_at_exit(spark: SparkSession, folder: str) -> str:
    """The session's own folder is deleted when the driver ends."""
    def clean() -> None:
        try:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
        except Exception:  # noqa: BLE001  the session has ended before: the folder is left to the cluster's clean-up
            logging.getLogger("starmill").info("left %s behind", folder)

    atexit.register(clean)
    return folder


def work_folder(spark: SparkSession) -> str:
    """Folder for written intermediate tables, shared by all executors.

    A cluster names it in ``spark.checkpoint.dir``.  Only a local session may
    fall back to a folder of this machine.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    app = spark.sparkContext.applicationId
    if shared:
        return _cleaned_at_exit(spark, f"{shared.rstrip('/')}/starmill-{app}")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return _cleaned_at_exit(spark, _local_folder(app))
