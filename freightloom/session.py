"""Session settings and the shared scratch folder."""

from __future__ import annotations

import math
import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Calendar arithmetic is defined in UTC. Streaming state goes to RocksDB so that
# it is bounded by disk, not by executor heap.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


# Else the shuffle files of a finished job stay on the disks until the driver happens to collect its garbage.
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: Codec of what a run writes for itself, which is read few times and can be as large as its input.
OWN_FILES = "zstd"

#: Independent steps of a run, such as tables, that go on side by side.
SIDE_BY_SIDE = 4
#: The same where each step shuffles all records, as their shuffle files lie on the disks at a time.
LARGE_SIDE_BY_SIDE = 2

# A shuffle starts with partitions of about this size; adaptive execution merges small ones, but never splits
# the partitions of an aggregation or a window.
PARTITION_MB = 128


def build_session(
    app_name: str = "freightloom", master: str | None = None, shuffle_gb: float = 1_000, **conf: str
) -> SparkSession:
    """Session with the settings this library expects; ``conf`` keys use ``__`` for dots.

    ``shuffle_gb`` is the size of the largest shuffle to be expected, compressed. It
    sets how many partitions a shuffle starts with, before small ones are merged.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    initial = max(8, math.ceil(shuffle_gb * 1_000 / PARTITION_MB))
    sized = {"spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(initial)}
    settings = SESSION_CONF | sized | {k.replace("__", "."): v for k, v in conf.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """Folder all executors can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder on this machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if spark.sparkContext.master.startswith("local"):
        return tempfile.mkdtemp(prefix="freightloom-")
    raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh, not yet existing folder for one run of ``purpose``."""
    return f"{scratch_root(spark)}/freightloom-{purpose}-{uuid.uuid4().hex}"


# Sessions in which shuffles are dropped: how many asked for it, and the setting before.
_dropping: dict[SparkSession, list] = {}
_lock = threading.Lock()


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Within it, the shuffle files of a query are removed when it ends, so that a run of many keeps those of few.

    The session's own setting holds again when the last that asked for it, in whatever thread, is done. A
    DataFrame that runs a second time shuffles anew.
    """
    with _lock:
        if spark not in _dropping:
            _dropping[spark] = [0, spark.conf.get(DROP_SHUFFLES, None)]
            spark.conf.set(DROP_SHUFFLES, "true")
        _dropping[spark][0] += 1
    try:
        yield
    finally:
        with _lock:
            _dropping[spark][0] -= 1
            if not _dropping[spark][0]:
                before = _dropping.pop(spark)[1]
                spark.conf.unset(DROP_SHUFFLES) if before is None else spark.conf.set(DROP_SHUFFLES, before)


def together(steps: list[Callable[[], object]], at_once: int = SIDE_BY_SIDE) -> list:
    """Results of independent steps, whose Spark jobs run side by side."""
    with ThreadPoolExecutor(at_once) as pool:
        return list(pool.map(lambda step: step(), steps))
