"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from math import ceil

from pyspark.sql import SparkSession

SHUFFLE_GROWTH = 3
# Files a task of a partitioned write may have open, what a task that sorts rows reads
# at most, and the rows that such a task is to get from a shuffle.
OPEN_FILES = 64
SORTED_MB = 32
SORTED_ROWS = 500_000
# Setting of Spark 4.1, off by default; earlier versions know none and keep the files.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_CONF_LOCK = threading.RLock()
_HELD: dict[str, list[tuple[int, int]]] = {}
# What the session has set, if anything, and what holds in it, Spark's default included.
_BEFORE: dict[str, tuple[str | None, str]] = {}


def recommended_conf(
    pass_gb: float, months_per_pass: int = 1, target_file_mb: int = 256
) -> dict[str, str]:
    """Settings for a cluster run whose largest pass reads ``pass_gb`` of parquet.

    The clean table is written straight from the deduplication shuffle, so every task writes one
    file per month it holds. Partitions of ``months_per_pass * target_file_mb`` therefore give
    files of the target size without a second shuffle. Spark merges small partitions at run time
    but never adds any, so it starts from the number that the shuffled rows, about
    ``SHUFFLE_GROWTH`` times their parquet size, need.

    With a writer per month and side a task need not sort its rows again before it writes them;
    their buffers together hold at most the task's own output.
    """
    partition_mb = months_per_pass * target_file_mb
    partitions = max(200, ceil(pass_gb * 1024 * SHUFFLE_GROWTH / partition_mb))
    return {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": f"{partition_mb}m",
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": "512m",
        # On by default; without it a key on many rows would reach one reducer whole.
        "spark.sql.optimizer.windowGroupLimitThreshold": "1000",
        "spark.sql.maxConcurrentOutputFileWriters": str(2 * months_per_pass + 2),
    }


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new folder name under the cluster's ``spark.checkpoint.dir``.

    A machine-local temporary folder is used only when Spark itself is local.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="tripstrata-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


@contextmanager
def open_writers(spark: SparkSession) -> Iterator[None]:
    """Let tasks of partitioned writes keep a file open for each partition instead of sorting their rows.

    A sort holds all rows of a task, and spills them once they do not fit; open files hold no more than the task's
    own output. Spark sorts the rest of a task that meets more than ``OPEN_FILES`` partitions.
    """
    with _at_least(spark, "spark.sql.maxConcurrentOutputFileWriters", OPEN_FILES):
        yield


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Let Spark delete the shuffle files of a write when it ends.

    Otherwise they stay until the driver happens to collect its garbage, so that those of all steps may lie on the disks
    at once. A write makes a plan of its own, which nothing runs again.
    """
    with _at_least(spark, FREE_SHUFFLES, True, default="false"):
        yield


@contextmanager
def table_writes(spark: SparkSession) -> Iterator[None]:
    """The settings of all writes to tables."""
    with open_writers(spark), freed_shuffles(spark):
        yield


@contextmanager
def small_sorts(spark: SparkSession, rows: int) -> Iterator[None]:
    """Bound what one task sorts, on either side of a shuffle of about ``rows`` rows, whatever the input."""
    with (
        _at_least(spark, "spark.sql.files.maxPartitionBytes", SORTED_MB << 20, -1),
        _at_least(spark, "spark.sql.shuffle.partitions", ceil(rows / SORTED_ROWS)),
    ):
        yield


@contextmanager
def _at_least(
    spark: SparkSession, name: str, value: int, sign: int = 1, default: str | None = None
) -> Iterator[None]:
    """Raise a setting to ``value``, or lower it with a ``sign`` of -1, and set it back at the end.

    A setting that the session leaves counts with its default, given for one that Spark may not know. Threads may
    overlap: the furthest of all values holds, and the last to leave restores the session's.
    """
    held = (sign, value)
    with _CONF_LOCK:
        if not _HELD.get(name):
            own = spark.conf.get(name, None)
            _HELD[name], _BEFORE[name] = [], (own, own or default or spark.conf.get(name))
        _HELD[name].append(held)
        _set_furthest(spark, name)
    try:
        yield
    finally:
        with _CONF_LOCK:
            _HELD[name].remove(held)
            _set_furthest(spark, name)


def _set_furthest(spark: SparkSession, name: str) -> None:
    before, holding = _BEFORE[name]
    if not _HELD[name]:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)
        return
    values = [value for _, value in _HELD[name]] + [_number(holding)]
    sign = _HELD[name][0][0]
    spark.conf.set(name, str(max(values, key=lambda value: sign * value)).lower())


def _number(text: str) -> int:
    """A setting as a number; sizes may have a unit."""
    if text.lower() in ("true", "false"):
        return text.lower() == "true"
    digits = text.strip().lower().removesuffix("b")
    units = {"k": 10, "m": 20, "g": 30, "t": 40}
    shift = units.get(digits[-1:], 0)
    return int(digits[:-1] if shift else digits) << shift
