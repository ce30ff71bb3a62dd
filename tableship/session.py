"""Sessions and the shared folder that jobs write to."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import lru_cache

from pyspark.sql import SparkSession

MIB = 1024 * 1024


def get_session(app_name: str = "tableship", master: str | None = None, **conf) -> SparkSession:
    """Session with a fixed UTC zone, so that calendar days do not depend on the host.

    Everything else (memory, executors, shuffle partitions) is left to the submit
    configuration unless given in ``conf``; see ``cluster_conf`` for sizes.
    """
    builder = SparkSession.builder.appName(app_name).config("spark.sql.session.timeZone", "UTC")
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def cluster_conf(
    data_bytes: int, max_reducers: int = 20_000, max_splits: int = 200_000
) -> dict[str, str]:
    """Settings for moving ``data_bytes``.

    A shuffle has a block for every pair of map and reduce tasks. Reduce tasks are
    planned for 128 MiB each and map tasks likewise, until there would be more than
    ``max_reducers`` and ``max_splits`` of them; from there on tasks grow instead. AQE merges
    what turns out small.
    """
    reducers = min(max(200, -(-data_bytes // (128 * MIB))), max_reducers)
    split = max(128 * MIB, -(-data_bytes // max_splits))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(reducers),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": f"{128 * MIB}b",
        "spark.sql.files.maxPartitionBytes": f"{split}b",
        "spark.sql.session.timeZone": "UTC",
    }


@lru_cache(maxsize=1)
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="tableship-")


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir`` where it is set.

    Only a local session falls back to a temporary folder of this machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if spark.conf.get("spark.master", "").startswith("local"):
        return _local_folder()
    raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")


def fresh_folder(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/tableship/{label}-{uuid.uuid4().hex}"


@contextmanager
def timestamp_statistics(spark: SparkSession) -> Iterator[None]:
    """Timestamps written within are kept as microseconds. Spark's default form, INT96, has
    no minimum and maximum in the files, so that no reader could skip by time."""
    key = "spark.sql.parquet.outputTimestampType"
    before = spark.conf.get(key)
    spark.conf.set(key, "TIMESTAMP_MICROS")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def sibling_session(spark: SparkSession, **conf) -> SparkSession:
    """Second session of the same application with the same settings plus ``conf``.

    Lets one scan run under its own settings without touching the caller's.
    """
    other = spark.newSession()
    inherited = other.conf.getAll
    for key, value in spark.conf.getAll.items():
        if inherited.get(key) != value and other.conf.isModifiable(key):
            other.conf.set(key, value)
    for key, value in conf.items():
        other.conf.set(key.replace("__", "."), value)
    return other
