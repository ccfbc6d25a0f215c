"""Session settings."""

from __future__ import annotations

import math
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings the plans rely on: UTC instants, failing casts, runtime re-planning, and string
# literals in which a backslash escapes.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.parser.escapedStringLiterals": "false",
}

# Stream state on local disk beside the executor heap, with changelogs as checkpoints.
STREAM_CONF = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

SHUFFLE_PARTITION_BYTES = 128 << 20


def configure(spark: SparkSession) -> SparkSession:
    """Apply the required runtime settings to a session."""
    for key, value in REQUIRED_CONF.items():
        spark.conf.set(key, value)
    return spark


def shuffle_partitions(shuffle_bytes: int, cores: int) -> int:
    """Reducers so that each holds about 128 MB and every core has work."""
    return max(math.ceil(shuffle_bytes / SHUFFLE_PARTITION_BYTES), cores)


@contextmanager
def sized_shuffles(spark: SparkSession, input_bytes: int) -> Iterator[int]:
    """Let the wide shuffles of one block start with reducers that fit the input.

    Sets what AQE starts from and then merges down, never less than the session has; the
    block should hold one stage's work, so that small tables keep the session's own count.
    """
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    before = spark.conf.get(key, None)
    own = int(before or spark.conf.get("spark.sql.shuffle.partitions"))
    sized = max(own, shuffle_partitions(input_bytes, spark.sparkContext.defaultParallelism))
    spark.conf.set(key, str(sized))
    try:
        yield sized
    finally:
        spark.conf.set(key, before) if before else spark.conf.unset(key)


def new_shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh path that all executors can reach, below `spark.checkpoint.dir`.

    Only a local-mode session without that setting falls back to a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("Set spark.checkpoint.dir to a folder shared by all executors")
        base = tempfile.mkdtemp(prefix="txspark-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
