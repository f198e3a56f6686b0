"""Session settings and the shared folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

SHARED_FOLDER = "spark.checkpoint.dir"

# Settings the jobs were planned with. The advisory size bounds what a writing
# task takes from a rebalance; columnar files come out several times smaller.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


# A shuffle starts with one partition per this many bytes expected to move.
BYTES_PER_PARTITION = 256 << 20
INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def configured(
    builder: SparkSession.Builder, shuffle_bytes: int | None = None
) -> SparkSession.Builder:
    """Apply the settings; ``shuffle_bytes`` is the most that one shuffle will move.

    Adaptive execution merges partitions, and splits them where rows may be split,
    but cannot split a group: a key check over a large table needs enough to start.
    """
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    if shuffle_bytes is not None:
        builder = builder.config(INITIAL_PARTITIONS, partitions_for(shuffle_bytes))
    return builder


def partitions_for(shuffle_bytes: int) -> int:
    return max(200, -(-shuffle_bytes // BYTES_PER_PARTITION))


BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 4 << 20


def small_batches(spark: SparkSession) -> None:
    """Let Arrow batches of the session hold no more than a few megabytes of texts.

    A batch is held by Spark and by Python at once, for every task of an executor.
    """
    spark.conf.set(BATCH, str(BATCH_BYTES))


def shared_folder(spark: SparkSession) -> str:
    """A new path below the folder the cluster shares.

    Only a session in one process, as in tests, may do without that setting.
    """
    base = spark.conf.get(SHARED_FOLDER, None)
    if base is None:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError(f"set {SHARED_FOLDER} to a folder every executor can reach")
        base = tempfile.mkdtemp(prefix="smeltery-")
    return f"{base.rstrip('/')}/smeltery/{uuid.uuid4().hex}"
