"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# What the operators rely on: tables dealt by an id are joined on more keys than the id
# without a shuffle, AQE splits hot join partitions, splits and merges
# the partitions of a REBALANCE before a write, and may turn a sort-merge join
# into a broadcast once the real size of a side is known.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


# Bytes of input per shuffle partition, and the least number of partitions.
PARTITION_BYTES = 256 * 1024**2
MIN_PARTITIONS = 200


def shuffle_partitions(input_bytes: int) -> int:
    """Partitions that keep a shuffle of ``input_bytes`` within executor memory.

    AQE merges partitions that turn out small, but cuts only hot ones, so the number
    to start from must fit the data.
    """
    return max(MIN_PARTITIONS, -(-input_bytes // PARTITION_BYTES))


def size_shuffles(spark: SparkSession, input_bytes: int) -> None:
    """Set the shuffle partitions of a session for ``input_bytes``; what runs later uses them."""
    spark.conf.set("spark.sql.shuffle.partitions", shuffle_partitions(input_bytes))


def build_session(
    app_name: str,
    master: str | None = None,
    input_bytes: int | None = None,
    **settings: str,
) -> SparkSession:
    """Return a session with ``SETTINGS``; ``settings`` uses ``__`` for the dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for name, value in SETTINGS.items():
        builder = builder.config(name, value)
    if input_bytes is not None:
        builder = builder.config("spark.sql.shuffle.partitions", shuffle_partitions(input_bytes))
    for name, value in settings.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()


def join_by_bucket(spark: SparkSession) -> None:
    """Let joins on more keys than the one that tables are bucketed by keep the buckets, in a
    session that ``build_session`` did not make too. It changes plans, never rows."""
    name = "spark.sql.requireAllClusterKeysForCoPartition"
    spark.conf.set(name, SETTINGS[name])


def scratch_path(spark: SparkSession, label: str) -> str:
    """Return a new path below the folder that all executors share.

    The folder is the one in ``spark.checkpoint.dir``. Only a local session
    without that setting gets a folder of this machine instead.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("Set spark.checkpoint.dir to a folder that all executors share.")
        shared = tempfile.mkdtemp(prefix="farevalue-")
    return f"{shared.rstrip('/')}/{label}-{uuid.uuid4().hex}"
