"""Session settings, the shared work folder, and size-checked joins."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

# Bytes of text and numbers that a broadcast side may have; its hash table is a few times larger.
BROADCAST_BYTES = 32 << 20

_RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the operators rely on."""
    for key, value in _RUNTIME_CONF.items():
        spark.conf.set(key, value)
    # Without it the size of input splits follows the number of executors at
    # hand, so two scans of one file could be cut differently.
    if spark.conf.get("spark.sql.files.minPartitionNum", None) is None:
        spark.conf.set("spark.sql.files.minPartitionNum", str(spark.sparkContext.defaultParallelism))
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach.

    A cluster names it in ``spark.checkpoint.dir``. Only on a local master,
    as in tests, is one created where neither that nor a checkpoint folder is
    set; elsewhere a machine-local folder would lose rows, so it is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(configured)
        return configured.rstrip("/")
    existing = spark.sparkContext.getCheckpointDir()
    if existing is None:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        existing = tempfile.mkdtemp(prefix="tallyfold-")
        spark.sparkContext.setCheckpointDir(existing)
    return existing.rstrip("/")


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh sub-folder of the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def settle(df: DataFrame) -> DataFrame:
    """Write a reduced table to the shared folder once and go on from there.

    Like a checkpoint it cuts the lineage and survives lost executors, but the
    plan is run only once, and later readers take just the columns they need.
    """
    folder = new_folder(df.sparkSession, "settled")
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def join_small(left: DataFrame, right: DataFrame, on, how: str, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Join a wide table with a table that is usually small.

    ``right`` is materialised first and measured. Up to ``limit`` bytes it is
    broadcast, so ``left`` is not shuffled; above that the join is a plain
    shuffle join, where AQE splits a skewed key on the left.
    """
    right = settle(right)
    width = [F.coalesce(F.octet_length(c), F.lit(0)) if t == "string" else F.lit(8) for c, t in right.dtypes]
    size = right.agg(F.sum(sum(width, F.lit(16)))).first()[0] or 0
    if size <= limit:
        right = F.broadcast(right)
    return left.join(right, on, how)
