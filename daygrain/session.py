"""Session settings and the shared folder every job may write scratch data to."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Runtime settings the plans rely on. Shuffle sizes are left to AQE: a fixed partition count that
# suits a laptop is wrong on a cluster.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even where that costs one more shuffle above the join.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # What a query shuffled is of no use once it has ended: without this the files stay until the
    # driver happens to collect its garbage, and a run of many queries fills the disks.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}
# How the zones' Parquet files are packed.
PACKED = {"compression": "zstd"}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings to a session somebody else started."""
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark


@contextmanager
def millisecond_timestamps(spark: SparkSession):
    """Write Parquet timestamps in milliseconds, which external readers share, inside the block."""
    name = "spark.sql.parquet.outputTimestampType"
    before = spark.conf.get(name)
    spark.conf.set(name, "TIMESTAMP_MILLIS")
    try:
        yield
    finally:
        spark.conf.set(name, before)


@contextmanager
def shuffle_partitions(spark: SparkSession, n: int):
    """Deal shuffles to `n` partitions inside the block, as a table in `n` buckets needs them."""
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    spark.conf.set(name, n)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def build_session(app: str = "daygrain", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in {**SETTINGS, **extra}.items():
        builder = builder.config(name, value)
    return configure(builder.getOrCreate())


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder under the cluster's shared `spark.checkpoint.dir`.

    Only a local session without that setting gets a temporary folder of this machine; on a
    cluster the executors could not see such a folder, so a missing setting is an error there.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        base = tempfile.mkdtemp(prefix="daygrain-")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
