"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

#: Settings every job relies on. Sizes are left to the cluster's own defaults.
REQUIRED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


#: Bytes of input one shuffle partition starts with; adaptive execution merges the smaller ones.
PARTITION_BYTES = 128 << 20


def configure(spark: SparkSession, input_bytes: int | None = None) -> SparkSession:
    """Apply the settings the operators need: UTC days, ANSI casts, adaptive plans.

    Given the size of the largest input, the number of shuffle partitions starts high enough for one
    to fit in an executor's memory; without it the session's own number stays.
    """
    for key, value in REQUIRED.items():
        spark.conf.set(key, value)
    if input_bytes:
        usual = int(spark.conf.get("spark.sql.shuffle.partitions"))
        wanted = max(usual, -(-input_bytes // PARTITION_BYTES))
        spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(wanted))
    return spark


def local_session(cores: str = "8", memory: str = "8g", app: str = "relata") -> SparkSession:
    """A single-machine session for tests and the bench."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", cores)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="relata-warehouse-"))
    )
    for key, value in REQUIRED.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only where that setting is absent, as in tests on one machine, a local folder is made and set.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if named:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(named)
        return named.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="relata-checkpoint-"))
    return context.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark)}/{purpose}-{uuid.uuid4().hex}"
