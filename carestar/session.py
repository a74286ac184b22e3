"""Spark session settings used by tests, bench and the pipeline.

On a cluster the session already exists; ``get_session`` only fills in what is
unset. ``checkpoint_dir`` reads ``spark.checkpoint.dir`` from the session and
only sets a scratch one when it is unset (local tests).
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings that matter for correctness (time zone) or for the plan shape
# (AQE re-planning, skew splits, runtime broadcast conversion).
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # runtime broadcast from measured shuffle sizes only (never from estimates)
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    # what a task reads of a shuffle; a row takes several times its compressed size in memory
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8m",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.optimizer.dynamicPartitionPruning.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.scheduler.mode": "FAIR",            # concurrent independent ETL steps share the cores
    "spark.driver.memory": "16g",
}


def get_session(master: str | None = None, app: str = "carestar",
                shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULTS)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    for k, v in conf.items():
        if not k.startswith("spark.ui") and not k.startswith("spark.driver"):
            try:
                spark.conf.set(k, v)
            except Exception:  # static conf on an existing session
                pass
    return spark


PARTITION_BYTES = 4 << 20          # of the source files for each partition of a shuffle


def partitions_of(source_bytes: int) -> int:
    """Partitions that a shuffle of sources of this size is cut into: a task's memory does not grow with the data."""
    return -(-source_bytes // PARTITION_BYTES)


def size_shuffles(spark: SparkSession, source_bytes: int) -> None:
    """Let shuffles begin with as many partitions as the source needs, the session's number at least; adaptive execution
    joins small ones."""
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), partitions_of(source_bytes))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(n))


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and staged tables: the session's ``spark.checkpoint.dir``.

    Only a local session (tests, bench) may go without one and then gets a scratch folder, which is recorded in
    the session; on a cluster no folder of one machine would do, so there an unset folder is an error.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        current = spark.sparkContext.getCheckpointDir()
    if not current:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        current = tempfile.mkdtemp(prefix="carestar-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        try:
            spark.conf.set("spark.checkpoint.dir", current)
        except Exception:  # not settable at runtime on this session: the context setting below suffices
            pass
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(current)
    return current
