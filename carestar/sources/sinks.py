"""Sinks (S5-S8): append, staged full refresh, source reset, idempotent range replace.

Nothing is overwritten in place while it may be read: a full refresh writes every
table of a run under a new staging folder and then publishes it by appending one
row to the ``_published`` log that readers resolve (newest row wins). A failed run
never leaves half-written tables. ``retain`` removes the stages that the log no
longer needs; scratch tables made within a ``scratch_scope`` go when it ends.
"""

from __future__ import annotations

import contextlib
import contextvars
import datetime as dt
import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carestar.session import checkpoint_dir

PUBLISHED = "_published"
STEPS = "_steps"            # in a stage: the tables that are complete, while its run has not ended


def append(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """``INSERT ... SELECT`` — append to a parquet table."""
    w = df.write.mode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def replace_partitions(df: DataFrame, path: str, partition_by: list[str]) -> None:
    """Replace the partitions that ``df`` has rows for; the others stay as they are. ``df`` must not read from them."""
    (df.repartitionByRange(*partition_by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_by).parquet(path))


_SCRATCH: contextvars.ContextVar[str | None] = contextvars.ContextVar("carestar-scratch", default=None)


@contextlib.contextmanager
def scratch_scope(spark: SparkSession, folder: str | None = None):
    """Scratch tables made within it (also by threads that copy its context) lie in one folder, which goes at the end.

    What is built from them must be written, or done with, by then.
    """
    folder = folder or os.path.join(checkpoint_dir(spark), "carestar-scratch", uuid.uuid4().hex)
    token = _SCRATCH.set(folder)
    try:
        yield folder
    finally:
        _SCRATCH.reset(token)
        drop_folder(spark, folder)


def scratch_table(df: DataFrame, name: str, lasting: bool = False) -> DataFrame:
    """Cut lineage: write ``df`` once into the shared checkpoint folder and read it back. ``lasting``: it outlives scopes."""
    folder = (None if lasting else _SCRATCH.get()) or os.path.join(checkpoint_dir(df.sparkSession), "carestar-scratch")
    path = os.path.join(folder, f"{name}-{uuid.uuid4().hex}")
    schema = df.schema
    write_table(df, path)
    return df.sparkSession.read.schema(schema).parquet(path)


def _located(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def drop_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder that this library wrote."""
    fs, where = _located(spark, path)
    fs.delete(where, True)


def make_folder(spark: SparkSession, path: str) -> None:
    fs, where = _located(spark, path)
    fs.mkdirs(where)


def make_file(spark: SparkSession, path: str) -> None:
    """An empty file, whose name is what it says."""
    fs, where = _located(spark, path)
    fs.create(where, True).close()


def file_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the files in a folder (none if it does not exist)."""
    fs, where = _located(spark, path)
    return [f.getPath().getName() for f in fs.listStatus(where) if f.isFile()] if fs.exists(where) else []


def folder_exists(spark: SparkSession, path: str) -> bool:
    fs, where = _located(spark, path)
    return fs.exists(where)


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder (none if it does not exist)."""
    fs, where = _located(spark, path)
    return [f.getPath().getName() for f in fs.listStatus(where) if f.isDirectory()] if fs.exists(where) else []


def new_stage(root: str, run_id: str | None = None) -> str:
    return os.path.join(root, "runs", run_id or uuid.uuid4().hex)


def publish(spark: SparkSession, root: str, stage: str) -> None:
    """S6 swap: record ``stage`` as the current star by appending one row to
    ``root/_published``. Appends add new files and never rewrite old ones, so this
    works on any filesystem Spark writes to, and a reader sees either the old or
    the new stage."""
    row = [(stage, dt.datetime.now(dt.timezone.utc))]
    spark.createDataFrame(row, "stage string, published_at timestamp").coalesce(1) \
        .write.mode("append").parquet(os.path.join(root, PUBLISHED))


def current_stage(spark: SparkSession, root: str) -> str | None:
    """The most recently published stage (one row per run; newest wins)."""
    stages = published_stages(spark, root, 1)
    return stages[0] if stages else None


def published_stages(spark: SparkSession, root: str, most: int) -> list[str]:
    """The last ``most`` published stages, newest first."""
    path = os.path.join(root, PUBLISHED)
    if not folder_exists(spark, path):
        return []
    log = spark.read.schema("stage string, published_at timestamp").parquet(path)
    last = log.groupBy("stage").agg(F.max("published_at").alias("at"))
    return [r["stage"] for r in last.orderBy(F.desc("at"), F.desc("stage")).limit(most).collect()]


def retain(spark: SparkSession, root: str, keep: int = 2, needed: tuple[str, ...] = ()) -> list[str]:
    """Remove the stages under ``root`` but for the last ``keep`` published ones and those named in ``needed``.

    Stages of runs that may still go on (or be resumed) have a ``_steps`` folder and stay. Returns the names removed.
    """
    if keep < 1:
        raise ValueError("the published stage cannot be removed")
    kept = {os.path.basename(s) for s in published_stages(spark, root, keep)} | set(needed)
    runs, gone = os.path.join(root, "runs"), []
    for name in folder_names(spark, runs):
        if name not in kept and not folder_exists(spark, os.path.join(runs, name, STEPS)):
            drop_folder(spark, os.path.join(runs, name))
            gone.append(name)
    return sorted(gone)


def read_star(spark: SparkSession, root: str, name: str) -> DataFrame:
    stage = current_stage(spark, root)
    if stage is None:
        raise FileNotFoundError(f"no published star schema under {root}")
    return spark.read.parquet(os.path.join(stage, name))


def full_refresh(spark: SparkSession, tables: dict[str, DataFrame], root: str, run_id: str | None = None,
                 partition_by: dict[str, list[str]] | None = None) -> str:
    """Truncate + reload, as write-all-to-a-new-stage then publish."""
    stage = new_stage(root, run_id)
    for name, df in tables.items():
        write_table(df, os.path.join(stage, name), (partition_by or {}).get(name))
    publish(spark, root, stage)
    return stage


def empty_like(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def reset_source(spark: SparkSession, base: str, tables: dict[str, T.StructType]) -> None:
    """Empty the transactional tables; reference tables are kept."""
    for name, schema in tables.items():
        write_table(empty_like(spark, schema), os.path.join(base, name))


def replace_range(target: DataFrame, new: DataFrame, key: str, lo, hi) -> DataFrame:
    """Delete rows with ``key BETWEEN lo AND hi`` then insert ``new`` (idempotent).

    The rows of ``new`` outside the range are not inserted, so running it twice
    yields the same table. At scale, write the result partition-wise (dynamic
    partition overwrite) rather than rewriting the whole table.
    """
    keep = target.filter(~F.col(key).between(lo, hi) | F.col(key).isNull())
    return keep.unionByName(new.filter(F.col(key).between(lo, hi)))
