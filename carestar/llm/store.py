"""Where intermediate tables live and how they are written.

Lineage is cut by Parquet tables in the folder that the cluster names in
``spark.checkpoint.dir``: every executor reads it, so a lost executor costs a
task, not the job.
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carestar.session import checkpoint_dir
from carestar.sources.sinks import drop_folder

FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
BROADCAST_ROWS = 50_000      # a side is only broadcast when counted at or below this


@contextmanager
def freed_shuffles(spark: SparkSession):
    """Within it, the shuffle files of an action go when the action ends (they hold nothing that is read again)."""
    before = spark.conf.get(FREE_SHUFFLES, "false")
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(FREE_SHUFFLES, before)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"
    schema = df.schema
    with freed_shuffles(spark):
        df.write.mode("overwrite").parquet(path)
    table = spark.read.schema(schema).parquet(path)
    table.written_at = path
    return table


def release(*tables: DataFrame) -> None:
    """Delete tables that ``materialize`` returned, once whatever reads them has been written itself."""
    for t in tables:
        drop_folder(t.sparkSession, t.written_at)


def small_or_shuffled(df: DataFrame, rows: int | None = None, most: int = BROADCAST_ROWS) -> DataFrame:
    """Mark ``df`` for broadcast when it has at most ``most`` rows; else leave it to a shuffled join."""
    n = df.count() if rows is None else rows
    return F.broadcast(df) if n <= most else df


def documents(df: DataFrame, *more: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only ``doc_id`` (long), ``text`` (string) and the named further columns; whatever else the table has is left out."""
    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                     *[F.col(c) for c in more])
