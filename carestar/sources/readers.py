"""Scans (S1-S3): parquet tables, headered CSV with a declared schema, literal rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def _file_system(spark: SparkSession, path: str):
    """Hadoop's view of a path: the same one that Spark's readers have."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def table_path(spark: SparkSession, base: str, name: str) -> str:
    """``base/name.parquet`` when that exists (driver layout), else ``base/name``."""
    path = f"{base.rstrip('/')}/{name}.parquet"
    fs, where = _file_system(spark, path)
    return path if fs.exists(where) else f"{base.rstrip('/')}/{name}"


def table_state(spark: SparkSession, base: str, names) -> tuple:
    """(bytes, files, time of change) of each table: a rewritten table has another state."""
    out = []
    for name in names:
        fs, where = _file_system(spark, table_path(spark, base, name))
        content = fs.getContentSummary(where)
        out.append((content.getLength(), content.getFileCount(), fs.getFileStatus(where).getModificationTime()))
    return tuple(out)


def read_source(spark: SparkSession, base: str, name: str) -> DataFrame:
    """Table scan. Column pruning and filters reach the parquet reader."""
    return spark.read.parquet(table_path(spark, base, name))


def read_tables(spark: SparkSession, base: str, names) -> dict[str, DataFrame]:
    return {n: read_source(spark, base, n) for n in names}


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Headered CSV with quoted strings, read with a declared schema (no inference)."""
    return (spark.read.schema(schema).option("header", True).option("quote", '"')
            .option("escape", '"').option("mode", "FAILFAST").csv(path))


def literal_rows(spark: SparkSession, rows: list[tuple], schema: T.StructType) -> DataFrame:
    """S3: inline code-table rows (``VALUES``); only for small fixed tables."""
    return spark.createDataFrame(rows, schema)
