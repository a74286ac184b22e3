"""S8 — a stored table laid out by key range, of which a range can be replaced.

Rows lie in one folder per ``width`` keys. Replacing a range writes the folders
that it touches, with the rows of theirs that stay, beside the table first, and
then puts them in place. Should that be cut off, the next call (or ``recover``)
puts the complete folders in place before anything else, so no row is lost, and
repeating a replacement changes nothing. Folders outside the range are not read.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carestar.sources import sinks

RANGE = "key_range"
PENDING = "_pending"


def _ranged(df: DataFrame, key: str, width: int) -> DataFrame:
    return df.withColumn(RANGE, F.floor(F.col(key) / F.lit(width)).cast("long"))


def write_ranges(df: DataFrame, path: str, key: str, width: int) -> None:
    """Write the table anew."""
    sinks.write_table(_ranged(df, key, width).repartitionByRange(RANGE, key), path, [RANGE])


def read_ranges(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop(RANGE)


def recover(spark: SparkSession, path: str) -> bool:
    """Finish a replacement that was cut off; whether there was one."""
    pending = os.path.join(path, PENDING)
    complete = sinks.folder_exists(spark, os.path.join(pending, "plan", "_SUCCESS"))
    if complete:
        first, last = spark.read.schema("first long, last long").parquet(os.path.join(pending, "plan")).first()
        staged = set(sinks.folder_names(spark, os.path.join(pending, "rows")))
        if staged:
            sinks.replace_partitions(spark.read.parquet(os.path.join(pending, "rows")), path, [RANGE])
        for name in sinks.folder_names(spark, path):                 # folders of the range that have no rows any more
            number = name.removeprefix(f"{RANGE}=")
            if number.lstrip("-").isdigit() and first <= int(number) <= last and name not in staged:
                sinks.drop_folder(spark, os.path.join(path, name))
    sinks.drop_folder(spark, pending)
    return complete


def replace_stored_range(spark: SparkSession, path: str, new: DataFrame, key: str, lo: int, hi: int, width: int) -> None:
    """Rows with ``key BETWEEN lo AND hi`` go, those of ``new`` in that range come. ``width`` is the one the table was written with."""
    recover(spark, path)
    first, last = lo // width, hi // width
    there = spark.read.parquet(path)
    staying = there.filter(F.col(RANGE).between(first, last) & ~F.col(key).between(lo, hi))
    coming = _ranged(new.filter(F.col(key).between(lo, hi)), key, width).select(*there.columns)
    pending = os.path.join(path, PENDING)
    sinks.write_table(staying.unionByName(coming).repartitionByRange(RANGE, key), os.path.join(pending, "rows"), [RANGE])
    sinks.write_table(spark.createDataFrame([(first, last)], "first long, last long").coalesce(1), os.path.join(pending, "plan"))
    recover(spark, path)
