"""P13 / E2 / A9 / J4 — the fact loaded range by range, restartable.

What the ranges read is laid out once, one folder per range: the rows to load, the
numbering of their keys and the pre-aggregated measures. A range then reads its own
folders only. Last of all a plan row is written, so a load that is resumed goes by
the same ranges, rows and keys. Each range is built, written to a folder of its own
and committed by one row in ``marks``; the high-water mark is the end of the last
committed range. A range that fails leaves no row, so a later run goes on behind
the mark.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carestar.operators.audit import batch_slice, id_ranges
from carestar.operators.keys import number_keys
from carestar.sources import sinks

MARK = ("range_no long, range_start long, range_end long, expected_rows long, loaded_rows long, log_level string, "
        "attempt long")
PLAN = "lo long, hi long, step long"


def marks(spark: SparkSession, root: str) -> DataFrame:
    """The committed ranges, with the encounter id up to which the load is complete after each."""
    return attempts(spark, root).drop("attempt").withColumn("last_successful_encounter_id", F.col("range_end"))


def attempts(spark: SparkSession, root: str) -> DataFrame:
    """The committed ranges and the number of the run, from 1 on, that loaded each."""
    path = os.path.join(root, "marks")
    if not sinks.folder_exists(spark, path):         # nothing committed
        return spark.createDataFrame([], MARK)
    return spark.read.schema(MARK).parquet(path)


def high_water_mark(marks: DataFrame) -> DataFrame:
    """The last fully loaded encounter id."""
    return marks.agg(F.max("last_successful_encounter_id").alias("last_successful_encounter_id"))


def _lay_out(df: DataFrame, key: str, lo: int, step: int, path: str) -> None:
    """Write ``df`` with one folder per id range; ids are ranged over the tasks, so a task writes to few folders."""
    sinks.write_table(df.withColumn("range_no", F.floor((F.col(key) - lo) / F.lit(step)).cast("long")).repartitionByRange(key),
                      path, ["range_no"])


def _one_range(spark: SparkSession, path: str, number: int, schema) -> DataFrame:
    there = os.path.join(path, f"range_no={number}")
    if not sinks.folder_exists(spark, there):        # a range without rows
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(there)


def run_batches(spark: SparkSession, source: DataFrame, build: Callable[..., DataFrame], root: str, step: int,
                key: str = "encounter_id", numbered: str | None = None, sides: dict[str, DataFrame] | None = None,
                most: int | None = None) -> DataFrame:
    """Load ``build(rows of a range, ...)`` for every range of ``source``; returns the marks.

    ``source`` holds the rows that are expected to load. With ``numbered``, the keys are numbered under that name once
    for all ranges, and ``build`` also gets those of the range; then each of ``sides`` (tables with the same key), the
    range's rows only. Ranges that are committed already are passed over. ``most``: stop after so many ranges.
    """
    sides = sides or {}
    plan = os.path.join(root, "plan")
    if not sinks.folder_exists(spark, os.path.join(plan, "_SUCCESS")):
        ends = source.agg(F.min(key).alias("lo"), F.max(key).alias("hi")).first()
        if ends["lo"] is None:
            return marks(spark, root)
        _lay_out(source, key, ends["lo"], step, os.path.join(root, "source"))
        for name, side in sides.items():
            in_span = side.where(F.col(key).between(ends["lo"], ends["hi"]))
            _lay_out(in_span, key, ends["lo"], step, os.path.join(root, "sides", name))
        if numbered:
            ids = spark.read.parquet(os.path.join(root, "source")).select(key)
            _lay_out(number_keys(ids, key, numbered), key, ends["lo"], step, os.path.join(root, "keys"))
        sinks.write_table(spark.createDataFrame([(ends["lo"], ends["hi"], step)], PLAN).coalesce(1), plan)
    lo, hi, step = spark.read.schema(PLAN).parquet(plan).first()
    before = attempts(spark, root).agg(F.max("range_end").alias("done"), F.max("attempt").alias("attempt")).first()
    attempt = (before["attempt"] or 0) + 1
    for number, (first, last) in enumerate(id_ranges(lo, hi, step)):
        if before["done"] is not None and last <= before["done"]:
            continue
        if most is not None and most <= 0:
            break
        most = None if most is None else most - 1
        rows = batch_slice(_one_range(spark, os.path.join(root, "source"), number, source.schema), key, first, last)
        more = [_one_range(spark, os.path.join(root, "keys"), number, f"`{key}` long, `{numbered}` long")] if numbered else []
        more += [_one_range(spark, os.path.join(root, "sides", name), number, side.schema) for name, side in sides.items()]
        path = os.path.join(root, "rows", f"range_no={number}")
        sinks.write_table(build(rows, *more), path)            # a range that was cut off is written anew
        expected, loaded = rows.count(), spark.read.parquet(path).count()
        level = "INFO" if expected == loaded else "WARNING"
        spark.createDataFrame([(number, first, last, expected, loaded, level, attempt)], MARK).coalesce(1) \
            .write.mode("append").parquet(os.path.join(root, "marks"))
    return marks(spark, root)


def loaded(spark: SparkSession, root: str) -> DataFrame:
    """The rows of all ranges."""
    return spark.read.parquet(os.path.join(root, "rows")).drop("range_no")
