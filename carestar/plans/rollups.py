"""G5 / G6 / G15 / S11 — distinct counts that can be rolled up, and a monthly aggregate that is kept up to date.

Distinct counts do not add up over months. Stored per month as bitmaps over the
dense patient key (one row per group and bucket of 32,768 keys) they do: the
bitmaps of a quarter or a year are the union of those of its months, so any level
is exact and no level reads the fact again.

``refresh_months`` recomputes the months that a load touched and replaces their
partitions; the rest of the table is not read or written.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carestar.plans.questions import monthly_specialty_revenue
from carestar.sources import sinks

MONTH = ["year", "month"]


def distinct_bitmaps(rows: DataFrame, groups: list[str], key: str) -> DataFrame:
    """groups, bucket, bits: which keys (positive, dense) occur in each group."""
    return rows.groupBy(*groups, F.bitmap_bucket_number(F.col(key)).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(F.col(key))).alias("bits"))


def roll_up(bitmaps: DataFrame, groups: list[str], name: str) -> DataFrame:
    """Exact distinct count per group (some of the bitmaps' groups, or expressions of them added as columns)."""
    united = bitmaps.groupBy(*groups, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    return united.groupBy(*groups).agg(F.sum(F.bitmap_count("bits")).cast("long").alias(name))


def monthly_patients(star: dict) -> DataFrame:
    """Bitmaps of the patients seen by month and specialty."""
    dates = star["dim_date"].select("date_key", "year", "quarter", "month")
    rows = star["fact_encounters"].select("date_key", "specialty_key", "patient_key").join(dates, "date_key")
    return distinct_bitmaps(rows, ["year", "quarter", "month", "specialty_key"], "patient_key")


def touched_months(rows: DataFrame, dim_date: DataFrame) -> DataFrame:
    """year, month of the fact rows of a load."""
    return rows.select("date_key").distinct().join(dim_date.select("date_key", *MONTH), "date_key").select(*MONTH).distinct()


def refresh_months(spark: SparkSession, star: dict, touched: DataFrame, path: str) -> None:
    """Replace the touched months of the stored monthly rollup (one partition each) by what the fact says now.

    A month that has no rows any more loses its partition. Repeating it changes nothing.
    """
    days = star["dim_date"].join(touched, MONTH, "left_semi")
    with sinks.scratch_scope(spark):
        fresh = sinks.scratch_table(monthly_specialty_revenue(dict(star, dim_date=days)), "months")
        sinks.replace_partitions(fresh, path, MONTH)
        gone = touched.join(fresh.select(*MONTH).distinct(), MONTH, "left_anti").collect()      # calendar months: few
    for m in gone:
        sinks.drop_folder(spark, os.path.join(path, f"year={m['year']}", f"month={m['month']}"))
