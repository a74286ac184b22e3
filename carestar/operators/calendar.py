"""S4 date spine and P2 dim_date."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carestar.functions.dates import (date_key, fiscal_quarter, fiscal_year, is_weekend,
                                     week_of_year_sunday)

DEFAULT_START, DEFAULT_END = "2020-01-01", "2030-12-31"


def date_spine(spark: SparkSession, start: str = DEFAULT_START, end: str = DEFAULT_END,
               partitions: int | None = None) -> DataFrame:
    """One row per day in [start, end]; a numeric ``range`` replaces the digit cross join.

    The span is bounded by the calendar (4,018 rows for 2020-2030).
    """
    n_days = (dt.date.fromisoformat(end) - dt.date.fromisoformat(start)).days
    ids = spark.range(0, max(n_days + 1, 0), numPartitions=partitions or 1)
    return ids.select(F.date_add(F.lit(start).cast("date"), F.col("id").cast("int")).alias("calendar_date"))


def build_dim_date(spark: SparkSession, start: str = DEFAULT_START, end: str = DEFAULT_END,
                   fiscal_start_month: int = 1) -> DataFrame:
    d = F.col("calendar_date")
    fy, fq = fiscal_year(d, fiscal_start_month), fiscal_quarter(d, fiscal_start_month)
    return date_spine(spark, start, end).select(
        date_key(d).alias("date_key"),
        d.alias("calendar_date"),
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.concat(F.lit("Q"), F.quarter(d), F.lit(" "), F.year(d)).alias("quarter_name"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.date_format(d, "MMMM yyyy").alias("month_year"),
        F.dayofmonth(d).alias("day_of_month"),
        F.dayofweek(d).alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        week_of_year_sunday(d).alias("week_of_year"),
        is_weekend(d).alias("is_weekend"),
        F.lit(False).alias("is_holiday"),
        fy.cast("int").alias("fiscal_year"),
        fq.cast("int").alias("fiscal_quarter"),
        F.concat(F.lit("FY"), fy, F.lit("-Q"), fq).alias("fiscal_period"),
    )
