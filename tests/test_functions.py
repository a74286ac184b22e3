import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from carestar.functions import (age_band, date_key, is_weekend, length_of_stay, safe_ratio,
                                week_of_year_sunday, years_between)
from carestar.operators.calendar import build_dim_date


def one(spark, col, rows, schema):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(col).collect()]


def test_week_mode0_edges(spark):
    # 2017-01-01 is a Sunday (week 1); 2022-01-01 is a Saturday (week 0); 2022-12-31 week 52; 2012-12-31 week 53
    days = [dt.date(2017, 1, 1), dt.date(2022, 1, 1), dt.date(2022, 12, 31), dt.date(2012, 12, 31)]
    got = one(spark, week_of_year_sunday("d"), [(d,) for d in days], "d date")
    assert got == [1, 0, 52, 53]


def test_date_key_weekend(spark):
    got = spark.createDataFrame([(dt.date(2024, 3, 9),), (dt.date(2024, 3, 11),)], "d date") \
        .select(date_key("d").alias("k"), is_weekend("d").alias("w")).collect()
    assert [(r.k, r.w) for r in got] == [(20240309, True), (20240311, False)]


def test_years_between_feb29(spark):
    rows = [(dt.date(2000, 2, 29), dt.date(2001, 2, 28)), (dt.date(2000, 2, 29), dt.date(2001, 3, 1)),
            (dt.date(2007, 1, 1), dt.date(2025, 1, 1)), (dt.date(2007, 1, 2), dt.date(2025, 1, 1))]
    got = one(spark, years_between("a", "b"), rows, "a date, b date")
    assert got == [0, 1, 18, 17]


def test_age_band_edges(spark):
    as_of = dt.date(2025, 1, 1)
    dobs = [dt.date(2025 - a, 1, 1) for a in (17, 18, 34, 35, 49, 50, 64, 65)] + [dt.date(2007, 1, 2)]
    got = one(spark, age_band("d", F.lit(as_of)), [(d,) for d in dobs], "d date")
    assert got == ["0-17", "18-34", "18-34", "35-49", "35-49", "50-64", "50-64", "65+", "0-17"]


def test_length_of_stay(spark):
    rows = [("Inpatient", dt.datetime(2024, 1, 1, 23, 59), dt.datetime(2024, 1, 2, 0, 0)),
            ("Inpatient", dt.datetime(2024, 1, 1, 10), None),
            ("Outpatient", dt.datetime(2024, 1, 1, 10), dt.datetime(2024, 1, 3, 10))]
    got = one(spark, length_of_stay("t", "a", "b"), rows, "t string, a timestamp_ntz, b timestamp_ntz")
    assert got == [1, None, None]


def test_safe_ratio_half_up_and_zero(spark):
    rows = [(1, 8), (3, 40), (1, 3), (2, 3), (5, 0), (1, 160)]
    got = one(spark, safe_ratio("a", "b"), rows, "a long, b long")
    assert got == [12.5, 7.5, 33.33, 66.67, None, 0.63]


def test_concat_null_propagates(spark):
    got = one(spark, F.concat(F.col("a"), F.lit(" "), F.col("b")), [("x", None), ("x", "y")], "a string, b string")
    assert got == [None, "x y"]


def test_dim_date_calendar(spark):
    d = build_dim_date(spark)           # 2020-01-01 .. 2030-12-31
    assert d.count() == 4018
    r = d.filter(F.col("date_key") == 20240101).first()
    assert (r.day_of_week, r.day_name, r.month_year, r.quarter_name, r.fiscal_period) == \
        (2, "Monday", "January 2024", "Q1 2024", "FY2024-Q1")
    july = build_dim_date(spark, "2024-06-30", "2024-07-01", fiscal_start_month=7).orderBy("date_key").collect()
    assert [(r.fiscal_year, r.fiscal_quarter) for r in july] == [(2023, 4), (2024, 1)]


def test_decimal_overflow_errors(spark):
    import pytest
    df = spark.createDataFrame([(Decimal("9999999999.99"),), (Decimal("9999999999.99"),)], "x decimal(12,2)")
    with pytest.raises(Exception):
        df.agg(F.sum("x").cast("decimal(12,2)")).collect()
