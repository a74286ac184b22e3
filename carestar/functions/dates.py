"""Calendar scalar helpers (MySQL date functions re-expressed as Spark columns)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def date_key(c) -> Column:
    """``CAST(DATE_FORMAT(d, '%Y%m%d') AS UNSIGNED)`` as an int key (arithmetic, no strings)."""
    d = F.to_date(_c(c))
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def week_of_year_sunday(c) -> Column:
    """``WEEK(d)`` mode 0: weeks start on Sunday, 0-53 (not ISO ``weekofyear``)."""
    d = F.to_date(_c(c))
    return F.floor((F.dayofyear(d) + 7 - F.dayofweek(d)) / 7).cast("int")


def is_weekend(c) -> Column:
    """``DAYOFWEEK(d) IN (1, 7)`` — 1 is Sunday, 7 is Saturday."""
    return F.dayofweek(_c(c)).isin(1, 7)


def month_label(c) -> Column:
    """``DATE_FORMAT(ts, '%Y-%m')``."""
    return F.date_format(_c(c), "yyyy-MM")


def fiscal_year(c, start_month: int = 1) -> Column:
    """Calendar year by default; with ``start_month=7`` months >= 7 belong to the year, else year-1."""
    d = _c(c)
    if start_month == 1:
        return F.year(d)
    return F.when(F.month(d) >= start_month, F.year(d)).otherwise(F.year(d) - 1)


def fiscal_quarter(c, start_month: int = 1) -> Column:
    d = _c(c)
    if start_month == 1:
        return F.quarter(d)
    shifted = (F.month(d) - start_month + 12) % 12
    return (F.floor(shifted / 3) + 1).cast("int")


def since(c, ts: str) -> Column:
    """``col >= 'literal'`` with the literal cast to the column's timestamp kind."""
    return _c(c) >= F.lit(ts).cast("timestamp_ntz")


def add_days(c, days: int) -> Column:
    """``DATE_ADD(ts, INTERVAL n DAY)`` keeping the time of day."""
    return F.timestamp_add("DAY", F.lit(days), _c(c))


def years_between(dob, as_of) -> Column:
    """``TIMESTAMPDIFF(YEAR, dob, as_of)``: whole years, a Feb-29 birthday completes on Mar 1."""
    return F.timestamp_diff("YEAR", F.to_timestamp(_c(dob)), F.to_timestamp(_c(as_of)))
