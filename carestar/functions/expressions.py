"""Column-expression helpers: bands, conditional measures, null handling, ratios."""

from __future__ import annotations

import operator
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from carestar.functions.dates import years_between

# Age bands as (upper bound exclusive, label), then the open band.
AGE_BANDS = [(18, "0-17"), (35, "18-34"), (50, "35-49"), (65, "50-64")]
AGE_BAND_LAST = "65+"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def age_band(dob, as_of) -> Column:
    """Searched CASE over whole years of age at ``as_of``."""
    age = years_between(dob, as_of)
    expr = None
    for upper, label in AGE_BANDS:
        expr = F.when(age < upper, label) if expr is None else expr.when(age < upper, label)
    return expr.otherwise(AGE_BAND_LAST)


def length_of_stay(enc_type, admit, discharge, inpatient: str = "Inpatient") -> Column:
    """Calendar days between admission and discharge, only for inpatient stays with a discharge."""
    return F.when((_c(enc_type) == inpatient) & _c(discharge).isNotNull(),
                  F.datediff(F.to_date(_c(discharge)), F.to_date(_c(admit))))


def zero_if_missing(c, zero=0) -> Column:
    """``COALESCE(x, 0)`` after an outer join."""
    return F.coalesce(_c(c), F.lit(zero))


def any_null(cols) -> Column:
    """True when any of the columns is null."""
    return reduce(operator.or_, [_c(c).isNull() for c in cols])


def count_when(cond: Column) -> Column:
    """``COUNT(CASE WHEN cond THEN 1 END)``."""
    return F.count(F.when(cond, 1))


def safe_ratio(num, den, digits: int = 2, scale: int = 100) -> Column:
    """``ROUND(100.0 * n / NULLIF(d, 0), 2)`` for non-negative counts, as a double.

    Rounded HALF_UP on the exact rational value (integer arithmetic), so the
    result does not depend on how floating point represents x.xx5; null when the
    denominator is 0.
    """
    m = 10 ** digits
    n, d = _c(num).cast("long"), F.nullif(_c(den).cast("long"), F.lit(0))
    steps = F.floor((F.lit(2 * scale * m) * n + d) / (F.lit(2) * d))
    return steps.cast("double") / F.lit(float(m))


def level_for(failed: Column, bad: str = "WARNING", good: str = "INFO") -> Column:
    """``CASE WHEN failed THEN 'WARNING' ELSE 'INFO' END``."""
    return F.when(failed, F.lit(bad)).otherwise(F.lit(good))


def seeded_random(seed: int, key) -> Column:
    """``RAND(seed)`` by row: a number in [0, 1) that depends on the seed and the row's key alone, with 6 digits."""
    drawn = F.conv(F.left(F.md5(F.concat(F.lit(f"{seed}:"), _c(key).cast("string"))), F.lit(8)), 16, 10).cast("long")
    return F.floor(drawn * 1_000_000 / (1 << 32)).cast("double") / F.lit(1e6)
