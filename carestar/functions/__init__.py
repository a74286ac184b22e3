from carestar.functions.dates import (add_days, date_key, fiscal_quarter, fiscal_year,
                                     is_weekend, month_label, since, week_of_year_sunday,
                                     years_between)
from carestar.functions.expressions import (age_band, any_null, count_when, length_of_stay,
                                           level_for, safe_ratio, seeded_random, zero_if_missing)

__all__ = ["add_days", "date_key", "fiscal_quarter", "fiscal_year", "is_weekend", "month_label",
           "since", "week_of_year_sunday", "years_between", "age_band", "any_null", "count_when",
           "length_of_stay", "level_for", "safe_ratio", "seeded_random", "zero_if_missing"]
