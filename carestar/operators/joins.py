"""Anti joins. Join strategies are left to the planner: file statistics and adaptive execution decide on
broadcasts from known or measured sizes, so no job runs before a query and nothing unbounded is hinted."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def missing_keys(df: DataFrame, lookup: DataFrame, left_on: str, right_on: str | None = None) -> DataFrame:
    """Rows of ``df`` without a match, null keys included."""
    keys = lookup.select(F.col(right_on or left_on).alias("_mk"))
    return df.join(keys, F.col(left_on) == F.col("_mk"), "left_anti")
