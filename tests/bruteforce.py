"""Reference forms for small fixtures."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def readmission_pairs_bruteforce(index_stays: DataFrame, candidates: DataFrame, days: int = 30) -> DataFrame:
    """The question as a self join with a range condition."""
    i, c = index_stays.alias("i"), candidates.alias("c")
    cond = ((F.col("i.patient") == F.col("c.patient")) & (F.col("c.t") > F.col("i.discharge"))
            & (F.col("c.t") <= F.timestamp_add("DAY", F.lit(days), F.col("i.discharge")))
            & (F.col("c.e2") != F.col("i.e1")))
    return i.join(c, cond, "left").groupBy(F.col("i.grp").alias("grp")).agg(
        F.count_distinct(F.col("i.e1")).alias("index_stays"), F.count_distinct(F.col("c.e2")).alias("readmissions"))
