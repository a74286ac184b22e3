"""L6 — a seeded sample of one row, as an aggregate."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sample_one(df: DataFrame, key: str, seed: int) -> DataFrame:
    """The row whose key has the smallest keyed hash: one partially aggregated pass, no sort, the same row for any partitioning.

    Keys are unique; every row is as likely over the seeds. An empty table gives no row.
    """
    draw = F.struct(F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string"))), F.col(key))
    picked = df.agg(F.min_by(F.struct(*[F.col(c) for c in df.columns]), draw).alias("row"))
    return picked.filter(F.col("row").isNotNull()).select("row.*")
