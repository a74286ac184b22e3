"""N5 — OLTP vs star comparison report from recorded timings.

Timings are rows of a stored table: run, question, model, milliseconds. Per
question the report has both times in ms, the speed-up = OLTP / star (null when
the star time is 0) and the time saved; plus the mean of the speed-ups and the
ratio of the totals (the two summary numbers the reference reports side by side).
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TIMINGS = "run_id string, question string, model string, ms double, measured_at timestamp"


def record_timings(spark: SparkSession, path: str, timings: dict[str, float], run_id: str | None = None) -> str:
    """Append a run's measured seconds (keyed ``q1_oltp``, ``q1_star``, ...) to the table at ``path``; returns the run's id."""
    run_id, now = run_id or uuid.uuid4().hex, dt.datetime.now(dt.timezone.utc)
    rows = [(run_id, *name.rsplit("_", 1), seconds * 1000.0, now) for name, seconds in timings.items() if name.endswith(("_oltp", "_star"))]
    spark.createDataFrame(rows, TIMINGS).coalesce(1).write.mode("append").parquet(path)
    return run_id


def read_timings(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(TIMINGS).parquet(path)


def latest_timings(timings: DataFrame) -> DataFrame:
    """Of each question and model the time measured last."""
    newest = F.max_by("ms", F.struct("measured_at", "run_id"))
    return timings.groupBy("question", "model").agg(newest.alias("ms"))


def compare(timings: DataFrame) -> DataFrame:
    """The report on recorded timings; the newest measurement of each question and model counts."""
    time_of = lambda model: F.coalesce(F.max(F.when(F.col("model") == model, F.col("ms"))), F.lit(0.0))
    both = latest_timings(timings).groupBy("question").agg(time_of("oltp").alias("oltp_ms"), time_of("star").alias("star_ms"))
    per = both.select("question", F.round("oltp_ms", 2).alias("oltp_ms"), F.round("star_ms", 2).alias("star_ms"),
                      F.round(F.col("oltp_ms") / F.nullif(F.col("star_ms"), F.lit(0.0)), 2).alias("speedup"),
                      F.round(F.col("oltp_ms") - F.col("star_ms"), 2).alias("saved_ms"))
    total = per.agg(F.lit("TOTAL").alias("question"), F.round(F.sum("oltp_ms"), 2).alias("oltp_ms"),
                    F.round(F.sum("star_ms"), 2).alias("star_ms"),
                    F.round(F.sum("oltp_ms") / F.nullif(F.sum("star_ms"), F.lit(0.0)), 2).alias("speedup"),
                    F.round(F.sum("saved_ms"), 2).alias("saved_ms"))
    mean = per.agg(F.lit("MEAN_OF_RATIOS").alias("question"), F.lit(None).cast("double").alias("oltp_ms"),
                   F.lit(None).cast("double").alias("star_ms"), F.round(F.avg("speedup"), 2).alias("speedup"),
                   F.lit(None).cast("double").alias("saved_ms"))
    return per.unionByName(total).unionByName(mean)
