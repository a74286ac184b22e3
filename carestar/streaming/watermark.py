"""A9 — the high-water mark of fact loading.

The workload is a nightly full refresh with no stream; the only incremental hook
is ``last_successful_encounter_id``, which every fact batch records in batch
control. This module reads it back from the audit tables (the reference records
it but never reads it).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def recorded_high_water_marks(control: DataFrame) -> DataFrame:
    """Per batch: the last successful encounter id recorded by its fact load."""
    return control.select("batch_id", "start_timestamp", "status", "last_successful_encounter_id")


def latest_high_water_mark(control: DataFrame, statuses=("COMPLETED", "COMPLETED_WITH_WARNINGS")) -> DataFrame:
    """The mark of the newest batch that finished with one of ``statuses`` (one row at most)."""
    ok = control.filter(F.col("status").isin(*statuses) & F.col("last_successful_encounter_id").isNotNull())
    newest = F.struct("start_timestamp", "batch_id")
    return ok.agg(F.max_by("batch_id", newest).alias("batch_id"),
                  F.max_by("last_successful_encounter_id", newest).alias("last_successful_encounter_id")) \
        .filter(F.col("batch_id").isNotNull())
