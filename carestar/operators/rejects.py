"""Q13 / J5 — reject quarantine: typed error rows instead of a failed load.

Every reject is a DataFrame in the error-record shape; a load's rejects are one
``unionByName``. Rows are never collected; they are written with the run.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Reject type names.
INVALID_DOB = "INVALID_DOB"
MISSING_SPECIALTY = "MISSING_SPECIALTY"
MISSING_PATIENT = "MISSING_PATIENT"
MISSING_PROVIDER = "MISSING_PROVIDER"
MISSING_DEPARTMENT = "MISSING_DEPARTMENT"
MISSING_ENCOUNTER_TYPE = "MISSING_ENCOUNTER_TYPE"
ORPHAN_DIAGNOSIS = "ORPHAN_DIAGNOSIS"
MISSING_DIAGNOSIS_KEY = "MISSING_DIAGNOSIS_KEY"
ORPHAN_PROCEDURE = "ORPHAN_PROCEDURE"
MISSING_PROCEDURE_KEY = "MISSING_PROCEDURE_KEY"
MISSING_DATE = "MISSING_DATE"          # optional, off by default

ERROR_COLUMNS = ["source_table", "source_id", "error_type", "error_message", "field_name", "field_value"]


def reject_rows(df: DataFrame, source_table: str, source_id: str, error_type: str,
                message: Column, field_name: str, field_value: Column) -> DataFrame:
    return df.select(F.lit(source_table).alias("source_table"),
                     F.col(source_id).cast("long").alias("source_id"),
                     F.lit(error_type).alias("error_type"),
                     message.alias("error_message"),
                     F.lit(field_name).alias("field_name"),
                     field_value.cast("string").alias("field_value"))


def text(*parts) -> Column:
    """``CONCAT`` of literal text and columns; null in, null out."""
    return F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])


def quarantine(batch_id: str, *rejects: DataFrame) -> DataFrame:
    """One error table for a run: the rejects of every step, stamped with the batch id."""
    out = reduce(lambda a, b: a.unionByName(b), rejects)
    return out.select(F.lit(batch_id).alias("batch_id"), *ERROR_COLUMNS)


def with_error_audit(errors: DataFrame, stamp) -> DataFrame:
    """Add the audit columns of ``etl_error_records`` (unresolved at creation)."""
    return errors.select(
        F.lit(None).cast("long").alias("error_id"), "batch_id",
        F.lit(stamp).cast("timestamp").alias("error_timestamp"), *ERROR_COLUMNS,
        F.lit(False).alias("resolved"), F.lit(None).cast("timestamp").alias("resolved_timestamp"),
        F.lit(None).cast("string").alias("resolved_by"))
