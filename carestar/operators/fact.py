"""J3 / J4 / P10 — key resolution, validation rejects, and the encounter fact.

One pass resolves every dimension key with left joins; the rejects are the rows
with a missing key and the fact is the rows with all keys, so the big encounter
table is scanned and shuffled once for both. The patient lookup grows with the
data, so it is joined by a shuffle, and AQE splits a patient that owns a large
share of the encounters. Encounter keys are numbered on the narrow list of ids
and joined to the measures, which are shuffled by ``encounter_id`` anyway.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carestar.functions.dates import date_key
from carestar.functions.expressions import length_of_stay, zero_if_missing
from carestar.operators import rejects as R
from carestar.operators.keys import number_keys

KEYS = ["patient_key", "provider_key", "specialty_key", "department_key", "encounter_type_key"]


def resolve_encounters(encounters: DataFrame, patient_lu: DataFrame, provider_lu: DataFrame,
                       department_lu: DataFrame, encounter_type_lu: DataFrame,
                       fold_case: bool = False) -> DataFrame:
    """Left-join every lookup. ``fold_case`` matches type names case-insensitively, as
    MySQL's default collation does (T12); by default the comparison is binary."""
    a, b = encounters.encounter_type, encounter_type_lu.encounter_type_name
    type_match = F.lower(a) == F.lower(b) if fold_case else a == b
    return (encounters
            .join(provider_lu, "provider_id", "left")
            .join(department_lu, "department_id", "left")
            .join(encounter_type_lu, type_match, "left")
            .drop("encounter_type_name")
            .join(patient_lu, "patient_id", "left"))


def encounter_rejects(resolved: DataFrame) -> DataFrame:
    """MISSING_PATIENT / _PROVIDER / _DEPARTMENT / _ENCOUNTER_TYPE; one row per missing key."""
    checks = [
        ("patient_key", R.MISSING_PATIENT, R.text("Patient ", F.col("patient_id"), " not found"), "patient_id"),
        ("provider_key", R.MISSING_PROVIDER, R.text("Provider ", F.col("provider_id"), " not found"), "provider_id"),
        ("department_key", R.MISSING_DEPARTMENT, R.text("Department ", F.col("department_id"), " not found"),
         "department_id"),
        ("encounter_type_key", R.MISSING_ENCOUNTER_TYPE,
         R.text('Type "', F.col("encounter_type"), '" not found'), "encounter_type"),
    ]
    parts = [R.reject_rows(resolved.filter(F.col(key).isNull()), "encounters", "encounter_id", etype, msg,
                           field, F.col(field)) for key, etype, msg, field in checks]
    return reduce(lambda a, b: a.unionByName(b), parts)


def loadable(resolved: DataFrame) -> DataFrame:
    cond = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in KEYS])
    return resolved.filter(cond)


def expected_fact_rows(resolved: DataFrame) -> DataFrame:
    """Rows that pass the four inner lookups (the load's expectation)."""
    return loadable(resolved).agg(F.count(F.lit(1)).alias("expected_rows"))


def build_fact(resolved: DataFrame, measures: DataFrame, loaded_at: str,
               dim_date: DataFrame | None = None) -> DataFrame:
    """P10: date key, five keys, two counts, two totals, length of stay, load stamp.

    ``dim_date`` given: rows whose date is outside the calendar are left out (the
    optional ``MISSING_DATE`` check); by default they load, as in the reference.
    """
    rows = loadable(resolved).withColumn("date_key", date_key("encounter_date"))
    if dim_date is not None:
        rows = rows.join(dim_date.select("date_key"), "date_key", "left_semi")
    return fact_rows(rows, number_keys(rows.select("encounter_id"), "encounter_id", "encounter_key"), measures, loaded_at)


def fact_rows(rows: DataFrame, keys: DataFrame, measures: DataFrame, loaded_at: str) -> DataFrame:
    """Fact rows of loadable encounters, given their numbered keys."""
    dated = rows.withColumn("date_key", date_key("encounter_date"))
    # both grow with the encounters: never broadcast through the driver
    return dated.join(keys.hint("merge"), "encounter_id").join(measures.hint("merge"), "encounter_id", "left").select(
        "encounter_key", "encounter_id", "date_key", *KEYS, "encounter_date", "discharge_date",
        zero_if_missing("diagnosis_count").cast("int").alias("diagnosis_count"),
        zero_if_missing("procedure_count").cast("int").alias("procedure_count"),
        zero_if_missing("total_claim").cast("decimal(12,2)").alias("total_claim_amount"),
        zero_if_missing("total_allowed").cast("decimal(12,2)").alias("total_allowed_amount"),
        length_of_stay("encounter_type", "encounter_date", "discharge_date").cast("int").alias("length_of_stay_days"),
        F.lit(loaded_at).cast("timestamp_ntz").alias("etl_loaded_date"))   # DATETIME: no zone


def by_year(fact: DataFrame) -> DataFrame:
    """The fact as it is written, partitioned by ``date_year``: clustered by date, so that each file holds a
    contiguous span of days and date filters skip files; AQE sizes the number of files."""
    return fact.withColumn("date_year", (F.col("date_key") / 10000).cast("int")).repartitionByRange("date_key", "encounter_id")


def missing_date_rejects(resolved: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Optional MISSING_DATE: loadable encounters whose date has no calendar row."""
    rows = loadable(resolved).withColumn("date_key", date_key("encounter_date"))
    bad = rows.join(dim_date.select("date_key"), "date_key", "left_anti")
    return R.reject_rows(bad, "encounters", "encounter_id", R.MISSING_DATE,
                         R.text("Date ", F.col("date_key"), " not in dim_date"), "date_key", F.col("date_key"))


def outside_calendar(resolved: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Loadable encounters whose date has no calendar row: date-joined reports leave them out."""
    rows = loadable(resolved).select("encounter_id", date_key("encounter_date").alias("date_key"))
    return rows.join(dim_date.select("date_key"), "date_key", "left_anti").agg(F.count(F.lit(1)).alias("outside_calendar"))
