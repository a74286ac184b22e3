"""P3-P9 — dimension loads (type-1 overwrite: ``is_current`` true, ``effective_date`` = as_of)."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carestar import schemas
from carestar.functions.expressions import age_band
from carestar.operators import rejects as R
from carestar.operators.joins import missing_keys
from carestar.operators.keys import with_surrogate_key
from carestar.sources.readers import literal_rows

# The static encounter-type code table (name, code, admission, hours).
ENCOUNTER_TYPES = [
    ("Outpatient", "OP", False, Decimal("1.5")),
    ("Inpatient", "IP", True, Decimal("96.0")),
    ("ER", "ER", False, Decimal("6.5")),
]
SOURCE_SYSTEM = "OLTP"


def build_dim_specialty(specialties: DataFrame) -> DataFrame:
    return with_surrogate_key(specialties.select("specialty_id", "specialty_name", "specialty_code"),
                              "specialty_id", "specialty_key")


def build_dim_department(departments: DataFrame) -> DataFrame:
    return with_surrogate_key(departments.select("department_id", "department_name", "floor", "capacity"),
                              "department_id", "department_key")


def build_dim_encounter_type(spark: SparkSession) -> DataFrame:
    rows = [(i + 1, *r) for i, r in enumerate(ENCOUNTER_TYPES)]
    return literal_rows(spark, rows, schemas.DIM_ENCOUNTER_TYPE)


def build_dim_diagnosis(diagnoses: DataFrame) -> DataFrame:
    return with_surrogate_key(diagnoses.select("diagnosis_id", "icd10_code", "icd10_description"),
                              "diagnosis_id", "diagnosis_key")


def build_dim_procedure(procedures: DataFrame) -> DataFrame:
    # category and duration are declared but never loaded
    base = procedures.select("procedure_id", "cpt_code", "cpt_description",
                             F.lit(None).cast("string").alias("procedure_category"),
                             F.lit(None).cast("int").alias("average_duration_minutes"))
    return with_surrogate_key(base, "procedure_id", "procedure_key")


def valid_birth_date(as_of: str):
    dob = F.col("date_of_birth")
    return dob.isNotNull() & (dob <= F.lit(as_of).cast("date"))


def patient_rejects(patients: DataFrame, as_of: str) -> DataFrame:
    """E4 reject half: null or future birth date."""
    bad = patients.filter(~valid_birth_date(as_of))
    return R.reject_rows(bad, "patients", "patient_id", R.INVALID_DOB, F.lit("NULL or future DOB"),
                         "date_of_birth", F.col("date_of_birth"))


def build_dim_patient(patients: DataFrame, as_of: str) -> DataFrame:
    """E4 accept half + full name, age band and type-1 constants."""
    ok = patients.filter(valid_birth_date(as_of))
    base = ok.select(
        "patient_id", "mrn", "first_name", "last_name",
        F.concat(F.col("first_name"), F.lit(" "), F.col("last_name")).alias("full_name"),
        "date_of_birth", "gender",
        age_band("date_of_birth", F.lit(as_of).cast("date")).alias("age_group"),
        F.lit(SOURCE_SYSTEM).alias("source_system"),
        F.lit(as_of).cast("date").alias("effective_date"),
        F.lit(True).alias("is_current"))
    return with_surrogate_key(base, "patient_id", "patient_key")


def provider_rejects(providers: DataFrame, specialties: DataFrame) -> DataFrame:
    bad = missing_keys(providers, specialties, "specialty_id")
    return R.reject_rows(bad, "providers", "provider_id", R.MISSING_SPECIALTY,
                         F.lit("Specialty not found"), "specialty_id", F.col("specialty_id"))


def build_dim_provider(providers: DataFrame, specialties: DataFrame) -> DataFrame:
    """Denormalise the specialty into the provider (inner join)."""
    spec = specialties.select("specialty_id", "specialty_name", "specialty_code")
    base = providers.join(spec, "specialty_id").select(
        "provider_id", "first_name", "last_name",
        F.concat(F.lit("Dr. "), F.col("first_name"), F.lit(" "), F.col("last_name")).alias("full_name"),
        "credential", "specialty_id", "specialty_name", "specialty_code")
    return with_surrogate_key(base, "provider_id", "provider_key")
