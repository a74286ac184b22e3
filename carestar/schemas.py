"""Declared table schemas (OLTP source, star target, audit).

Natural and surrogate keys are ``long``; MySQL ``DATETIME`` has no zone, so
encounter timestamps are ``timestamp_ntz``; money is ``decimal(12,2)``.
"""

from __future__ import annotations

from pyspark.sql import types as T

L, I, S, D, B = T.LongType(), T.IntegerType(), T.StringType(), T.DateType(), T.BooleanType()
TS = T.TimestampNTZType()
TSL = T.TimestampType()
MONEY = T.DecimalType(12, 2)


def _s(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


# ---- OLTP source -----------------------------------------------------------
PATIENTS = _s(("patient_id", L, False), ("first_name", S, True), ("last_name", S, True),
              ("date_of_birth", D, True), ("gender", S, True), ("mrn", S, True))
SPECIALTIES = _s(("specialty_id", L, False), ("specialty_name", S, True), ("specialty_code", S, True))
DEPARTMENTS = _s(("department_id", L, False), ("department_name", S, True),
                 ("floor", I, True), ("capacity", I, True))
PROVIDERS = _s(("provider_id", L, False), ("first_name", S, True), ("last_name", S, True),
               ("credential", S, True), ("specialty_id", L, True), ("department_id", L, True))
ENCOUNTERS = _s(("encounter_id", L, False), ("patient_id", L, True), ("provider_id", L, True),
                ("encounter_type", S, True), ("encounter_date", TS, True),
                ("discharge_date", TS, True), ("department_id", L, True))
DIAGNOSES = _s(("diagnosis_id", L, False), ("icd10_code", S, True), ("icd10_description", S, True))
ENCOUNTER_DIAGNOSES = _s(("encounter_diagnosis_id", L, False), ("encounter_id", L, True),
                         ("diagnosis_id", L, True), ("diagnosis_sequence", I, True))
PROCEDURES = _s(("procedure_id", L, False), ("cpt_code", S, True), ("cpt_description", S, True))
ENCOUNTER_PROCEDURES = _s(("encounter_procedure_id", L, False), ("encounter_id", L, True),
                          ("procedure_id", L, True), ("procedure_date", D, True))
BILLING = _s(("billing_id", L, False), ("encounter_id", L, True), ("claim_amount", MONEY, True),
             ("allowed_amount", MONEY, True), ("claim_date", D, True), ("claim_status", S, True))

OLTP = {
    "patients": PATIENTS, "specialties": SPECIALTIES, "departments": DEPARTMENTS,
    "providers": PROVIDERS, "encounters": ENCOUNTERS, "diagnoses": DIAGNOSES,
    "encounter_diagnoses": ENCOUNTER_DIAGNOSES, "procedures": PROCEDURES,
    "encounter_procedures": ENCOUNTER_PROCEDURES, "billing": BILLING,
}
# Primary keys of the OLTP tables (declared constraints, checked by quality.check_unique).
OLTP_KEYS = {
    "patients": "patient_id", "specialties": "specialty_id", "departments": "department_id",
    "providers": "provider_id", "encounters": "encounter_id", "diagnoses": "diagnosis_id",
    "encounter_diagnoses": "encounter_diagnosis_id", "procedures": "procedure_id",
    "encounter_procedures": "encounter_procedure_id", "billing": "billing_id",
}
# Transactional tables (emptied by a source reset); the rest are reference tables.
TRANSACTIONAL = ["encounters", "encounter_diagnoses", "encounter_procedures", "billing"]

# ---- star target -----------------------------------------------------------
DIM_DATE = _s(("date_key", I, False), ("calendar_date", D, False), ("year", I, False),
              ("quarter", I, False), ("quarter_name", S, False), ("month", I, False),
              ("month_name", S, False), ("month_year", S, False), ("day_of_month", I, False),
              ("day_of_week", I, False), ("day_name", S, False), ("week_of_year", I, False),
              ("is_weekend", B, False), ("is_holiday", B, False), ("fiscal_year", I, False),
              ("fiscal_quarter", I, False), ("fiscal_period", S, False))
DIM_PATIENT = _s(("patient_key", L, False), ("patient_id", L, False), ("mrn", S, True),
                 ("first_name", S, True), ("last_name", S, True), ("full_name", S, True),
                 ("date_of_birth", D, True), ("gender", S, True), ("age_group", S, True),
                 ("source_system", S, True), ("effective_date", D, True), ("is_current", B, True))
DIM_SPECIALTY = _s(("specialty_key", L, False), ("specialty_id", L, False),
                   ("specialty_name", S, True), ("specialty_code", S, True))
DIM_PROVIDER = _s(("provider_key", L, False), ("provider_id", L, False), ("first_name", S, True),
                  ("last_name", S, True), ("full_name", S, True), ("credential", S, True),
                  ("specialty_id", L, True), ("specialty_name", S, True), ("specialty_code", S, True))
DIM_DEPARTMENT = _s(("department_key", L, False), ("department_id", L, False),
                    ("department_name", S, True), ("floor", I, True), ("capacity", I, True))
DIM_ENCOUNTER_TYPE = _s(("encounter_type_key", L, False), ("encounter_type_name", S, False),
                        ("encounter_type_code", S, False), ("requires_admission", B, True),
                        ("average_duration_hours", T.DecimalType(5, 2), True))
DIM_DIAGNOSIS = _s(("diagnosis_key", L, False), ("diagnosis_id", L, False),
                   ("icd10_code", S, True), ("icd10_description", S, True))
DIM_PROCEDURE = _s(("procedure_key", L, False), ("procedure_id", L, False), ("cpt_code", S, True),
                   ("cpt_description", S, True), ("procedure_category", S, True),
                   ("average_duration_minutes", I, True))
FACT_ENCOUNTERS = _s(("encounter_key", L, False), ("encounter_id", L, False), ("date_key", I, False),
                     ("patient_key", L, False), ("provider_key", L, False), ("specialty_key", L, False),
                     ("department_key", L, False), ("encounter_type_key", L, False),
                     ("encounter_date", TS, True), ("discharge_date", TS, True),
                     ("diagnosis_count", I, False), ("procedure_count", I, False),
                     ("total_claim_amount", MONEY, False), ("total_allowed_amount", MONEY, False),
                     ("length_of_stay_days", I, True), ("etl_loaded_date", TS, True))
BRIDGE_DIAGNOSES = _s(("encounter_key", L, False), ("diagnosis_key", L, False),
                      ("diagnosis_sequence", I, True))
BRIDGE_PROCEDURES = _s(("encounter_key", L, False), ("procedure_key", L, False),
                       ("procedure_date", D, True), ("procedure_sequence", I, False))

STAR = {
    "dim_date": DIM_DATE, "dim_patient": DIM_PATIENT, "dim_specialty": DIM_SPECIALTY,
    "dim_provider": DIM_PROVIDER, "dim_department": DIM_DEPARTMENT,
    "dim_encounter_type": DIM_ENCOUNTER_TYPE, "dim_diagnosis": DIM_DIAGNOSIS,
    "dim_procedure": DIM_PROCEDURE, "fact_encounters": FACT_ENCOUNTERS,
    "bridge_encounter_diagnoses": BRIDGE_DIAGNOSES, "bridge_encounter_procedures": BRIDGE_PROCEDURES,
}
# Declared constraints (fixed values): unique keys, NOT NULL columns and foreign keys of both models.
UNIQUE = [(t, (k,)) for t, k in OLTP_KEYS.items()] + [
    ("dim_date", ("date_key",)), ("dim_date", ("calendar_date",)),
    ("dim_patient", ("patient_key",)), ("dim_patient", ("patient_id",)), ("dim_patient", ("mrn",)),
    ("dim_specialty", ("specialty_key",)), ("dim_specialty", ("specialty_id",)),
    ("dim_provider", ("provider_key",)), ("dim_provider", ("provider_id",)),
    ("dim_department", ("department_key",)), ("dim_department", ("department_id",)),
    ("dim_encounter_type", ("encounter_type_key",)), ("dim_encounter_type", ("encounter_type_name",)),
    ("dim_diagnosis", ("diagnosis_key",)), ("dim_diagnosis", ("diagnosis_id",)),
    ("dim_procedure", ("procedure_key",)), ("dim_procedure", ("procedure_id",)),
    ("fact_encounters", ("encounter_key",)), ("fact_encounters", ("encounter_id",)),
    ("bridge_encounter_diagnoses", ("encounter_key", "diagnosis_key", "diagnosis_sequence")),
    ("bridge_encounter_procedures", ("encounter_key", "procedure_key", "procedure_sequence")),
]
_MORE_NOT_NULL = {
    "dim_patient": ["mrn", "date_of_birth"], "dim_specialty": ["specialty_name", "specialty_code"],
    "dim_provider": ["specialty_id", "specialty_name", "specialty_code"], "dim_department": ["department_name"],
    "dim_diagnosis": ["icd10_code", "icd10_description"], "dim_procedure": ["cpt_code", "cpt_description"],
    "fact_encounters": ["encounter_date"], "bridge_encounter_diagnoses": ["diagnosis_sequence"],
    "bridge_encounter_procedures": ["procedure_date"],
}
NOT_NULL = {t: [f.name for f in schema.fields if not f.nullable or f.name in _MORE_NOT_NULL.get(t, [])]
            for t, schema in (OLTP | STAR).items()}
FOREIGN_KEYS = [      # child table, column, parent table (same column name on both sides)
    ("providers", "specialty_id", "specialties"), ("providers", "department_id", "departments"),
    ("encounters", "patient_id", "patients"), ("encounters", "provider_id", "providers"),
    ("encounters", "department_id", "departments"),
    ("encounter_diagnoses", "encounter_id", "encounters"), ("encounter_diagnoses", "diagnosis_id", "diagnoses"),
    ("encounter_procedures", "encounter_id", "encounters"), ("encounter_procedures", "procedure_id", "procedures"),
    ("billing", "encounter_id", "encounters"),
    ("fact_encounters", "date_key", "dim_date"), ("fact_encounters", "patient_key", "dim_patient"),
    ("fact_encounters", "provider_key", "dim_provider"), ("fact_encounters", "specialty_key", "dim_specialty"),
    ("fact_encounters", "department_key", "dim_department"),
    ("fact_encounters", "encounter_type_key", "dim_encounter_type"),
    ("bridge_encounter_diagnoses", "encounter_key", "fact_encounters"),
    ("bridge_encounter_diagnoses", "diagnosis_key", "dim_diagnosis"),
    ("bridge_encounter_procedures", "encounter_key", "fact_encounters"),
    ("bridge_encounter_procedures", "procedure_key", "dim_procedure"),
]

# ---- audit -----------------------------------------------------------------
ETL_LOG = _s(("log_id", L, False), ("batch_id", S, False), ("log_timestamp", TSL, True),
             ("log_level", S, True), ("step_name", S, True), ("message", S, True),
             ("rows_affected", L, True), ("rows_expected", L, True),
             ("execution_time_seconds", T.DecimalType(10, 2), True))
ERROR_RECORDS = _s(("error_id", L, True), ("batch_id", S, False), ("error_timestamp", TSL, True),
                   ("source_table", S, True), ("source_id", L, True), ("error_type", S, True),
                   ("error_message", S, True), ("field_name", S, True), ("field_value", S, True),
                   ("resolved", B, True), ("resolved_timestamp", TSL, True), ("resolved_by", S, True))
BATCH_CONTROL = _s(("batch_id", S, False), ("batch_type", S, True), ("start_timestamp", TSL, True),
                   ("end_timestamp", TSL, True), ("status", S, True),
                   ("total_rows_processed", L, True), ("total_errors", L, True),
                   ("last_successful_encounter_id", L, True), ("notes", S, True))
CHECKS = _s(("batch_id", S, False), ("check_name", S, False), ("log_level", S, True), ("result", S, True),
            ("oltp", L, True), ("star", L, True))
