"""Hand-made OLTP frames (a few rows each) through the star build and the questions."""

import datetime as dt
from decimal import Decimal

import pytest

from carestar import schemas as S
from carestar.plans import questions as Q
from carestar.plans.star import Params, StarBuild

T = dt.datetime


@pytest.fixture(scope="module")
def build(spark):
    c = spark.createDataFrame
    oltp = {
        "patients": c([(1, "Ann", "Lee", dt.date(1990, 5, 1), "F", "M1"),
                       (2, "Bob", None, dt.date(2000, 2, 29), "M", "M2"),
                       (3, "Cy", "Ode", None, "M", "M3"),                       # INVALID_DOB
                       (4, "Di", "Pax", dt.date(2999, 1, 1), "F", "M4")], S.PATIENTS),  # INVALID_DOB
        "specialties": c([(10, "Cardio", "S10"), (11, "Neuro", "S11")], S.SPECIALTIES),
        "departments": c([(1, "North", 1, 10)], S.DEPARTMENTS),
        "providers": c([(100, "A", "B", "MD", 10, 1), (101, "C", "D", "RN", 11, 1),
                        (102, "E", "F", "PA", 99, 1)], S.PROVIDERS),            # MISSING_SPECIALTY
        "encounters": c([
            (1000, 1, 100, "Inpatient", T(2024, 1, 1, 8), T(2024, 1, 3, 8), 1),
            (1001, 1, 101, "Inpatient", T(2024, 1, 20, 8), T(2024, 1, 21, 8), 1),
            (1002, 3, 102, "Telehealth", T(2024, 1, 5, 8), None, 1),            # 3 missing keys -> 3 rows
            (1003, 2, 100, "Outpatient", T(2024, 2, 1, 9), T(2024, 2, 1, 10), 7),  # MISSING_DEPARTMENT
            (1004, 2, 100, "ER", T(2024, 2, 2, 9), None, 1)], S.ENCOUNTERS),
        "diagnoses": c([(1, "I10", "Hypertension"), (2, "I10", "Hypertension"), (3, "E11", "Diabetes")],
                       S.DIAGNOSES),                                            # ids 1, 2 share code+text
        "encounter_diagnoses": c([(1, 1000, 1, 1), (2, 1000, 1, 2), (3, 1000, 3, 3), (4, 1001, 2, 1),
                                  (5, 1002, 1, 1), (6, 1004, 9, 1)], S.ENCOUNTER_DIAGNOSES),
        "procedures": c([(1, "93000", "ECG"), (2, "80053", "Panel")], S.PROCEDURES),
        "encounter_procedures": c([(1, 1000, 2, dt.date(2024, 1, 2)), (2, 1000, 1, dt.date(2024, 1, 1)),
                                   (3, 1001, 1, dt.date(2024, 1, 20)), (4, 1004, 5, dt.date(2024, 2, 2))],
                                  S.ENCOUNTER_PROCEDURES),
        "billing": c([(1, 1000, Decimal("100.00"), Decimal("80.00"), dt.date(2024, 1, 5), "Paid"),
                      (2, 1000, Decimal("50.00"), Decimal("40.01"), dt.date(2024, 1, 6), "Pending"),
                      (3, 1004, Decimal("10.00"), Decimal("9.00"), dt.date(2024, 2, 3), "Paid")], S.BILLING),
    }
    return StarBuild(spark, oltp, Params(since="2024-01-01"))


def test_rejects_and_cascade(build):
    errs = sorted((r.source_table, r.source_id, r.error_type) for r in build.errors.collect())
    assert ("patients", 3, "INVALID_DOB") in errs and ("patients", 4, "INVALID_DOB") in errs
    assert ("providers", 102, "MISSING_SPECIALTY") in errs
    # 1002: patient rejected (cascade), provider without specialty, unknown type -> three rows
    assert [e for e in errs if e[1] == 1002] == [
        ("encounters", 1002, "MISSING_ENCOUNTER_TYPE"), ("encounters", 1002, "MISSING_PATIENT"),
        ("encounters", 1002, "MISSING_PROVIDER")]
    assert ("encounters", 1003, "MISSING_DEPARTMENT") in errs
    assert ("encounter_diagnoses", 5, "ORPHAN_DIAGNOSIS") in errs          # its encounter did not load
    assert ("encounter_diagnoses", 6, "MISSING_DIAGNOSIS_KEY") in errs
    assert ("encounter_procedures", 4, "MISSING_PROCEDURE_KEY") in errs


def test_fact_rows(build):
    f = {r.encounter_id: r for r in build.fact.collect()}
    assert sorted(f) == [1000, 1001, 1004]
    assert [f[i].encounter_key for i in (1000, 1001, 1004)] == [1, 2, 3]
    r = f[1000]
    assert (r.diagnosis_count, r.procedure_count, r.total_claim_amount, r.total_allowed_amount,
            r.length_of_stay_days, r.date_key) == (3, 2, Decimal("150.00"), Decimal("120.01"), 2, 20240101)
    assert (f[1001].total_claim_amount, f[1004].length_of_stay_days) == (Decimal("0.00"), None)


def test_procedure_sequence(build):
    seq = {(r.encounter_key, r.procedure_date): r.procedure_sequence for r in build.bridge_procedures.collect()}
    assert seq[(1, dt.date(2024, 1, 1))] == 1 and seq[(1, dt.date(2024, 1, 2))] == 2


def test_dim_patient_names_and_age(build):
    p = {r.patient_id: r for r in build.dim_patient.collect()}
    assert sorted(p) == [1, 2]
    assert p[2].full_name is None and p[2].age_group == "18-34"     # null in CONCAT; 24 on 2025-01-01


def test_q2_forms_differ(build):
    star = build.tables()
    o = {(r.icd10_code, r.cpt_code): r.combination_count for r in Q.q2_oltp(build.oltp).collect()}
    s = {(r.icd10_code, r.cpt_code): r.encounter_count for r in Q.q2_star(star).collect()}
    # encounter 1000 has I10 twice (ids 1 and 1, plus id 2 merged by code+text) -> row pairs count both
    assert o[("I10", "93000")] == 3 and s[("I10", "93000")] == 2


def test_q4_paid_vs_all(build):
    o = Q.q4_oltp(build.oltp, "2024-01-01").collect()
    jan = [r for r in o if r.month == "2024-01" and r.specialty_name == "Cardio"][0]
    assert (jan.total_claims, jan.total_revenue) == (1, Decimal("80.00"))      # paid claims only
    s = Q.q4_star(build.tables(), 2024).collect()
    sj = [r for r in s if r.month_year == "January 2024" and r.specialty_name == "Cardio"][0]
    assert sj.total_revenue == Decimal("120.01")                               # all claims


def test_q3_star_counts(build):
    rows = {r.specialty_name: r for r in Q.q3_star(build.tables(), 2024, min_discharges=1).collect()}
    assert rows["Cardio"].readmissions_within_30_days == 1      # 1001 is 17 days after 1000's discharge


def test_options_fold_case_and_missing_date(spark, build):
    import dataclasses
    o = dict(build.oltp)
    o["encounters"] = spark.createDataFrame([
        (2000, 1, 100, "inpatient", T(2024, 3, 1, 8), T(2024, 3, 2, 8), 1),      # lower-case type
        (2001, 1, 100, "Outpatient", T(2040, 1, 1, 8), T(2040, 1, 1, 9), 1)],    # outside the calendar
        S.ENCOUNTERS)
    strict = StarBuild(spark, o, Params(since="2024-01-01"))
    assert sorted(r.encounter_id for r in strict.fact.collect()) == [2001]           # binary compare (default)
    folded = StarBuild(spark, o, dataclasses.replace(Params(since="2024-01-01"), fold_case=True, check_dates=True))
    assert sorted(r.encounter_id for r in folded.fact.collect()) == [2000]
    errs = {(r.source_id, r.error_type) for r in folded.errors.collect() if r.source_table == "encounters"}
    assert errs == {(2001, "MISSING_DATE")}
