"""The adapter and Q3 reproduce the sf0.01 values recorded in FIXTURES.md §3."""

from pyspark.sql import functions as F

from carestar.plans import questions as Q
from carestar.plans.star import TEST_PARAMS
from carestar.sources.adapter import oltp_from_driver

SF01 = "/root/testdata/sf0.01"


def test_fixture_values(spark):
    o = oltp_from_driver(spark, SF01)
    e = o["encounters"]
    types = {r.encounter_type: r["count"] for r in e.groupBy("encounter_type").count().collect()}
    assert types == {"ER": 1497, "Inpatient": 4491, "Outpatient": 8981, "Telehealth": 31}
    r = e.agg(F.count(F.lit(1)), F.count("discharge_date"),
              F.sum(F.datediff(F.to_date("discharge_date"), F.to_date("encounter_date")))).first()
    assert tuple(r) == (15000, 14263, 20664)
    b = o["billing"].agg(F.sum("claim_amount"), F.sum("allowed_amount"), F.count(F.lit(1)),
                         F.count_distinct("encounter_id")).first()
    assert b[2:] == (60_000, 14_743)                       # a bill for every line
    assert o["encounter_diagnoses"].count() == o["encounter_procedures"].count() == 60_000
    assert o["diagnoses"].count() == 1997 and o["procedures"].count() == 1997      # of 2,000 parts
    p = o["patients"].agg(F.count(F.lit(1)), F.count("date_of_birth"),
                          F.count(F.when(F.col("date_of_birth") > F.lit("2025-01-01").cast("date"), 1))).first()
    assert tuple(p) == (1500, 1484, 14)
    q3 = Q.q3_oltp(o, TEST_PARAMS.since).agg(F.count(F.lit(1)), F.sum("total_inpatient_discharges"),
                                             F.sum("readmissions_within_30_days"),
                                             F.max("readmission_rate_pct")).first()
    assert tuple(q3) == (24, 3556, 141, 6.94)
