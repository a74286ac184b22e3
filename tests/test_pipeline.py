import os
import tempfile

import pytest
from pyspark.sql import functions as F

from carestar.operators import audit as A
from carestar.plans.pipeline import run_pipeline, run_summary
from carestar.plans.star import TEST_PARAMS
from carestar.sources import sinks
from carestar.sources.adapter import oltp_from_driver

from conftest import SF


@pytest.fixture(scope="module")
def oltp(spark):
    return oltp_from_driver(spark, SF)


def test_full_refresh_publish_and_rerun(spark, oltp):
    root = tempfile.mkdtemp(prefix="carestar-test-")
    r1 = run_pipeline(spark, oltp, root, TEST_PARAMS, batch_id="B1", batch_step=250, publish_failed=True)
    assert sinks.current_stage(spark, root) == r1.stage
    assert not os.path.exists(os.path.join(r1.stage, "_work"))            # work tables are gone
    marks = spark.read.parquet(os.path.join(root, "_audit", "fact_batches", "batch_id=B1"))
    assert marks.count() >= 6 and marks.filter("expected_rows <> loaded_rows").count() == 0
    # rejects + loaded = source
    errs = spark.read.parquet(os.path.join(root, "_audit", "etl_error_records")).filter(F.col("batch_id") == "B1")
    n_enc_rej = errs.filter(F.col("source_table") == "encounters").select("source_id").distinct().count()
    assert r1.counts["fact_encounters"] + n_enc_rej == oltp["encounters"].count()
    # status rule: the revenue of rejected encounters is missing -> ERROR -> FAILED
    assert r1.status == A.FAILED
    s = run_summary(spark, r1)
    assert s["recent_log"].count() == 15
    # idempotent rerun
    with pytest.raises(ValueError):
        run_pipeline(spark, oltp, root, TEST_PARAMS, batch_id="B1")        # a batch id is used once
    r2 = run_pipeline(spark, oltp, root, TEST_PARAMS, batch_id="B2")
    assert sinks.current_stage(spark, root) == r1.stage                    # a FAILED run is not published by itself
    a = spark.read.parquet(os.path.join(r2.stage, "fact_encounters")).drop("etl_loaded_date")
    b = spark.read.parquet(os.path.join(r1.stage, "fact_encounters")).drop("etl_loaded_date")
    assert a.count() == b.count() and a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    assert A.batches(spark, os.path.join(root, "_audit")).count() == 2
    events = A.read_audit(spark, os.path.join(root, "_audit"), "etl_log").filter("batch_id = 'B2'").orderBy("log_id").collect()
    assert [e.log_id for e in events] == list(range(1, len(events) + 1)) and events[0].step_name == "ETL_START"


def test_failure_is_not_published(spark, oltp):
    root = tempfile.mkdtemp(prefix="carestar-test-")
    bad = dict(oltp)
    bad["encounters"] = oltp["encounters"].withColumn("patient_id", F.raise_error(F.lit("boom")))
    with pytest.raises(Exception):
        run_pipeline(spark, bad, root, TEST_PARAMS, batch_id="BX")
    assert sinks.current_stage(spark, root) is None
    log = spark.read.parquet(os.path.join(root, "_audit", "etl_log"))
    assert log.filter(F.col("log_level") == "ERROR").count() >= 1
    audit = os.path.join(root, "_audit")
    assert A.batches(spark, audit).first().status == A.FAILED
    assert {r.status for r in A.read_audit(spark, audit, "etl_batch_control").collect()} == {A.RUNNING, A.FAILED}
    kept = A.read_audit(spark, audit, "etl_error_records")                 # rejects found before the failure
    assert {r.source_table for r in kept.select("source_table").distinct().collect()} == {"patients", "providers"}


def _sound(spark, oltp):
    """The test tables without their faults."""
    ok = dict(oltp)
    as_of = F.lit(TEST_PARAMS.as_of).cast("date")
    ok["patients"] = oltp["patients"].withColumn("date_of_birth", F.when(
        F.col("date_of_birth") <= as_of, F.col("date_of_birth")).otherwise(F.lit("1970-01-01").cast("date")))
    ok["specialties"] = oltp["specialties"].unionByName(spark.createDataFrame([(24, "Other", "S24")], oltp["specialties"].schema))
    ok["providers"] = oltp["providers"].withColumn("department_id", F.when(F.col("department_id") == 99, 0).otherwise(F.col("department_id")))
    ok["encounters"] = (oltp["encounters"].withColumn("encounter_type", F.when(F.col("encounter_type") == "Telehealth", "ER")
                                                      .otherwise(F.col("encounter_type")))
                        .withColumn("department_id", F.when(F.col("department_id") == 99, 0).otherwise(F.col("department_id"))))
    for links, dim, key in (("encounter_diagnoses", "diagnoses", "diagnosis_id"), ("encounter_procedures", "procedures", "procedure_id")):
        ok[links] = oltp[links].join(oltp[dim].select(key), key, "left_semi").join(
            ok["encounters"].select("encounter_id"), "encounter_id", "left_semi")
    ok["billing"] = oltp["billing"].join(ok["encounters"].select("encounter_id"), "encounter_id", "left_semi")
    return ok


def test_completed_and_with_warnings(spark, oltp):
    root = tempfile.mkdtemp(prefix="carestar-test-")
    sound = _sound(spark, oltp)
    r = run_pipeline(spark, sound, root, TEST_PARAMS, batch_id="OK")
    assert r.status == A.COMPLETED and sinks.current_stage(spark, root) == r.stage
    # an extra patient without a birth date is rejected, and nothing else goes wrong
    odd = spark.createDataFrame([(10 ** 9, "No", "Date", None, "F", "X")], sound["patients"].schema)
    r = run_pipeline(spark, dict(sound, patients=sound["patients"].unionByName(odd)), root, TEST_PARAMS, batch_id="WARN")
    assert r.status == A.WITH_WARNINGS and sinks.current_stage(spark, root) == r.stage
    audit = os.path.join(root, "_audit")
    assert A.resolve_and_record(spark, audit, "WARN", "INVALID_DOB", "me", "2025-01-02 00:00:00") == 1
    assert A.unresolved_rows(A.errors(spark, audit)).count() == 0
    assert A.resolve_and_record(spark, audit, "WARN", "INVALID_DOB", "me", "2025-01-03 00:00:00") == 0


def test_batched_load_stops_before_a_failing_range_and_resumes(spark):
    from carestar.operators import batches as B
    root = tempfile.mkdtemp(prefix="carestar-batch-")
    source = spark.range(100, 200).withColumnRenamed("id", "encounter_id")
    broken = F.when(F.col("encounter_id") == 165, F.raise_error(F.lit("boom"))).otherwise(F.col("encounter_id") * 2)
    with pytest.raises(Exception):
        B.run_batches(spark, source, lambda rows: rows.withColumn("v", broken.cast("long")), root, 20)
    assert B.high_water_mark(B.marks(spark, root)).first()[0] == 159
    seen = []

    def good(rows):
        seen.append(rows.agg(F.min("encounter_id")).first()[0])
        return rows.withColumn("v", F.col("encounter_id") * 2)
    done = B.run_batches(spark, source, good, root, 20)
    assert seen == [160, 180] and done.count() == 5                        # committed ranges are not loaded again
    assert B.high_water_mark(done).first()[0] == 199
    assert B.loaded(spark, root).agg(F.count("*"), F.sum("v")).first() == (100, 2 * sum(range(100, 200)))
    assert B.run_batches(spark, source.limit(0), good, root + "x", 20).count() == 0


def test_batch_slice_edges(spark):
    df = spark.range(0, 12).withColumnRenamed("id", "k")
    got = [r.k for r in A.batch_slice(df, "k", 4, 7).orderBy("k").collect()]
    assert got == [4, 5, 6, 7]                                  # lo and hi in, hi + 1 out
    ranges = A.id_ranges(0, 11, 4)
    parts = [A.batch_slice(df, "k", lo, hi).count() for lo, hi in ranges]
    assert parts == [4, 4, 4] and sum(parts) == df.count()     # ranges cover every id once


def test_batch_id_and_ranges():
    import datetime as dt
    assert A.new_batch_id(dt.datetime(2024, 5, 6, 7, 8, 9), 5) == "20240506_070809_005"
    assert A.id_ranges(0, 10, 4) == [(0, 3), (4, 7), (8, 10)]
