import os
import tempfile

from carestar import schemas as S
from carestar.operators import audit as A
from carestar.plans.compare import compare, read_timings, record_timings
from carestar.sources import sinks
from carestar.sources.readers import read_csv
from carestar.streaming.watermark import latest_high_water_mark, recorded_high_water_marks


def test_read_csv_header_and_quotes(spark):
    d = tempfile.mkdtemp(prefix="carestar-csv-")
    p = os.path.join(d, "departments.csv")
    with open(p, "w") as fh:
        fh.write('department_id,department_name,floor,capacity\n1,"Cardiology, North",3,40\n2,Neurology,5,20\n')
    rows = read_csv(spark, p, S.DEPARTMENTS).orderBy("department_id").collect()
    assert [(r.department_id, r.department_name, r.floor) for r in rows] == \
        [(1, "Cardiology, North", 3), (2, "Neurology", 5)]


def test_reset_source_and_full_refresh(spark):
    base = tempfile.mkdtemp(prefix="carestar-src-")
    sinks.reset_source(spark, base, {n: S.OLTP[n] for n in S.TRANSACTIONAL})
    for n in S.TRANSACTIONAL:
        assert spark.read.parquet(os.path.join(base, n)).count() == 0
    root = tempfile.mkdtemp(prefix="carestar-star-")
    df = spark.createDataFrame([(1, "x")], "id long, v string")
    stage = sinks.full_refresh(spark, {"t": df}, root)
    assert sinks.current_stage(spark, root) == stage and sinks.read_star(spark, root, "t").count() == 1
    stage2 = sinks.full_refresh(spark, {"t": df.union(df)}, root)
    assert sinks.read_star(spark, root, "t").count() == 2
    assert spark.read.parquet(os.path.join(stage, "t")).count() == 1 and stage2 != stage   # old run intact


def test_audit_views(spark):
    log = A.EventLog("B9")
    log.start()
    log.log(A.INFO, "load_dim_date", "Loaded 3 dates", 3, None, 0.5)
    log.log(A.WARNING, "slow_step", "slow", 10, None, 75.0)
    log.complete(A.WITH_WARNINGS, "done")
    root = tempfile.mkdtemp(prefix="carestar-audit-")
    errs = spark.createDataFrame([("B9", "encounters", 5, "MISSING_PATIENT", "m", "patient_id", "7")],
                                 "batch_id string, source_table string, source_id long, error_type string, "
                                 "error_message string, field_name string, field_value string")
    from carestar.operators.rejects import with_error_audit
    log.last_successful_encounter_id = 42
    A.write_audit(spark, root, log, with_error_audit(errs, "2025-01-01 00:00:00"), 13, 1)
    control = A.batches(spark, root)
    lg = A.read_audit(spark, root, "etl_log")
    er = A.read_audit(spark, root, "etl_error_records")
    c, levels, types = A.batch_summary(control, lg, er, "B9")
    assert c.first().status == A.WITH_WARNINGS
    # ETL_END is logged at ERROR level for any status other than COMPLETED
    assert {r.log_level: r["count"] for r in levels.collect()} == {"INFO": 2, "WARNING": 1, "ERROR": 1}
    assert types.first().error_type == "MISSING_PATIENT"
    assert [r.step_name for r in A.slow_steps(lg, "B9").collect()] == ["slow_step"]
    assert A.unresolved(er).first().unresolved == 1
    fixed = A.resolve_errors(er, "B9", "MISSING_PATIENT", "me", "2025-01-02 00:00:00")
    assert A.unresolved(fixed).count() == 0 and A.batch_history(control).count() == 1
    assert A.step_details(lg, "B9").count() == 4 and log.logged_rows == 13
    assert latest_high_water_mark(control).first().last_successful_encounter_id == 42
    assert recorded_high_water_marks(control).count() == 1


def test_compare_report(spark, tmp_path):
    path = str(tmp_path / "timings")
    record_timings(spark, path, {"q1_oltp": 9.0, "q1_star": 9.0, "etl": 5.0}, "before")
    record_timings(spark, path, {"q1_oltp": 2.0, "q1_star": 1.0, "q2_oltp": 1.0, "q2_star": 2.0}, "now")
    stored = read_timings(spark, path)
    assert stored.count() == 6 and {r.question for r in stored.collect()} == {"q1", "q2"}
    rows = {r.question: r for r in compare(stored).collect()}             # the newest measurement counts
    assert rows["q1"].speedup == 2.0 and rows["q2"].speedup == 0.5
    assert rows["TOTAL"].speedup == 1.0 and rows["MEAN_OF_RATIOS"].speedup == 1.25

