"""Runs that fail or lose their driver and go on; keys that last; retention."""
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from carestar.operators import audit as A
from carestar.operators import batches as B
from carestar.operators.merge import merge_type1
from carestar.plans import pipeline as PL
from carestar.plans.pipeline import run_pipeline, run_summary
from carestar.plans.star import TEST_PARAMS
from carestar.sources import sinks
from carestar.sources.adapter import oltp_from_driver

from conftest import SF

TABLES = ("fact_encounters", "bridge_encounter_diagnoses", "bridge_encounter_procedures", "dim_patient")


@pytest.fixture(scope="module")
def oltp(spark):
    return oltp_from_driver(spark, SF)


def files(path):
    return {os.path.join(d, f): os.path.getmtime(os.path.join(d, f)) for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}


def same(a, b):
    return a.exceptAll(b.select(*a.columns)).count() == 0 and b.select(*a.columns).exceptAll(a).count() == 0


def test_a_run_that_fails_in_a_range_goes_on_behind_the_mark(spark, oltp, monkeypatch):
    root = tempfile.mkdtemp(prefix="carestar-test-")
    real, built = PL.FA.fact_rows, []

    def breaks(rows, keys, measures, loaded_at):
        built.append(1)
        if len(built) == 4:
            rows = rows.withColumn("patient_key", F.raise_error(F.lit("boom")).cast("long"))
        return real(rows, keys, measures, loaded_at)

    monkeypatch.setattr(PL.FA, "fact_rows", breaks)
    with pytest.raises(Exception, match="boom"):
        run_pipeline(spark, oltp, root, TEST_PARAMS, batch_id="R1", batch_step=250)
    stage, audit = os.path.join(root, "runs", "R1"), os.path.join(root, "_audit")
    load = os.path.join(stage, "_work", "fact")
    assert B.marks(spark, load).count() == 3 and sinks.current_stage(spark, root) is None
    before = files(load)
    dims = files(os.path.join(stage, "dim_patient"))
    first = A.read_audit(spark, audit, "etl_log").filter("batch_id = 'R1'").count()

    kept = []
    real_write = sinks.write_table
    monkeypatch.setattr(PL.sinks, "write_table", lambda df, path, partition_by=None: (kept.append(dict(files(load))), real_write(df, path, partition_by))[1])
    done = run_pipeline(spark, oltp, root, TEST_PARAMS, resume="R1", batch_step=250, publish_failed=True)
    total = B.id_ranges(*oltp["encounters"].agg(F.min("encounter_id"), F.max("encounter_id")).first(), 250)
    assert len(built) == 4 + len(total) - 3                                  # ranges 0 to 2 are not built again
    assert all(kept[-1][f] == t for f, t in before.items() if f in kept[-1])   # nor laid out or written again
    assert files(os.path.join(stage, "dim_patient")) == dims                 # complete tables stay
    monkeypatch.undo()
    whole = run_pipeline(spark, oltp, tempfile.mkdtemp(prefix="carestar-test-"), TEST_PARAMS, batch_id="R1", publish_failed=True)
    for name in TABLES:
        assert same(spark.read.parquet(os.path.join(done.stage, name)), spark.read.parquet(os.path.join(whole.stage, name))), name
    assert done.status == whole.status and sinks.current_stage(spark, root) == stage
    log = A.read_audit(spark, audit, "etl_log").filter("batch_id = 'R1'").orderBy("log_id").collect()
    assert [r.log_id for r in log] == list(range(1, len(log) + 1)) and log[first].message.endswith("goes on")
    assert sum("kept from the attempt before" in r.message for r in log) == 9
    errors = A.errors(spark, audit)
    assert errors.count() == errors.distinct().count() == done.counts["_work/errors"]          # not recorded twice
    assert A.batches(spark, audit).first().status == whole.status
    assert {r.result for r in run_summary(spark, done)["checks"].collect()} <= {"PASS", "FAIL"}
    for batch in ("R1", "R9"):                                               # it has ended; it never began
        with pytest.raises(ValueError):
            run_pipeline(spark, oltp, root, TEST_PARAMS, resume=batch)


class DriverLost(BaseException):
    """Passes every handler of the run, as the end of its process would."""


def test_what_ended_is_on_record_when_the_driver_is_lost(spark, oltp, monkeypatch):
    root = tempfile.mkdtemp(prefix="carestar-test-")

    def lost(*args, **kwargs):
        raise DriverLost
    monkeypatch.setattr(PL.BR, "resolve_links", lost)
    with pytest.raises(DriverLost):
        run_pipeline(spark, oltp, root, TEST_PARAMS, batch_id="L1")
    monkeypatch.undo()
    audit = os.path.join(root, "_audit")
    steps = [r.step_name for r in A.read_audit(spark, audit, "etl_log").orderBy("log_id").collect()]
    assert "DIMENSIONS_COMPLETE" in steps and "VALIDATION_COMPLETE" in steps and steps[-1] == "FACT_COMPLETE"
    assert A.batches(spark, audit).first().status == A.RUNNING
    done = run_pipeline(spark, oltp, root, TEST_PARAMS, resume="L1", publish_failed=True)
    assert A.batches(spark, audit).first().status == done.status == A.FAILED
    assert sinks.current_stage(spark, root) == done.stage


def test_batches_side_by_side_keep_their_events(spark):
    from concurrent.futures import ThreadPoolExecutor
    root = tempfile.mkdtemp(prefix="carestar-test-")

    def batch(name):
        log = A.EventLog(name)
        log.start(spark, root)
        for i in range(3):
            with ThreadPoolExecutor(4) as pool:
                list(pool.map(lambda k: log.log(A.INFO, f"step_{i}_{k}", "done", k), range(8)))
            log.flush(spark, root)
        log.complete(A.COMPLETED, "")
        A.write_audit(spark, root, log, None, 0, 0)

    with ThreadPoolExecutor(4) as pool:
        list(pool.map(batch, [f"20250101_00000{i}_{i:03d}" for i in range(4)]))
    rows = A.read_audit(spark, root, "etl_log").groupBy("batch_id").agg(
        F.count("*").alias("n"), F.count_distinct("log_id").alias("ids"), F.max("log_id").alias("top")).collect()
    assert len(rows) == 4 and all((r.n, r.ids, r.top) == (26, 26, 26) for r in rows)
    assert {r.status for r in A.batches(spark, root).collect()} == {A.COMPLETED}


def test_keys_last_over_runs_and_old_stages_go(spark, oltp):
    root = tempfile.mkdtemp(prefix="carestar-test-")
    scratch = os.path.join(spark.conf.get("spark.checkpoint.dir"), "carestar-scratch")
    some = dict(oltp, patients=oltp["patients"].filter("patient_id % 3 <> 1"))
    run_pipeline(spark, some, root, TEST_PARAMS, batch_id="K1", publish_failed=True)
    before = set(os.listdir(scratch)) if os.path.isdir(scratch) else set()
    old = {r.patient_id: r.patient_key for r in sinks.read_star(spark, root, "dim_patient").collect()}
    run_pipeline(spark, oltp, root, TEST_PARAMS, batch_id="K2", publish_failed=True, keep_keys=True, keep_stages=2)
    new = {r.patient_id: r.patient_key for r in sinks.read_star(spark, root, "dim_patient").collect()}
    assert all(new[i] == k for i, k in old.items()) and set(old) < set(new)
    assert sorted(new.values()) == list(range(1, len(new) + 1))
    fact = sinks.read_star(spark, root, "fact_encounters").select("patient_key").distinct()
    assert fact.join(sinks.read_star(spark, root, "dim_patient"), "patient_key", "left_anti").count() == 0
    stages = lambda: sorted(os.listdir(os.path.join(root, "runs")))
    assert stages() == ["K1", "K2"]
    run_pipeline(spark, oltp, root, TEST_PARAMS, batch_id="K3", publish_failed=True, keep_stages=2)
    assert stages() == ["K2", "K3"]
    assert (set(os.listdir(scratch)) if os.path.isdir(scratch) else set()) <= before      # each run took its scratch tables away
    assert sinks.retain(spark, root, 1) == ["K2"] and sinks.current_stage(spark, root).endswith("K3")
    with pytest.raises(ValueError):
        sinks.retain(spark, root, 0)


def test_merge_on_small_tables(spark):
    stored = spark.createDataFrame([(3, 10, "a", None, "2020-01-01"), (1, 20, None, 5, "2020-01-01"), (2, 30, "c", 6, "2020-01-01")],
                                   "k long, id long, name string, n long, effective_date string")
    new = spark.createDataFrame([(10, "a", None, "2021-01-01"), (20, None, 6, "2021-01-01"), (50, "e", 1, "2021-01-01"), (40, "d", 1, "2021-01-01")],
                                "id long, name string, n long, effective_date string")
    got = sorted(tuple(r) for r in merge_type1(stored, new, "id", "k").collect())
    assert got == [(1, 20, None, 6, "2021-01-01", "UPDATED"), (2, 30, "c", 6, "2020-01-01", "KEPT"), (3, 10, "a", None, "2020-01-01", "UNCHANGED"),
                   (4, 40, "d", 1, "2021-01-01", "INSERTED"), (5, 50, "e", 1, "2021-01-01", "INSERTED")]
    assert merge_type1(stored.limit(0), new, "id", "k").agg(F.min("k"), F.max("k")).first() == (1, 4)
    assert {r.change for r in merge_type1(stored, new.limit(0), "id", "k").collect()} == {"KEPT"}
