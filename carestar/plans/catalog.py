"""Registered queries: ``name -> fn(spark, sf_dir) -> DataFrame``.

Every query reads the driver tables through the test adapter. The tables that it
names are derived once per session and state of the files, as Parquet in the
shared checkpoint folder (``StarBuild`` with a store). The DuckDB oracle for each
name is in ``oracles``.
"""

from __future__ import annotations

import os
import threading
import uuid
from collections import ChainMap, OrderedDict
from decimal import Decimal

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from carestar import schemas
from carestar.functions import dates as D
from carestar.functions import expressions as X
from carestar.operators import audit as A
from carestar.operators import batches as B
from carestar.operators import quality as QC
from carestar.operators.dims import build_dim_patient
from carestar.operators.calendar import build_dim_date, date_spine
from carestar.operators.fact import expected_fact_rows, fact_rows, loadable, outside_calendar
from carestar.operators.lookups import billing_totals, count_per_key
from carestar.operators.merge import merge_type1
from carestar.operators.rejects import with_error_audit
from carestar.operators.sampling import sample_one
from carestar.plans import questions as Q
from carestar.plans.compare import compare, read_timings
from carestar.plans.pipeline import run_pipeline, run_summary
from carestar.plans.questions import monthly_specialty_revenue
from carestar.plans.rollups import monthly_patients, refresh_months, roll_up, touched_months
from carestar.plans.star import TEST_PARAMS, LazyTables, StarBuild
from carestar.sources.adapter import OF_LINES, TABLES, oltp_makers
from carestar.sources.bucketed import bucketed_star
from carestar.sources.quarantine import load_csv, load_declared
from carestar.sources.ranges import read_ranges, replace_stored_range, write_ranges
from carestar.sources.readers import read_csv, read_source, table_state
from carestar.session import checkpoint_dir, partitions_of
from carestar.sources.sinks import append, full_refresh, read_star, replace_range, reset_source, scratch_scope, write_table

P = TEST_PARAMS
_BUILDS: OrderedDict[tuple, StarBuild] = OrderedDict()      # of the last few sources
_LOADS: OrderedDict[tuple, tuple] = OrderedDict()
_KEPT = 4
_LOCK = threading.RLock()          # one build / one run per session and source, even from threads

# Parameters of the registered audit queries.
BATCH_SEED = 7
STOP_AFTER = 2                         # ranges that the first attempt of that load gets to
FACT_BATCHES = 6                       # id ranges of the batched fact load
RESOLVED_TYPE, RESOLVED_BY, RESOLVED_AT = "MISSING_PROVIDER", "data.steward", "2025-01-02 09:00:00"


def _source(spark: SparkSession, sf_dir: str) -> tuple:
    return spark.sparkContext.applicationId, sf_dir, table_state(spark, sf_dir, TABLES)


def source_bytes(spark: SparkSession, sf_dir: str) -> int:
    return sum(size for size, _, _ in table_state(spark, sf_dir, TABLES))


def _remember(kept: OrderedDict, key: tuple, value):
    kept[key] = value
    while len(kept) > _KEPT:
        kept.popitem(last=False)
    return value


def build(spark: SparkSession, sf_dir: str) -> StarBuild:
    with _LOCK:
        key = _source(spark, sf_dir)
        if key in _BUILDS:
            return _BUILDS[key]
        store = os.path.join(checkpoint_dir(spark), "carestar-star", uuid.uuid4().hex)
        oltp = LazyTables(oltp_makers(spark, sf_dir), os.path.join(store, "oltp"), unwritten=OF_LINES)
        return _remember(_BUILDS, key, StarBuild(spark, oltp, P, os.path.join(store, "star")))


def _star(spark, sf_dir) -> dict:
    return build(spark, sf_dir).tables()


def _oltp(spark, sf_dir) -> dict:
    return build(spark, sf_dir).oltp


# ---- questions ------------------------------------------------------------------
def q1_oltp(s, d): return Q.q1_oltp(_oltp(s, d), P.since)
def q1_star(s, d): return Q.q1_star(_star(s, d), P.since_year)
def q2_oltp(s, d): return Q.q2_oltp(_oltp(s, d))
def q2_star(s, d): return Q.q2_star(_star(s, d))
def q3_oltp(s, d): return Q.q3_oltp(_oltp(s, d), P.since)
def q3_star(s, d): return Q.q3_star(_star(s, d), P.since_year)
def q4_oltp(s, d): return Q.q4_oltp(_oltp(s, d), P.since)
def q4_star(s, d): return Q.q4_star(_star(s, d), P.since_year)
def monthly_revenue_agg(s, d): return Q.monthly_specialty_revenue(_star(s, d))


# ---- star tables --------------------------------------------------------------
def _span(s, d) -> tuple[str, str]:
    """First and last encounter day in the data (two scalars)."""
    e = _oltp(s, d)["encounters"]
    r = e.agg(F.min(F.to_date("encounter_date")).alias("lo"), F.max(F.to_date("encounter_date")).alias("hi")).first()
    return str(r["lo"]), str(r["hi"])


def dim_date(s, d):
    """P2 over the span of the loaded encounters (the build itself uses the configured calendar)."""
    return build_dim_date(s, *_span(s, d))
def dim_patient(s, d): return build(s, d).dim_patient
def dim_provider(s, d): return build(s, d).dim_provider
def dim_specialty(s, d): return build(s, d).dim_specialty
def dim_department(s, d): return build(s, d).dim_department
def encounter_type_dim(s, d):
    """S3 / P5: the static type table, with how many source encounters carry each type."""
    b = build(s, d)
    used = b.oltp["encounters"].groupBy(F.col("encounter_type").alias("encounter_type_name")) \
        .agg(F.count(F.lit(1)).alias("encounters"))
    return b.dim_encounter_type.join(used, "encounter_type_name", "left") \
        .withColumn("encounters", F.coalesce("encounters", F.lit(0)))
def dim_diagnosis(s, d): return build(s, d).dim_diagnosis
def dim_procedure(s, d): return build(s, d).dim_procedure
def fact_encounters(s, d): return build(s, d).fact.drop("date_year")
def bridge_diagnoses(s, d): return build(s, d).bridge_diagnoses
def bridge_procedures(s, d): return build(s, d).bridge_procedures


def surrogate_keys(s, d):
    """Natural -> surrogate key of every loaded encounter (the largest keyed table)."""
    return build(s, d).fact.select("encounter_id", "encounter_key")


def date_spine_q(s, d):
    """S4 over the span of the loaded encounters."""
    return date_spine(s, *_span(s, d))


# ---- rejects, lookups, pre-aggregates --------------------------------------------
def error_records(s, d): return build(s, d).errors
def patient_rejects(s, d): return build(s, d).patient_rejects


def provider_lookup(s, d): return build(s, d).provider_lookup


def diagnosis_counts(s, d):
    return count_per_key(_oltp(s, d)["encounter_diagnoses"], "encounter_id", "diagnosis_count")


def procedure_counts(s, d):
    return count_per_key(_oltp(s, d)["encounter_procedures"], "encounter_id", "procedure_count")


def billing_totals_q(s, d): return billing_totals(_oltp(s, d)["billing"])


def fact_expected_vs_loaded(s, d):
    b = build(s, d)
    exp = expected_fact_rows(b.resolved_encounters)
    return exp.select("expected_rows", b.fact.agg(F.count(F.lit(1))).scalar().alias("loaded_rows"))


def explain_missing(s, d):
    """Encounters that did not load, with the reasons recorded for them."""
    b = build(s, d)
    missing = b.oltp["encounters"].select("encounter_id").join(b.fact.select("encounter_id"), "encounter_id",
                                                                 "left_anti")
    errs = b.encounter_rejects.select(F.col("source_id").alias("encounter_id"), "error_type", "field_value")
    return missing.join(errs, "encounter_id", "left")


# ---- expressions ---------------------------------------------------------------
def age_band(s, d):
    """Patients per age band at ``as_of``."""
    return build(s, d).dim_patient.groupBy("age_group").agg(F.count(F.lit(1)).alias("patients"))


def length_of_stay(s, d):
    """E7 on the source encounters: per type, stays with a length and their total days."""
    e = _oltp(s, d)["encounters"]
    los = X.length_of_stay("encounter_type", "encounter_date", "discharge_date")
    return e.groupBy("encounter_type").agg(F.count(los).alias("stays"), F.sum(los).alias("total_days"),
                                          F.max(los).alias("max_days"))


def scalar_subquery_filter(s, d):
    """Inpatient fact rows per specialty, type key taken from a scalar subquery."""
    star = _star(s, d)
    f = star["fact_encounters"].filter(F.col("encounter_type_key") == Q.inpatient_key(star))
    return f.groupBy("specialty_key").agg(F.count(F.lit(1)).alias("inpatient_encounters"))


def _batched(s, d):
    """The fact loaded in FACT_BATCHES id ranges, once per session and source: (build, root of the load)."""
    with _LOCK:
        key = _source(s, d)
        if key in _LOADS:
            return _LOADS[key]
        b = build(s, d)
        ready = loadable(b.resolved_encounters)
        ends = ready.agg(F.min("encounter_id").alias("lo"), F.max("encounter_id").alias("hi")).first()
        step = (ends["hi"] - ends["lo"]) // FACT_BATCHES + 1
        root = os.path.join(checkpoint_dir(s), "carestar-batches", uuid.uuid4().hex)
        load = dict(key="encounter_id", numbered="encounter_key", sides={"measures": b.measures})
        fact = lambda rows, keys, measured: fact_rows(rows, keys, measured, P.loaded_at)
        with scratch_scope(s):
            B.run_batches(s, ready, fact, root, step, most=STOP_AFTER, **load)         # the window of the first night closes here
            B.run_batches(s, ready, fact, root, step, **load)                          # and the load goes on behind the mark
        return _remember(_LOADS, key, (b, root))


def batch_equivalence(s, d):
    """The fact loaded range by range (BETWEEN lo AND hi) against the one-job load: per range the expected
    and loaded rows, and the rows that are not the same in both."""
    b, root = _batched(s, d)
    a, whole = B.loaded(s, root), b.fact.drop("date_year")
    both = a.select("*", F.lit(1).alias("_side")).union(whole.select(*a.columns, F.lit(-1).alias("_side")))
    odd = both.groupBy(*a.columns).agg(F.abs(F.sum("_side")).alias("_n")).filter("_n > 0")    # rows that one load has more of
    ranges = B.marks(s, root)
    spans = F.broadcast(ranges.select("range_no", "range_start", "range_end"))
    found = odd.join(spans, odd.encounter_id.between(F.col("range_start"), F.col("range_end"))) \
        .groupBy("range_no").agg(F.sum("_n").alias("differing_rows"))
    return ranges.join(found, "range_no", "left").select(*ranges.columns, F.coalesce("differing_rows", F.lit(0)).alias("differing_rows"))


def batch_resume(s, d):
    """The load stopped after STOP_AFTER ranges and went on later: by which attempt each range was loaded."""
    return B.attempts(s, _batched(s, d)[1])


def high_water_mark(s, d):
    return B.high_water_mark(B.marks(s, _batched(s, d)[1]))


def dim_merge(s, d):
    """The patients as loaded in 2015 (some under a former name, some not there yet), then the present ones (some gone):
    keys last, attributes are overwritten."""
    now = _oltp(s, d)["patients"]
    earlier = now.filter("patient_id % 7 <> 0").withColumn(
        "last_name", F.when(F.col("patient_id") % 5 == 0, "Former").otherwise(F.col("last_name")))
    stored = build_dim_patient(earlier, "2015-01-01")
    latest = build_dim_patient(now.filter("patient_id % 11 <> 0"), P.as_of)
    return merge_type1(stored, latest, "patient_id", "patient_key")


def scalar_date_suite(s, d):
    """§2.8 date functions on every order."""
    o = read_source(s, d, "orders")
    ts = F.col("o_orderdate")
    return o.select(
        "o_orderkey",
        D.date_key(ts).alias("date_key"),
        F.year(ts).alias("y"), F.quarter(ts).alias("q"), F.month(ts).alias("m"), F.dayofmonth(ts).alias("dom"),
        F.dayofweek(ts).alias("dow"), D.week_of_year_sunday(ts).alias("week0"),
        D.is_weekend(ts).alias("weekend"),
        F.date_format(ts, "MMMM").alias("month_name"), F.date_format(ts, "EEEE").alias("day_name"),
        D.month_label(ts).alias("month_label"),
        D.fiscal_year(ts, 7).alias("fy_july"), D.fiscal_quarter(ts, 7).alias("fq_july"),
        D.add_days(ts, 30).alias("plus_30_days"),
        F.datediff(F.lit("2002-01-01").cast("date"), F.to_date(ts)).alias("days_to_2002"),
        D.years_between(F.to_date(ts), F.lit(P.as_of).cast("date")).alias("years_to_as_of"))


def scalar_misc_suite(s, d):
    """§2.8 string and numeric functions on the billing rows."""
    b = _oltp(s, d)["billing"]
    return b.select(
        "billing_id",
        F.concat(F.lit("Claim "), F.col("billing_id").cast("string"), F.lit(" / "), F.col("claim_status"))
        .alias("label"),
        F.lpad(F.col("billing_id").cast("string"), 12, "0").alias("padded"),
        F.left(F.concat_ws(" ", F.col("claim_status"), F.col("claim_amount").cast("string")), F.lit(8)).alias("cut"),
        F.repeat(F.lit("*"), (F.col("billing_id") % 5).cast("int")).alias("stars"),
        F.format_number("claim_amount", 2).alias("formatted"),
        F.elt((F.col("billing_id") % 3 + 1).cast("int"), F.lit("Pending"), F.lit("Paid"), F.lit("Denied"))
        .alias("elt_status"),
        F.abs(F.col("claim_amount") - F.col("allowed_amount")).alias("abs_gap"),
        F.floor(F.col("allowed_amount")).cast("long").alias("floor_allowed"),
        (F.col("billing_id") % 7).alias("mod7"),
        F.round(F.col("allowed_amount") / F.lit(Decimal("3")), 2).cast("decimal(16,2)").alias("third"),
        X.zero_if_missing(F.when(F.col("claim_status") == "Paid", F.col("allowed_amount")),
                          Decimal("0.00")).cast("decimal(12,2)").alias("paid_or_zero"))


# ---- quality -------------------------------------------------------------------
def dq_counts(s, d):
    b = build(s, d)
    return QC.count_checks(b.oltp, b.tables())


def dq_revenue(s, d):
    b = build(s, d)
    return QC.reconcile_sum(b.oltp["billing"], "allowed_amount", b.fact, "total_allowed_amount")


def dq_null_fk(s, d): return QC.null_fk_count(build(s, d).fact)
def dq_orphan_bridge(s, d): return QC.orphan_bridges(_star(s, d))


def dq_diag_count_all(s, d):
    b = build(s, d)
    return QC.reconcile_per_key(b.oltp["encounter_diagnoses"], b.fact, b.oltp["encounters"])


def _both_models(s, d) -> dict:
    b = build(s, d)
    return ChainMap(b.oltp, b.tables())


def dq_unique(s, d):
    t = _both_models(s, d)
    return QC._union([QC.check_unique(t[name], list(keys), name) for name, keys in schemas.UNIQUE])


def dq_not_null(s, d):
    t = _both_models(s, d)
    return QC._union([QC.check_not_null(t[name], cols, name) for name, cols in schemas.NOT_NULL.items()])


def dq_referential(s, d):
    t = _both_models(s, d)
    return QC._union([QC.check_fk(t[child], t[parent], col, col, f"{child}.{col}")
                      for child, col, parent in schemas.FOREIGN_KEYS])


def dq_report(s, d):
    """All reconciliation checks Q1-Q9 with their log level."""
    b = build(s, d)
    star = b.tables()
    counts = QC.count_checks(b.oltp, star).select("check_name", "log_level")
    rev = dq_revenue(s, d).select(F.lit("Revenue").alias("check_name"), "log_level")
    nul = dq_null_fk(s, d).select(F.lit("Null FKs").alias("check_name"), "log_level")
    orp = dq_orphan_bridge(s, d).select(F.lit("Orphan bridges").alias("check_name"), "log_level")
    per = dq_diag_count_all(s, d).select(F.lit("Diagnosis count per encounter").alias("check_name"), "log_level")
    return QC._union([counts, rev, nul, orp, per])


def batch_status(s, d):
    return A.batch_status(dq_report(s, d), build(s, d).errors)


# ---- reports ---------------------------------------------------------------------
def table_counts(s, d):
    """Rows per star table as one UNION ALL report."""
    frames = [df.agg(F.count(F.lit(1)).alias("records")).select(F.lit(n).alias("table_name"), "records")
              for n, df in _star(s, d).items()]
    return QC._union(frames)


def error_summary(s, d):
    return A.count_by(build(s, d).errors, "error_type")


def type_distribution(s, d):
    """Encounters per type and their share of all encounters, as text with one decimal."""
    e = _oltp(s, d)["encounters"]
    g = e.groupBy("encounter_type").agg(F.count(F.lit(1)).alias("count"))
    total = e.agg(F.count(F.lit(1))).scalar()
    tenths = F.floor((F.lit(2000) * F.col("count") + total) / (F.lit(2) * total))   # HALF_UP to 0.1 %
    pct = (tenths.cast("decimal(20,0)") / F.lit(10)).cast("decimal(5,1)")
    return g.select("encounter_type", "count", F.concat(pct.cast("string"), F.lit("%")).alias("percentage"))


def resolve_errors_q(s, d):
    """Record the resolution of a run's MISSING_PROVIDER errors; how many that were, and what is open after it."""
    root = os.path.join(checkpoint_dir(s), "carestar-errors", uuid.uuid4().hex)
    with_error_audit(build(s, d).errors, P.loaded_at).write.partitionBy("batch_id").parquet(os.path.join(root, "etl_error_records"))
    n = A.resolve_and_record(s, root, P.batch_id, RESOLVED_TYPE, RESOLVED_BY, RESOLVED_AT)
    return A.errors(s, root).groupBy("error_type").agg(
        F.count(F.when(F.col("resolved"), 1)).alias("resolved"),
        F.count(F.when(~F.col("resolved"), 1)).alias("open"),
        F.max("resolved_by").alias("resolved_by")).withColumn("resolved_in_all", F.lit(n).cast("long"))


def calendar_check(s, d):
    """Loaded encounters that the calendar does not cover (reports by date leave them out)."""
    b = build(s, d)
    return outside_calendar(b.resolved_encounters, b.dim_date)


def range_replace(s, d):
    """Replace the second quarter of the billing id range by re-derived rows (allowed = 80 % of claim), keep the rest."""
    b = _oltp(s, d)["billing"]
    lowest, span = F.min("billing_id"), F.max("billing_id") - F.min("billing_id")
    lo = b.agg(lowest + F.floor(span / 4)).scalar()
    hi = b.agg(lowest + F.floor(span / 2)).scalar()
    new = b.filter(F.col("billing_id").between(lo, hi)).withColumn(
        "allowed_amount", (F.col("claim_amount") * F.lit(Decimal("0.8"))).cast("decimal(12,2)"))
    return replace_range(b, new, "billing_id", lo, hi)


def union_distinct(s, d):
    """Provider ids known to either the provider table or the encounters."""
    o = _oltp(s, d)
    return o["providers"].select("provider_id").union(o["encounters"].select("provider_id")).distinct()


# ---- audit of a full pipeline run (written under spark.checkpoint.dir) ------------------
_RUNS: OrderedDict[tuple, object] = OrderedDict()


def _full_run(s, d):
    """One full-refresh run per session and source, from the adapter's OLTP tables."""
    with _LOCK:
        key = _source(s, d)
        if key in _RUNS:
            return _RUNS[key]
        root = os.path.join(checkpoint_dir(s), "carestar-runs", uuid.uuid4().hex)
        return _remember(_RUNS, key, run_pipeline(s, build(s, d).oltp, root, P, batch_id=P.batch_id, publish_failed=True))


def run_table_counts(s, d):
    """Rows per star table as written and published by the run."""
    return run_summary(s, _full_run(s, d))["table_counts"]


def run_checks(s, d):
    """The run's reconciliation summary (count checks with PASS/FAIL)."""
    return run_summary(s, _full_run(s, d))["checks"]


def _audit(s, d, name: str):
    """A table of the run's audit, its own batch only."""
    r = _full_run(s, d)
    rows = {"batches": A.batches, "errors": A.errors}.get(name, lambda s, root: A.read_audit(s, root, name))(s, r.audit_root)
    return rows.filter(F.col("batch_id") == r.batch_id), r.batch_id


def run_recent_log(s, d):
    """The run's last 15 log rows, newest first (without the times of day)."""
    log, batch = _audit(s, d, "etl_log")
    return A.recent_log(log, batch).drop("time", "seconds")


def run_batch_totals(s, d):
    """The run's batch-control row (totals computed when the run closed)."""
    return _audit(s, d, "batches")[0].select("total_rows_processed", "total_errors", "status", "last_successful_encounter_id")


def run_log_levels(s, d):
    """The run's log rows per level, read back from the audit tables."""
    log, _ = _audit(s, d, "etl_log")
    return A.count_by(log, "log_level")


def run_error_types(s, d):
    """The run's errors per type, read back from the audit tables."""
    return A.count_by(_audit(s, d, "errors")[0], "error_type")


def batch_history(s, d):
    """A10 / A2: the run's state in batch control: closed, and begun before it ended."""
    return A.batch_history(_audit(s, d, "batches")[0]).select(
        "batch_id", "batch_type", "status", (F.col("duration_minutes") >= 0).alias("timed"),
        (F.col("start_timestamp") <= F.col("end_timestamp")).alias("ended_after_start"))


def batch_events(s, d):
    """A2 / A5: rows that batch control got for the run, by status (RUNNING at its start, one at its end)."""
    return _audit(s, d, "etl_batch_control")[0].groupBy("status").agg(F.count(F.lit(1)).alias("rows"))


def run_status(s, d):
    """The status row of the final summary, without the minutes."""
    return run_summary(s, _full_run(s, d))["status"].drop("duration_minutes")


def unresolved_errors(s, d):
    """A10: the run's open errors, row by row."""
    return A.unresolved_rows(_audit(s, d, "errors")[0]).select("batch_id", "source_table", "source_id", "error_type", "field_value")


def step_details(s, d):
    """A10: every step of the run in order, with its rows."""
    log, batch = _audit(s, d, "etl_log")
    return A.step_details(log, batch).select("log_id", "log_level", "step_name", "message", "rows_affected", "rows_expected")


def slow_steps(s, d):
    """A10: the steps of the run that took any time (the limit is a parameter)."""
    log, batch = _audit(s, d, "etl_log")
    return A.slow_steps(log, batch, seconds=-1).select("step_name")


# ---- sources and sinks ----------------------------------------------------------------------
def _scratch(s) -> str:
    return os.path.join(checkpoint_dir(s), "carestar-io", uuid.uuid4().hex)


def csv_round_trip(s, d):
    """Patients written as headered CSV and read back with the declared schema."""
    path = _scratch(s)
    _oltp(s, d)["patients"].write.option("header", True).option("escape", '"').csv(path)
    return read_csv(s, path, schemas.PATIENTS)


def append_twice(s, d):
    """Paid bills appended to the pending ones; rows and amounts of the table by status."""
    path, bills = _scratch(s), _oltp(s, d)["billing"]
    for status in ("Pending", "Paid"):
        append(bills.filter(F.col("claim_status") == status), path)
    return s.read.parquet(path).groupBy("claim_status").agg(F.count(F.lit(1)).alias("bills"),
                                                            F.sum("claim_amount").cast("decimal(22,2)").alias("claimed"))


def refresh_twice(s, d):
    """Departments loaded, then refreshed with those of the upper floors; readers see the last load."""
    root, rows = _scratch(s), _oltp(s, d)["departments"]
    full_refresh(s, {"departments": rows}, root)
    full_refresh(s, {"departments": rows.filter("floor >= 3")}, root)
    return read_star(s, root, "departments")


def reset_transactions(s, d):
    """A source with its transactional tables emptied; rows per table."""
    base, oltp = _scratch(s), _oltp(s, d)
    for name in ("departments", "specialties"):
        write_table(oltp[name], os.path.join(base, name))
    reset_source(s, base, {n: schemas.OLTP[n] for n in schemas.TRANSACTIONAL})
    return QC._union([s.read.schema(schemas.OLTP[n]).parquet(os.path.join(base, n)).agg(F.count(F.lit(1)).alias("records"))
                      .select(F.lit(n).alias("table_name"), "records") for n in ["departments", "specialties", *schemas.TRANSACTIONAL]])


def compare_models(s, d):
    """The comparison of both models from a stored table of timings; a timing differs from run to run, so the seconds
    are the thousands of rows that a question reads in either model."""
    path, o, star = _scratch(s), _oltp(s, d), _star(s, d)
    measured = [("q1", "oltp", [o["encounters"]]), ("q1", "star", [star["fact_encounters"]]),
                ("q4", "oltp", [o["encounters"], o["billing"]]), ("q4", "star", [star["fact_encounters"]])]
    for question, model, read in measured:
        rows = QC._union([t.agg(F.count(F.lit(1)).alias("n")) for t in read]).agg((F.sum("n") * 1000).cast("double").alias("ms"))
        append(rows.select(F.lit("run").alias("run_id"), F.lit(question).alias("question"), F.lit(model).alias("model"), "ms",
                           F.lit("2025-01-01").cast("timestamp").alias("measured_at")), path)
    return compare(read_timings(s, path))


# ---- stored aggregates, stored ranges, quarantine -----------------------------------------------
def patient_rollup(s, d):
    """Patients by specialty and month, quarter, year and in all, every level from the monthly bitmaps alone."""
    path = _scratch(s)
    write_table(monthly_patients(_star(s, d)), path, ["year"])
    stored = s.read.parquet(path)
    levels = {"month": ["year", "quarter", "month"], "quarter": ["year", "quarter"], "year": ["year"], "all": []}
    parts = [roll_up(stored, [*cols, "specialty_key"], "patients").select(
        F.lit(level).alias("level"), *[(F.col(c) if c in cols else F.lit(None)).cast("int").alias(c) for c in levels["month"]],
        "specialty_key", "patients") for level, cols in levels.items()]
    return QC._union(parts)


LATE = "encounter_id % 3 = 0 AND date_key BETWEEN 19970201 AND 19980615"        # encounters that the second load brings


def monthly_upkeep(s, d):
    """The monthly rollup stored after a first load and then refreshed in the months that a second one touched."""
    path, star = _scratch(s), _star(s, d)
    fact = star["fact_encounters"]
    first = dict(star, fact_encounters=fact.filter(f"NOT ({LATE})"))
    write_table(monthly_specialty_revenue(first).repartitionByRange("year", "month"), path, ["year", "month"])
    refresh_months(s, dict(star), touched_months(fact.filter(LATE), star["dim_date"]), path)
    return s.read.parquet(path)


RANGE_WIDTH = 10_000                   # least number of billing ids of one folder of the stored table
RANGE_FOLDERS = 400                    # the ids of a larger table are cut into about so many folders


def range_replace_stored(s, d):
    """The replacement of ``range_replace`` on a stored table laid out by id range, run twice."""
    path, b = _scratch(s), _oltp(s, d)["billing"]
    low, high = b.agg(F.min("billing_id"), F.max("billing_id")).first()
    width = max(RANGE_WIDTH, (high - low) // RANGE_FOLDERS + 1)
    write_ranges(b, path, "billing_id", width)
    lo, hi = low + (high - low) // 4, low + (high - low) // 2
    new = b.filter(F.col("billing_id").between(lo, hi)).withColumn(
        "allowed_amount", (F.col("claim_amount") * F.lit(Decimal("0.8"))).cast("decimal(12,2)"))
    for _ in range(2):
        replace_stored_range(s, path, new, "billing_id", lo, hi, width)
    return read_ranges(s, path).select(*b.columns)


def _damaged_csv(s, d) -> str:
    """The patients as lines of text, some damaged by the last digits of their id: another text than a date, a field too many,
    fields too few, an open quote, no id."""
    path, p = _scratch(s), _oltp(s, d)["patients"]
    names = schemas.PATIENTS.fieldNames()
    part = F.col("patient_id") % 50
    text = {c: F.coalesce(F.col(c).cast("string"), F.lit("")) for c in names}
    text["date_of_birth"] = F.when(part == 7, "not a date").otherwise(text["date_of_birth"])
    text["first_name"] = F.when(part == 17, F.concat(F.lit('"'), text["first_name"])).otherwise(text["first_name"])
    text["patient_id"] = F.when(part == 19, "").otherwise(text["patient_id"])
    line = F.concat_ws(",", *[text[c] for c in names])
    line = F.when(part == 11, F.concat(line, F.lit(",more"))).when(part == 13, F.concat_ws(",", text["patient_id"], text["first_name"])).otherwise(line)
    p.select(line.alias("value")).write.text(path)
    return path


def _csv_load(s, d):
    return load_csv(s, _damaged_csv(s, d), schemas.PATIENTS, "patients", "patient_id", schemas.PATIENTS.fieldNames())


def csv_quarantine(s, d):
    """The typed rejects of a CSV load with damaged lines."""
    return _csv_load(s, d)[1]


def csv_quarantine_rows(s, d):
    """What that load takes."""
    return _csv_load(s, d)[0]


def schema_drift(s, d):
    """Rejects of a stored table that has drifted from its declaration: ids and birth dates as text, some of them no
    longer readable, a column less and a column more."""
    path, p = _scratch(s), _oltp(s, d)["patients"]
    k = F.col("patient_id")
    p.select(F.when(k % 40 == 0, F.concat(F.lit("P"), k)).otherwise(k.cast("string")).alias("patient_id"), "first_name", "last_name",
             F.when(k % 60 == 1, "unknown").otherwise(F.col("date_of_birth").cast("string")).alias("date_of_birth"), "mrn",
             F.lit("x").alias("note")).write.parquet(path)
    return load_declared(s.read.parquet(path), schemas.PATIENTS, "patients", "patient_id")[1]


BUCKETS = 8                            # of the bucketed encounter tables at least; as many as keep a bucket in a task's memory


def _bucketed(s, d) -> dict:
    buckets = max(BUCKETS, partitions_of(source_bytes(s, d)))
    return bucketed_star(s, _star(s, d), _scratch(s), f"carestar_{uuid.uuid4().hex}", buckets)


def q2_star_bucketed(s, d):
    """Co-occurrence on encounter tables that are stored in buckets of the encounter key."""
    return Q.q2_star(_bucketed(s, d))


def fact_bridge_bucketed(s, d):
    """Links per fact row and diagnosis sequence on the bucketed tables: totals by year of the encounter."""
    star = _bucketed(s, d)
    f = star["fact_encounters"].select("encounter_key", "diagnosis_count", F.floor(F.col("date_key") / 10000).cast("int").alias("year"))
    links = star["bridge_encounter_diagnoses"].groupBy("encounter_key").agg(F.count(F.lit(1)).alias("links"))
    return f.join(links, "encounter_key", "left").groupBy("year").agg(
        F.count(F.lit(1)).alias("encounters"), F.sum(F.coalesce("links", F.lit(0))).alias("links"),
        F.sum("diagnosis_count").alias("counted"), F.count(F.when(F.col("links").isNull(), 1)).alias("without_links"))


def audit_clock(s, d):
    """A1 / A10 / RAND / time formats on a given clock and seed: batches as encounters would have run them, with their ids,
    times of day, minutes and seconds."""
    e = _oltp(s, d)["encounters"]
    control = e.select(A.batch_id_at(F.col("encounter_date"), BATCH_SEED, F.col("encounter_id")).alias("batch_id"), "encounter_id",
                       X.seeded_random(BATCH_SEED, F.col("encounter_id")).alias("drawn"),
                       F.col("encounter_date").alias("start_timestamp"), F.col("discharge_date").alias("end_timestamp"))
    seconds = F.timestamp_diff("SECOND", F.col("start_timestamp"), F.col("end_timestamp"))
    history = A.batch_history(control.filter("end_timestamp IS NOT NULL"))
    return history.select("encounter_id", "batch_id", "drawn", F.date_format("start_timestamp", "HH:mm:ss").alias("started"),
                          F.date_format("end_timestamp", "HH:mm:ss").alias("ended"), "duration_minutes", seconds.alias("seconds"))


SLOW_SECONDS = 5 * 86400


def slow_steps_limit(s, d):
    """A10: steps above a limit that leaves others out: inpatient stays as steps of a batch per department."""
    e = _oltp(s, d)["encounters"].filter((F.col("encounter_type") == "Inpatient") & F.col("discharge_date").isNotNull())
    log = e.select(F.col("encounter_id").alias("log_id"), F.concat(F.lit("D"), F.col("department_id")).alias("batch_id"),
                   F.timestamp_diff("SECOND", F.col("encounter_date"), F.col("discharge_date")).cast("decimal(10,2)").alias("execution_time_seconds"))
    return A.slow_steps(log, "D2", SLOW_SECONDS)


def sample_one_q(s, d):
    """One encounter, drawn by a seed."""
    return sample_one(_oltp(s, d)["encounters"], "encounter_id", 42)


QUERIES = {
    "q1_oltp": q1_oltp, "q1_star": q1_star, "q2_oltp": q2_oltp, "q2_star": q2_star,
    "q3_oltp": q3_oltp, "q3_star": q3_star, "q4_oltp": q4_oltp, "q4_star": q4_star,
    "monthly_revenue_agg": monthly_revenue_agg,
    "dim_date": dim_date, "dim_patient": dim_patient, "dim_provider": dim_provider,
    "dim_specialty": dim_specialty, "dim_department": dim_department,
    "encounter_type_dim": encounter_type_dim, "dim_diagnosis": dim_diagnosis,
    "dim_procedure": dim_procedure, "fact_encounters": fact_encounters,
    "bridge_diagnoses": bridge_diagnoses, "bridge_procedures": bridge_procedures,
    "surrogate_keys": surrogate_keys, "date_spine": date_spine_q,
    "error_records": error_records, "patient_rejects": patient_rejects,
    "provider_lookup": provider_lookup, "diagnosis_counts": diagnosis_counts,
    "procedure_counts": procedure_counts, "billing_totals": billing_totals_q,
    "fact_expected_vs_loaded": fact_expected_vs_loaded, "explain_missing": explain_missing,
    "age_band": age_band, "length_of_stay": length_of_stay,
    "scalar_subquery_filter": scalar_subquery_filter, "batch_equivalence": batch_equivalence,
    "batch_resume": batch_resume, "dim_merge": dim_merge, "high_water_mark": high_water_mark, "scalar_date_suite": scalar_date_suite,
    "scalar_misc_suite": scalar_misc_suite,
    "dq_counts": dq_counts, "dq_revenue": dq_revenue, "dq_null_fk": dq_null_fk,
    "dq_orphan_bridge": dq_orphan_bridge, "dq_diag_count_all": dq_diag_count_all,
    "dq_unique": dq_unique, "dq_not_null": dq_not_null, "dq_referential": dq_referential,
    "dq_report": dq_report, "batch_status": batch_status,
    "table_counts": table_counts, "error_summary": error_summary,
    "type_distribution": type_distribution, "resolve_errors": resolve_errors_q,
    "range_replace": range_replace, "union_distinct": union_distinct,
    "run_table_counts": run_table_counts, "run_checks": run_checks,
    "run_recent_log": run_recent_log, "run_log_levels": run_log_levels,
    "run_batch_totals": run_batch_totals, "run_error_types": run_error_types, "run_status": run_status,
    "batch_history": batch_history, "batch_events": batch_events, "unresolved_errors": unresolved_errors,
    "step_details": step_details, "slow_steps": slow_steps, "calendar_check": calendar_check,
    "csv_round_trip": csv_round_trip, "append_twice": append_twice, "refresh_twice": refresh_twice,
    "reset_transactions": reset_transactions, "compare_models": compare_models,
    "patient_rollup": patient_rollup, "monthly_upkeep": monthly_upkeep, "range_replace_stored": range_replace_stored,
    "csv_quarantine": csv_quarantine, "csv_quarantine_rows": csv_quarantine_rows, "schema_drift": schema_drift,
    "sample_one": sample_one_q, "q2_star_bucketed": q2_star_bucketed, "fact_bridge_bucketed": fact_bridge_bucketed,
    "audit_clock": audit_clock, "slow_steps_limit": slow_steps_limit,
}
