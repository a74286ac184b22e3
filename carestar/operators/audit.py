"""A1-A12 — batch control, event log, error resolution and run summaries.

Audit tables are Parquet with a folder per batch, so batches that run at the same
time never write in one folder. A batch has a RUNNING row and an ETL_START event
from its first moment and a closing row at its end; ``batches`` shows the latest
state of each. Events are numbered within their batch and appended when a phase
ends (``flush``), so a run whose driver is lost has on record what it had done; a
run that resumes goes on behind the last number. Totals are computed when read,
never kept as counters. Reject rows are DataFrames and are never collected; those
of a batch replace the ones that an earlier attempt of it recorded. Resolving
errors appends a resolution, which ``errors`` joins.
"""

from __future__ import annotations

import datetime as dt
import os
import random
import threading
from dataclasses import dataclass, field
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from carestar import schemas
from carestar.functions.expressions import seeded_random
from carestar.sources import sinks

INFO, WARNING, ERROR = "INFO", "WARNING", "ERROR"
RUNNING, COMPLETED, WITH_WARNINGS, FAILED = "RUNNING", "COMPLETED", "COMPLETED_WITH_WARNINGS", "FAILED"


def new_batch_id(now: dt.datetime | None = None, n: int | None = None) -> str:
    """A1: ``YYYYMMDD_HHMMSS_XXX``."""
    now = now or dt.datetime.now(dt.timezone.utc)
    n = random.randrange(1000) if n is None else n
    return f"{now:%Y%m%d_%H%M%S}_{n:03d}"


def batch_id_at(at: Column, seed: int, key: Column) -> Column:
    """A1 as a column: the id of a batch that begins at ``at``, its last three digits drawn by seed and key."""
    digits = F.lpad(F.floor(seeded_random(seed, key) * 1000).cast("string"), 3, "0")
    return F.concat_ws("_", F.date_format(at, "yyyyMMdd_HHmmss"), digits)


@dataclass
class EventLog:
    """A2/A3/A5: the run's log events and batch-control rows, kept on the driver until written."""
    batch_id: str
    batch_type: str = "FULL_REFRESH"
    events: list[tuple] = field(default_factory=list)
    written: int = 0                # events that are in the audit tables already
    before: int = 0                 # events of the batch from earlier attempts
    started: dt.datetime = field(default_factory=lambda: dt.datetime.now(dt.timezone.utc))
    status: str = RUNNING
    ended: dt.datetime | None = None
    notes: str | None = None
    last_successful_encounter_id: int | None = None
    _lock: threading.Lock = field(default_factory=threading.Lock, repr=False)

    def log(self, level: str, step: str, message: str, rows: int | None = None,
            expected: int | None = None, seconds: float | None = None) -> None:
        secs = None if seconds is None else Decimal(f"{seconds:.2f}")
        with self._lock:   # steps of one phase may run as concurrent jobs
            self.events.append((self.before + len(self.events) + 1, self.batch_id, dt.datetime.now(dt.timezone.utc), level,
                                step, message, rows, expected, secs))

    def start(self, spark: SparkSession | None = None, root: str | None = None) -> None:
        """A2: the first event, and with ``root`` the RUNNING row, at once."""
        if root is not None and known_batch(spark, root, self.batch_id):
            events = read_audit(spark, root, "etl_log").filter(F.col("batch_id") == self.batch_id)
            self.before = events.agg(F.max("log_id")).first()[0] or 0
        self.log(INFO, "ETL_START", f"{self.batch_type} batch {'goes on' if self.before else 'begins'}")
        if root is not None:
            write_audit(spark, root, self, None, None, None)

    def flush(self, spark: SparkSession, root: str) -> None:
        """A3: put the events since the last time on record."""
        with self._lock:
            new, at = self.events[self.written:], len(self.events)
        if new:
            frame = spark.createDataFrame(new, schemas.ETL_LOG).coalesce(1)
            _own_folder(frame, root, "etl_log", self.batch_id, "append")
            self.written = at

    def complete(self, status: str, notes: str) -> None:
        self.status, self.notes, self.ended = status, notes, dt.datetime.now(dt.timezone.utc)
        self.log(INFO if status == COMPLETED else ERROR, "ETL_END", f"Batch ends {status}")

    @property
    def logged_rows(self) -> int:
        """The reference-style running total: every event with rows > 0 (double counts steps)."""
        return sum(e[6] for e in self.events if e[6] is not None and e[6] > 0)

    def control_frame(self, spark: SparkSession, total_rows: int | None, total_errors: int | None) -> DataFrame:
        row = (self.batch_id, self.batch_type, self.started, self.ended, self.status, total_rows,
               total_errors, self.last_successful_encounter_id, self.notes)
        return spark.createDataFrame([row], schemas.BATCH_CONTROL)


AUDIT = {"etl_log": schemas.ETL_LOG, "etl_error_records": schemas.ERROR_RECORDS, "etl_batch_control": schemas.BATCH_CONTROL,
         "etl_checks": schemas.CHECKS}


def _own_folder(rows: DataFrame, root: str, table: str, batch_id: str, mode: str) -> None:
    """Write rows of one batch into its folder of an audit table."""
    rows.drop("batch_id").write.mode(mode).parquet(os.path.join(root, table, f"batch_id={batch_id}"))


def write_audit(spark: SparkSession, root: str, log: EventLog, errors: DataFrame | None,
                total_rows: int | None, total_errors: int | None) -> None:
    """The run's new events, its error records and its present batch-control row."""
    log.flush(spark, root)
    if errors is not None:
        _own_folder(errors, root, "etl_error_records", log.batch_id, "overwrite")
    _own_folder(log.control_frame(spark, total_rows, total_errors).coalesce(1), root, "etl_batch_control", log.batch_id, "append")


def record_checks(spark: SparkSession, root: str, batch_id: str, checks: dict[str, dict]) -> None:
    """The result of each check of a batch (a few rows); a later attempt's replace them."""
    rows = [(batch_id, name, c.get("log_level"), c.get("result"), c.get("oltp"), c.get("star")) for name, c in checks.items()]
    _own_folder(spark.createDataFrame(rows, schemas.CHECKS).coalesce(1), root, "etl_checks", batch_id, "overwrite")


def read_audit(spark: SparkSession, root: str, name: str) -> DataFrame:
    """An audit table with its declared columns; without rows where no batch has written to it."""
    path, schema = os.path.join(root, name), AUDIT.get(name)
    if schema is None:
        return spark.read.parquet(path)
    if not sinks.folder_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path).select(*schema.fieldNames())


def batches(spark: SparkSession, root: str) -> DataFrame:
    """The latest state of every batch: the closing row of its last attempt where there is one, else that attempt's RUNNING row."""
    rows = read_audit(spark, root, "etl_batch_control")
    when = F.struct(F.coalesce("end_timestamp", "start_timestamp"), F.col("end_timestamp").isNotNull())
    latest = F.max_by(F.struct(*[F.col(c) for c in rows.columns]), when)
    return rows.groupBy(F.col("batch_id").alias("_id")).agg(latest.alias("b")).select("b.*")


def known_batch(spark: SparkSession, root: str, batch_id: str) -> bool:
    """Whether the audit tables have a row of this batch."""
    return not read_audit(spark, root, "etl_batch_control").filter(F.col("batch_id") == batch_id).isEmpty()


def batch_status(checks: DataFrame, errors: DataFrame) -> DataFrame:
    """Any ERROR check -> FAILED; else any reject -> COMPLETED_WITH_WARNINGS; else COMPLETED.

    WARNING checks alone do not change the status.
    """
    crit = checks.agg(F.count(F.when(F.col("log_level") == ERROR, 1)).alias("critical_errors"))
    rej = errors.agg(F.count(F.lit(1)).alias("n")).select("n").scalar()
    out = crit.select("critical_errors", rej.alias("total_errors"))
    return out.withColumn("status", F.when(F.col("critical_errors") > 0, FAILED)
                          .when(F.col("total_errors") > 0, WITH_WARNINGS).otherwise(COMPLETED))


def id_ranges(lo: int, hi: int, step: int) -> list[tuple[int, int]]:
    """Consecutive closed ranges [lo, lo+step-1], ... covering [lo, hi] (derived, not hard-coded)."""
    return [(a, min(a + step - 1, hi)) for a in range(lo, hi + 1, step)]


def batch_slice(df: DataFrame, key: str, lo: int, hi: int) -> DataFrame:
    """``key BETWEEN lo AND hi`` (both ends included), the reference's batch window."""
    return df.filter(F.col(key).between(lo, hi))


def resolve_errors(errors: DataFrame, batch_id: str, error_type: str, who: str, at: str) -> DataFrame:
    """Mark the batch's unresolved errors of one type as resolved (an immutable rewrite)."""
    hit = (F.col("batch_id") == batch_id) & (F.col("error_type") == error_type) & ~F.coalesce(
        F.col("resolved"), F.lit(False))
    return errors.select(
        *[c for c in errors.columns if c not in ("resolved", "resolved_timestamp", "resolved_by")],
        F.when(hit, True).otherwise(F.col("resolved")).alias("resolved"),
        F.when(hit, F.lit(at).cast("timestamp")).otherwise(F.col("resolved_timestamp")).alias("resolved_timestamp"),
        F.when(hit, F.lit(who)).otherwise(F.col("resolved_by")).alias("resolved_by"))


def resolve_and_record(spark: SparkSession, root: str, batch_id: str, error_type: str, who: str, at: str) -> int:
    """Record that the batch's open errors of one type are resolved; how many that were."""
    n = errors(spark, root).filter((F.col("batch_id") == batch_id) & (F.col("error_type") == error_type)
                                   & ~F.coalesce(F.col("resolved"), F.lit(False))).count()
    row = [(batch_id, error_type, who, at)]
    (spark.createDataFrame(row, "batch_id string, error_type string, by string, at string")
     .withColumn("at", F.col("at").cast("timestamp")).coalesce(1)
     .write.mode("append").parquet(os.path.join(root, "etl_error_resolutions")))
    return n


def errors(spark: SparkSession, root: str) -> DataFrame:
    """Error records with the resolutions recorded since (the first one of a batch and type counts)."""
    rows = read_audit(spark, root, "etl_error_records")
    path = os.path.join(root, "etl_error_resolutions")
    if not sinks.folder_exists(spark, path):           # nothing resolved yet
        return rows
    done = spark.read.parquet(path)
    first = done.groupBy("batch_id", "error_type").agg(F.min("at").alias("_at"), F.min_by("by", "at").alias("_by"))
    open_ = ~F.coalesce(F.col("resolved"), F.lit(False)) & F.col("_at").isNotNull()
    joined = rows.join(first, ["batch_id", "error_type"], "left")
    new = {"resolved": F.lit(True), "resolved_timestamp": F.col("_at"), "resolved_by": F.col("_by")}
    return joined.select(*[F.when(open_, new[c]).otherwise(F.col(c)).alias(c) if c in new else F.col(c) for c in rows.columns])


def count_by(df: DataFrame, col: str, name: str = "count") -> DataFrame:
    """``GROUP BY col ORDER BY count DESC``."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias(name)).orderBy(F.desc(name), col)


def batch_summary(control: DataFrame, log: DataFrame, errors: DataFrame, batch_id: str) -> tuple[DataFrame, ...]:
    """Batch row with duration, counts by log level, counts by error type."""
    c = control.filter(F.col("batch_id") == batch_id).select(
        "batch_id", "batch_type", "status", "start_timestamp", "end_timestamp",
        F.timestamp_diff("MINUTE", F.col("start_timestamp"),
                         F.coalesce(F.col("end_timestamp"), F.current_timestamp())).alias("duration_minutes"),
        "total_rows_processed", "total_errors")
    levels = count_by(log.filter(F.col("batch_id") == batch_id), "log_level")
    types = count_by(errors.filter(F.col("batch_id") == batch_id), "error_type")
    return c, levels, types


def recent_log(log: DataFrame, batch_id: str, n: int = 15) -> DataFrame:
    """The last n log rows of a batch, newest first, message cut to 60 characters."""
    rows = log.filter(F.col("batch_id") == batch_id).orderBy(F.desc("log_id")).limit(n)
    return rows.select("log_id", F.date_format("log_timestamp", "HH:mm:ss").alias("time"), "log_level", "step_name",
                       F.left(F.col("message"), F.lit(60)).alias("message"), "rows_affected",
                       F.col("execution_time_seconds").alias("seconds"))


def batch_history(control: DataFrame) -> DataFrame:
    """A10: batches with their minutes, newest first."""
    minutes = F.timestamp_diff("MINUTE", F.col("start_timestamp"), F.coalesce("end_timestamp", F.current_timestamp()))
    return control.withColumn("duration_minutes", minutes).orderBy(F.desc("start_timestamp"))


def unresolved_rows(errors: DataFrame) -> DataFrame:
    """A10: the open errors themselves."""
    return errors.filter(~F.coalesce(F.col("resolved"), F.lit(False)))


def unresolved(errors: DataFrame) -> DataFrame:
    """A10: open errors per batch and type."""
    return unresolved_rows(errors).groupBy("batch_id", "error_type").agg(F.count(F.lit(1)).alias("unresolved"))


def step_details(log: DataFrame, batch_id: str) -> DataFrame:
    """A10: the steps of a batch in order."""
    return log.filter(F.col("batch_id") == batch_id).orderBy("log_id")


def slow_steps(log: DataFrame, batch_id: str, seconds: float = 60) -> DataFrame:
    """A10: steps slower than ``seconds``."""
    return (log.filter((F.col("batch_id") == batch_id) & (F.col("execution_time_seconds") > seconds))
            .orderBy(F.desc("execution_time_seconds")))
