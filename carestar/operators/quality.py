"""Q1-Q12 — data-quality checks as DataFrames (one row per check result).

Every check is an aggregate over whole tables; the only thing that reaches the
driver is the handful of result rows the audit log records.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carestar.functions.expressions import any_null, level_for

PASS, FAIL, MATCH, MISMATCH = "PASS", "FAIL", "MATCH", "MISMATCH"
FACT_FKS = ["date_key", "patient_key", "provider_key", "specialty_key", "department_key", "encounter_type_key"]


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def _count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n"))


def reconcile_count(name: str, source: DataFrame, star: DataFrame) -> DataFrame:
    """Q1-Q5: row counts of a source table and its star counterpart (WARNING on mismatch)."""
    # two single-row aggregates; the second is a scalar subquery of the first
    j = _count(source).select(F.col("n").alias("oltp"), _count(star).select("n").scalar().alias("star"))
    return j.select(F.lit(name).alias("check_name"), "oltp", "star",
                    F.when(F.col("oltp") == F.col("star"), PASS).otherwise(FAIL).alias("result"),
                    level_for(F.col("oltp") != F.col("star")).alias("log_level"))


def count_checks(oltp: dict, star: dict) -> DataFrame:
    pairs = [("Encounters", oltp["encounters"], star["fact_encounters"]),
             ("Patients", oltp["patients"], star["dim_patient"]),
             ("Providers", oltp["providers"], star["dim_provider"]),
             ("Diagnosis Links", oltp["encounter_diagnoses"], star["bridge_encounter_diagnoses"]),
             ("Procedure Links", oltp["encounter_procedures"], star["bridge_encounter_procedures"])]
    return _union([reconcile_count(n, s, t) for n, s, t in pairs])


def reconcile_sum(source: DataFrame, source_col: str, star: DataFrame, star_col: str,
                  tolerance: str = "0.01") -> DataFrame:
    """``COALESCE(SUM(x), 0)`` on both sides; ERROR unless ``|diff| < tolerance``."""
    b = star.agg(F.coalesce(F.sum(star_col), F.lit(0)).cast("decimal(22,2)"))
    j = source.agg(F.coalesce(F.sum(source_col), F.lit(0)).cast("decimal(22,2)").alias("oltp_revenue"),
                   b.scalar().alias("star_revenue")).withColumn("diff", F.abs(F.col("oltp_revenue") - F.col("star_revenue")))
    ok = F.col("diff") < F.lit(tolerance).cast("decimal(4,2)")
    return j.select("oltp_revenue", "star_revenue", F.col("diff").cast("decimal(22,2)").alias("diff"),
                    F.when(ok, PASS).otherwise(FAIL).alias("result"),
                    level_for(~ok, "ERROR").alias("log_level"))


def null_fk_count(fact: DataFrame, fks: list[str] = FACT_FKS) -> DataFrame:
    """Q7: fact rows with any null foreign key (ERROR if any)."""
    n = fact.agg(F.count(F.when(any_null(fks), 1)).alias("null_fks"))
    return n.select("null_fks", F.when(F.col("null_fks") == 0, PASS).otherwise(FAIL).alias("result"),
                    level_for(F.col("null_fks") > 0, "ERROR").alias("log_level"))


def orphans(bridge: DataFrame, fact: DataFrame, key: str = "encounter_key") -> DataFrame:
    """Bridge rows whose key is not in the fact (anti join of the rows per key)."""
    links = bridge.groupBy(key).agg(F.count(F.lit(1)).alias("links"))
    return links.join(fact.select(key), key, "left_anti").agg(F.coalesce(F.sum("links"), F.lit(0)).alias("n"))


def orphan_bridges(star: dict) -> DataFrame:
    """Q8: orphaned rows in both bridges (ERROR if any)."""
    d = orphans(star["bridge_encounter_diagnoses"], star["fact_encounters"])
    p = orphans(star["bridge_encounter_procedures"], star["fact_encounters"])
    j = d.select(F.col("n").alias("orphan_diagnoses"), p.scalar().alias("orphan_procedures"))
    bad = (F.col("orphan_diagnoses") + F.col("orphan_procedures")) > 0
    return j.select("orphan_diagnoses", "orphan_procedures", F.when(bad, FAIL).otherwise(PASS).alias("result"),
                    level_for(bad, "ERROR").alias("log_level"))


def reconcile_per_key(links: DataFrame, fact: DataFrame, encounters: DataFrame) -> DataFrame:
    """Q9 over **all** encounters instead of one random sample: the source link count
    per encounter equals the fact's ``diagnosis_count`` (0 when not loaded)."""
    src = links.groupBy("encounter_id").agg(F.count(F.lit(1)).alias("oltp_n"))
    star = fact.select("encounter_id", F.col("diagnosis_count").alias("star_n"))
    j = (encounters.select("encounter_id").join(src, "encounter_id", "left").join(star, "encounter_id", "left")
         .select(F.coalesce("oltp_n", F.lit(0)).alias("o"), F.coalesce("star_n", F.lit(0)).alias("s")))
    out = j.agg(F.count(F.lit(1)).alias("encounters_checked"),
                F.count(F.when(F.col("o") != F.col("s"), 1)).alias("mismatches"))
    return out.select("encounters_checked", "mismatches",
                      F.when(F.col("mismatches") == 0, PASS).otherwise(FAIL).alias("result"),
                      level_for(F.col("mismatches") > 0).alias("log_level"))


def check_unique(df: DataFrame, key: str | list[str], table: str) -> DataFrame:
    """Q10: number of key values that occur more than once."""
    keys = [key] if isinstance(key, str) else key
    dup = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("c")).filter(F.col("c") > 1)
    return dup.agg(F.count(F.lit(1)).alias("duplicate_keys")).select(
        F.lit(table).alias("table_name"), F.lit(",".join(keys)).alias("key_columns"), "duplicate_keys")


def check_not_null(df: DataFrame, cols: list[str], table: str) -> DataFrame:
    """Q11: null count per declared NOT NULL column, in one pass over the table."""
    agg = df.agg(*[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in cols])
    stack = ", ".join(f"'{c}', `{c}`" for c in cols)
    return agg.select(F.lit(table).alias("table_name"),
                      F.expr(f"stack({len(cols)}, {stack}) AS (column_name, null_count)"))


def check_fk(child: DataFrame, parent: DataFrame, child_col: str, parent_col: str, name: str) -> DataFrame:
    """Q12: child rows whose non-null foreign key has no parent row."""
    c = child.select(F.col(child_col).alias("_fk")).filter(F.col("_fk").isNotNull())
    bad = c.join(parent.select(F.col(parent_col).alias("_fk")), "_fk", "left_anti")
    return _count(bad).select(F.lit(name).alias("constraint_name"), F.col("n").alias("violations"))
