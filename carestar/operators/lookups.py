"""S9 / G1 / G2 / J2 — lookup tables and per-encounter pre-aggregates.

The pre-aggregates replace per-row subqueries: each link table is reduced to one
row per encounter with a partial (map-side) aggregation before the shuffle, so
the shuffle carries at most one row per encounter per map task, however many
links one encounter has.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F



def patient_lookup(dim_patient: DataFrame) -> DataFrame:
    return dim_patient.select("patient_id", "patient_key")


def provider_lookup(providers: DataFrame, dim_provider: DataFrame, dim_specialty: DataFrame) -> DataFrame:
    """Provider -> (provider_key, specialty_key) through two inner joins."""
    dp = dim_provider.select("provider_id", "provider_key")
    ds = dim_specialty.select("specialty_id", "specialty_key")
    return (providers.select("provider_id", "specialty_id")
            .join(dp, "provider_id").join(ds, "specialty_id")
            .select("provider_id", "provider_key", "specialty_key"))


def department_lookup(dim_department: DataFrame) -> DataFrame:
    return dim_department.select("department_id", "department_key")


def encounter_type_lookup(dim_encounter_type: DataFrame) -> DataFrame:
    return dim_encounter_type.select("encounter_type_name", "encounter_type_key")


def count_per_key(df: DataFrame, key: str, name: str) -> DataFrame:
    """G1: ``SELECT key, COUNT(*) ... GROUP BY key``."""
    return df.groupBy(key).agg(F.count(F.lit(1)).cast("int").alias(name))


def billing_totals(billing: DataFrame) -> DataFrame:
    """Claim and allowed sums per encounter, cast back to decimal(12,2) (overflow errors)."""
    return billing.groupBy("encounter_id").agg(
        F.sum("claim_amount").cast("decimal(12,2)").alias("total_claim"),
        F.sum("allowed_amount").cast("decimal(12,2)").alias("total_allowed"))


def encounter_measures(encounter_diagnoses: DataFrame, encounter_procedures: DataFrame,
                       billing: DataFrame) -> DataFrame:
    """G1 + G1 + G2 in one aggregation.

    The three link tables are projected to a common shape and unioned, so one
    shuffle and one hash aggregation give every per-encounter measure, and the
    fact needs one join on ``encounter_id`` instead of three.
    """
    money = "decimal(12,2)"
    d = encounter_diagnoses.select("encounter_id", F.lit(1).alias("_d"), F.lit(0).alias("_p"),
                                   F.lit(None).cast(money).alias("_c"), F.lit(None).cast(money).alias("_a"))
    p = encounter_procedures.select("encounter_id", F.lit(0).alias("_d"), F.lit(1).alias("_p"),
                                    F.lit(None).cast(money).alias("_c"), F.lit(None).cast(money).alias("_a"))
    b = billing.select("encounter_id", F.lit(0).alias("_d"), F.lit(0).alias("_p"),
                       F.col("claim_amount").alias("_c"), F.col("allowed_amount").alias("_a"))
    return d.unionByName(p).unionByName(b).groupBy("encounter_id").agg(
        F.sum("_d").cast("int").alias("diagnosis_count"),
        F.sum("_p").cast("int").alias("procedure_count"),
        F.sum("_c").cast(money).alias("total_claim"),
        F.sum("_a").cast(money).alias("total_allowed"))

