"""P1 / P15 — type-1 merge: surrogate keys that last from load to load."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carestar.operators.keys import number_keys

# Dimensions whose keys can outlast a load: natural key and surrogate key.
LASTING = {"dim_patient": ("patient_id", "patient_key"), "dim_provider": ("provider_id", "provider_key"),
           "dim_specialty": ("specialty_id", "specialty_key"), "dim_department": ("department_id", "department_key"),
           "dim_diagnosis": ("diagnosis_id", "diagnosis_key"), "dim_procedure": ("procedure_id", "procedure_key")}
STAMPS = ("effective_date",)        # tell when a row was written: no change by themselves
INSERTED, UPDATED, UNCHANGED, KEPT = "INSERTED", "UPDATED", "UNCHANGED", "KEPT"


def merge_type1(stored: DataFrame, new: DataFrame, natural: str, key: str, stamps: tuple[str, ...] = STAMPS) -> DataFrame:
    """The stored dimension after a load of ``new`` (same columns; its own ``key``, if any, is ignored), with ``change``.

    A natural key that is stored keeps its surrogate key. Attributes that differ are overwritten (nulls compare as values);
    a row whose attributes are the same keeps its stamps. Natural keys that are new are numbered from the largest stored key
    on, in their order. Rows that the source no longer has stay as they are, since facts may point to them. Only the new
    natural keys are numbered; both sides meet in one join on the natural key.
    """
    columns = stored.columns
    attributes = [c for c in columns if c not in (natural, key)]
    top = stored.agg(F.coalesce(F.max(key), F.lit(0)).alias("top")).first()["top"]         # one number
    fresh = new.select(natural).join(stored.select(natural), natural, "left_anti")
    numbered = number_keys(fresh, natural, key, top + 1)
    keys = stored.select(natural, key).unionByName(numbered.select(natural, F.col(key)))
    old = stored.select(F.col(natural).alias("_id"), F.lit(True).alias("_stored"), *[F.col(c).alias(f"_old_{c}") for c in attributes])
    now = new.select(natural, F.lit(True).alias("_new"), *attributes)
    both = keys.join(now, natural, "left").join(old, F.col(natural) == F.col("_id"), "left")
    compared = [c for c in attributes if c not in stamps]
    differs = reduce(lambda a, b: a | b, [~F.col(c).eqNullSafe(F.col(f"_old_{c}")) for c in compared], F.lit(False))
    change = (F.when(F.col("_stored").isNull(), INSERTED).when(F.col("_new").isNull(), KEPT)
              .when(differs, UPDATED).otherwise(UNCHANGED))
    took = change.isin(INSERTED, UPDATED)
    out = {natural: F.col(natural), key: F.col(key)} | {
        c: F.when(took, F.col(c)).otherwise(F.col(f"_old_{c}")).alias(c) for c in attributes}
    return both.select(*[out[c] for c in columns], change.alias("change"))
