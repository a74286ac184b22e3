"""P11 / P12 / J12 / W1 — bridge tables for the many-to-many links.

Like the fact, each link table is resolved once with left joins, and the orphans,
the missing member keys and the bridge rows are three filters of that one
result. The fact's procedure count comes along, so that encounters with a huge
number of procedures are known without counting them again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carestar.operators import rejects as R
from carestar.operators.keys import sequence_within


def encounter_lookup(fact: DataFrame) -> DataFrame:
    return fact.select("encounter_id", "encounter_key", "procedure_count")


def resolve_links(links: DataFrame, enc_lookup: DataFrame, dim: DataFrame, member_id: str,
                  member_key: str) -> DataFrame:
    member = dim.select(member_id, member_key)
    return links.join(enc_lookup, "encounter_id", "left").join(member, member_id, "left")


def _link_rejects(resolved: DataFrame, source: str, id_col: str, orphan_type: str,
                  missing_type: str, member_id: str, member_key: str, member_word: str) -> DataFrame:
    """Links without a fact row, and others without a member key, in one pass."""
    orphan = F.col("encounter_key").isNull()

    def either(of_orphan, of_missing):
        return F.when(orphan, of_orphan).otherwise(of_missing)

    return resolved.filter(orphan | F.col(member_key).isNull()).select(
        F.lit(source).alias("source_table"), F.col(id_col).cast("long").alias("source_id"),
        either(F.lit(orphan_type), F.lit(missing_type)).alias("error_type"),
        either(R.text("Encounter ", F.col("encounter_id"), " not in fact table"),
               R.text(f"{member_word} ", F.col(member_id), " not found")).alias("error_message"),
        either(F.lit("encounter_id"), F.lit(member_id)).alias("field_name"),
        either(F.col("encounter_id").cast("string"), F.col(member_id).cast("string")).alias("field_value"))


def diagnosis_rejects(resolved: DataFrame) -> DataFrame:
    return _link_rejects(resolved, "encounter_diagnoses", "encounter_diagnosis_id", R.ORPHAN_DIAGNOSIS,
                         R.MISSING_DIAGNOSIS_KEY, "diagnosis_id", "diagnosis_key", "Diagnosis")


def procedure_rejects(resolved: DataFrame) -> DataFrame:
    return _link_rejects(resolved, "encounter_procedures", "encounter_procedure_id", R.ORPHAN_PROCEDURE,
                         R.MISSING_PROCEDURE_KEY, "procedure_id", "procedure_key", "Procedure")


def build_bridge_diagnoses(resolved: DataFrame) -> DataFrame:
    ok = resolved.filter(F.col("encounter_key").isNotNull() & F.col("diagnosis_key").isNotNull())
    return ok.select("encounter_key", "diagnosis_key", "diagnosis_sequence")


def with_procedure_sequence(df: DataFrame, largest: int | None = None) -> DataFrame:
    """``ROW_NUMBER() OVER (PARTITION BY encounter_key ORDER BY procedure_date,
    encounter_procedure_id)``, computed so that one huge encounter is split.

    A key has one encounter id; with it in the groups, rows that lie together by that id need no second shuffle.
    ``largest``: the most procedures of an encounter, where it is known.
    """
    size = F.col("procedure_count") if "procedure_count" in df.columns else None
    group = [c for c in ("encounter_id", "encounter_key") if c in df.columns]
    return sequence_within(df, group, ["procedure_date", "encounter_procedure_id"],
                           "procedure_sequence", split_on="encounter_procedure_id", size=size, largest=largest)


def build_bridge_procedures(resolved: DataFrame, largest: int | None = None) -> DataFrame:
    ok = resolved.filter(F.col("encounter_key").isNotNull() & F.col("procedure_key").isNotNull())
    seq = with_procedure_sequence(ok.select("encounter_id", "encounter_key", "procedure_key", "procedure_date",
                                            "encounter_procedure_id", "procedure_count"), largest)
    return seq.select("encounter_key", "procedure_key", "procedure_date", "procedure_sequence")
