"""N1-N4 — the four analytical questions, each on the OLTP model and on the star.

The two forms of Q2 and Q4 answer different questions (row pairs vs distinct
encounters; paid claims vs all claims) and are kept apart. Every top-k has a
total order (ties broken on the group columns). Star forms sort by (year,
month), which is what "newest first" means, not by the month name as text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from carestar.functions.dates import month_label, since
from carestar.functions.expressions import count_when, safe_ratio
from carestar.operators.readmission import readmission_counts
from carestar.sources.sinks import scratch_table

INPATIENT, INPATIENT_CODE, PAID = "Inpatient", "IP", "Paid"
MONEY_SUM = "decimal(22,2)"


def top_n(df: DataFrame, order, n: int) -> DataFrame:
    """L1/L2/L4: ``ORDER BY ... LIMIT n`` (planned as TakeOrderedAndProject: per-partition top n)."""
    return df.orderBy(*order).limit(n)


def _with_specialty(encounters: DataFrame, providers: DataFrame, specialties: DataFrame) -> DataFrame:
    """Encounters -> providers -> specialties (both inner)."""
    p = providers.select("provider_id", "specialty_id")
    s = specialties.select("specialty_id", "specialty_name")
    return encounters.join(p, "provider_id").join(s, "specialty_id")


def _star_dates(star: dict, since_year: int) -> DataFrame:
    """Calendar rows from ``since_year`` on."""
    return star["dim_date"].filter(F.col("year") >= since_year).select("date_key", "year", "month", "month_year")


def _fact(star: dict, since_year: int) -> DataFrame:
    f = star["fact_encounters"]
    if "date_year" in f.columns:       # written fact is partitioned by year: static pruning
        f = f.filter(F.col("date_year") >= since_year)
    return f


# ---- Q1 ---------------------------------------------------------------------
def q1_oltp(oltp: dict, since_ts: str, n: int = 10) -> DataFrame:
    e = oltp["encounters"].filter(since("encounter_date", since_ts))
    g = (_with_specialty(e, oltp["providers"], oltp["specialties"])
         .groupBy(month_label("encounter_date").alias("month"), "specialty_name", "encounter_type")
         .agg(F.count("encounter_id").alias("total_encounters"),
              F.count_distinct("patient_id").alias("unique_patients")))
    return top_n(g, [F.desc("month"), "specialty_name", "encounter_type"], n)


def q1_star(star: dict, since_year: int, n: int = 10) -> DataFrame:
    f = _fact(star, since_year).select("date_key", "specialty_key", "encounter_type_key", "patient_key")
    s = star["dim_specialty"].select("specialty_key", "specialty_name")
    t = star["dim_encounter_type"].select("encounter_type_key", "encounter_type_name")
    g = (f.join(_star_dates(star, since_year), "date_key").join(s, "specialty_key").join(t, "encounter_type_key")
         .groupBy("year", "month", "month_year", "specialty_name", "encounter_type_name")
         .agg(F.count(F.lit(1)).alias("total_encounters"),
              F.count_distinct("patient_key").alias("unique_patients")))
    top = top_n(g, [F.desc("year"), F.desc("month"), "specialty_name", "encounter_type_name"], n)
    return top.select("month_year", "specialty_name", "encounter_type_name", "total_encounters", "unique_patients")


# ---- Q2 ---------------------------------------------------------------------
def code_groups(dim: DataFrame, id_col: str, code: str, desc: str, prefix: str) -> tuple[DataFrame, DataFrame]:
    """Map member ids to one integer per (code, description), in the order of these, on the code table.

    Returns (id -> gid map, gid -> names). Grouping by the names merges ids that
    share both, so the link rows are reduced per group, not per id, and ordered by gid as by the names.
    """
    gid = f"{prefix}_gid"
    # ranges of the names, written once: map and names must number alike; the smallest member id names the group
    parts = scratch_table(dim.select(id_col, code, desc).repartitionByRange(code, desc).withColumn("_part", F.spark_partition_id()), "codes")
    place = F.dense_rank().over(Window.partitionBy("_part").orderBy(code, desc)).cast("long")
    m = parts.select(id_col, code, desc, (F.shiftleft(F.col("_part").cast("long"), 32) + place).alias(gid),
                     F.min(id_col).over(Window.partitionBy("_part", code, desc)).alias("_first"))
    return m.select(id_col, gid), m.filter(F.col(id_col) == F.col("_first")).select(gid, code, desc)


def _pairs(d_side: DataFrame, p_side: DataFrame, on: str, measure) -> DataFrame:
    return d_side.join(p_side, on).groupBy("d_gid", "p_gid").agg(measure)


def _q2_finish(pairs: DataFrame, d_names: DataFrame, p_names: DataFrame, measure: str, n: int) -> DataFrame:
    # gids are in the order of the names, so only the first n pairs need their names
    named = top_n(pairs, [F.desc(measure), "d_gid", "p_gid"], n).join(d_names, "d_gid").join(p_names, "p_gid")
    order = [F.desc(measure), "icd10_code", "icd10_description", "cpt_code", "cpt_description"]
    return top_n(named, order, n).select("icd10_code", "icd10_description", "cpt_code", "cpt_description", measure)


def q2_oltp(oltp: dict, n: int = 20) -> DataFrame:
    """Row pairs: sum over encounters of n_diag(group) * n_proc(group), after reducing each side."""
    dmap, dnames = code_groups(oltp["diagnoses"], "diagnosis_id", "icd10_code", "icd10_description", "d")
    pmap, pnames = code_groups(oltp["procedures"], "procedure_id", "cpt_code", "cpt_description", "p")
    d = (oltp["encounter_diagnoses"].join(dmap, "diagnosis_id")
         .groupBy("encounter_id", "d_gid").agg(F.count(F.lit(1)).alias("nd")))
    p = (oltp["encounter_procedures"].join(pmap, "procedure_id")
         .groupBy("encounter_id", "p_gid").agg(F.count(F.lit(1)).alias("np")))
    pairs = _pairs(d, p, "encounter_id", F.sum(F.col("nd") * F.col("np")).alias("combination_count"))
    return _q2_finish(pairs, dnames, pnames, "combination_count", n)


def q2_star(star: dict, n: int = 20) -> DataFrame:
    """Distinct encounters per pair: distinct (encounter, group) on each side, then count pairs."""
    dmap, dnames = code_groups(star["dim_diagnosis"], "diagnosis_key", "icd10_code", "icd10_description", "d")
    pmap, pnames = code_groups(star["dim_procedure"], "procedure_key", "cpt_code", "cpt_description", "p")
    f = star["fact_encounters"].select("encounter_key")
    d = (star["bridge_encounter_diagnoses"].join(dmap, "diagnosis_key")
         .select("encounter_key", "d_gid").distinct().join(f, "encounter_key", "left_semi"))
    p = (star["bridge_encounter_procedures"].join(pmap, "procedure_key")
         .select("encounter_key", "p_gid").distinct())
    pairs = _pairs(d, p, "encounter_key", F.count(F.lit(1)).alias("encounter_count"))
    return _q2_finish(pairs, dnames, pnames, "encounter_count", n)


# ---- Q3 ---------------------------------------------------------------------
def _q3_finish(counts: DataFrame, min_discharges: int) -> DataFrame:
    out = counts.filter(F.col("index_stays") >= min_discharges).select(
        F.col("grp").alias("specialty_name"),
        F.col("index_stays").alias("total_inpatient_discharges"),
        F.col("readmissions").alias("readmissions_within_30_days"),
        safe_ratio("readmissions", "index_stays").alias("readmission_rate_pct"))
    return out.orderBy(F.desc("readmission_rate_pct"), "specialty_name")


def q3_oltp(oltp: dict, since_ts: str, days: int = 30, min_discharges: int = 10) -> DataFrame:
    enc = oltp["encounters"]
    e1 = enc.filter((F.col("encounter_type") == INPATIENT) & F.col("discharge_date").isNotNull()
                    & since("encounter_date", since_ts))
    idx = _with_specialty(e1, oltp["providers"], oltp["specialties"]).select(
        F.col("encounter_id").alias("e1"), F.col("patient_id").alias("patient"),
        F.col("specialty_name").alias("grp"), F.col("discharge_date").alias("discharge"),
        F.col("encounter_date").alias("start"))
    cand = enc.filter(F.col("encounter_type") == INPATIENT).select(
        F.col("encounter_id").alias("e2"), F.col("patient_id").alias("patient"), F.col("encounter_date").alias("t"))
    return _q3_finish(readmission_counts(idx, cand, days), min_discharges)


def inpatient_key(star: dict):
    """``(SELECT encounter_type_key FROM dim_encounter_type WHERE code = 'IP')`` as a scalar subquery."""
    return (star["dim_encounter_type"].filter(F.col("encounter_type_code") == INPATIENT_CODE)
            .select("encounter_type_key").scalar())


def q3_star(star: dict, since_year: int, days: int = 30, min_discharges: int = 10) -> DataFrame:
    f = star["fact_encounters"]
    t = star["dim_encounter_type"].filter(F.col("encounter_type_code") == INPATIENT_CODE).select("encounter_type_key")
    s = star["dim_specialty"].select("specialty_key", "specialty_name")
    e1 = (_fact(star, since_year).filter(F.col("discharge_date").isNotNull())
          .join(t, "encounter_type_key").join(s, "specialty_key")
          .join(_star_dates(star, since_year).select("date_key"), "date_key"))
    idx = e1.select(F.col("encounter_key").alias("e1"), F.col("patient_key").alias("patient"),
                    F.col("specialty_name").alias("grp"), F.col("discharge_date").alias("discharge"),
                    F.col("encounter_date").alias("start"))
    cand = f.filter(F.col("encounter_type_key") == inpatient_key(star)).select(
        F.col("encounter_key").alias("e2"), F.col("patient_key").alias("patient"),
        F.col("encounter_date").alias("t"))
    return _q3_finish(readmission_counts(idx, cand, days), min_discharges)


# ---- Q4 ---------------------------------------------------------------------
def q4_oltp(oltp: dict, since_ts: str, n: int = 20) -> DataFrame:
    """Paid claims only (J7: the ON-clause filter is applied to billing before the left join).

    Billing is reduced to one row per encounter first (claims, sums, non-null
    count), so the left join is 1:1 and the two distinct counts become sums.
    encounter_id and billing_id are primary keys (checked by ``dq_unique``).
    """
    paid = (oltp["billing"].filter(F.col("claim_status") == PAID)
            .groupBy("encounter_id").agg(F.count("billing_id").alias("n_claims"),
                                         F.sum("claim_amount").alias("billed"),
                                         F.sum("allowed_amount").alias("allowed"),
                                         F.count("allowed_amount").alias("n_allowed")))
    e = oltp["encounters"].filter(since("encounter_date", since_ts))
    j = _with_specialty(e, oltp["providers"], oltp["specialties"]).join(paid, "encounter_id", "left")
    g = j.groupBy(month_label("encounter_date").alias("month"), "specialty_name").agg(
        F.count("encounter_id").alias("total_encounters"),      # 1:1 join: a count is the distinct count
        F.coalesce(F.sum("n_claims"), F.lit(0)).alias("total_claims"),
        F.sum("billed").cast(MONEY_SUM).alias("total_billed"),
        F.sum("allowed").cast(MONEY_SUM).alias("total_revenue"),
        (F.sum("allowed") / F.sum("n_allowed")).alias("_avg"))
    g = g.withColumn("avg_claim_value", F.round(F.col("_avg"), 2).cast("decimal(16,2)")).drop("_avg")
    return top_n(g, [F.desc("month"), F.desc_nulls_last("total_revenue"), "specialty_name"], n)


def q4_star(star: dict, since_year: int, n: int = 20) -> DataFrame:
    f = _fact(star, since_year).filter(F.col("total_allowed_amount").isNotNull()).select(
        "date_key", "specialty_key", "total_claim_amount", "total_allowed_amount")
    s = star["dim_specialty"].select("specialty_key", "specialty_name")
    g = (f.join(_star_dates(star, since_year), "date_key").join(s, "specialty_key")
         .groupBy("year", "month", "month_year", "specialty_name")
         .agg(F.count(F.lit(1)).alias("total_encounters"),
              count_when(F.col("total_allowed_amount").isNotNull()).alias("billed_encounters"),
              F.sum("total_claim_amount").cast(MONEY_SUM).alias("total_billed"),
              F.sum("total_allowed_amount").cast(MONEY_SUM).alias("total_revenue"),
              F.round(F.avg("total_allowed_amount"), 2).cast("decimal(16,2)").alias("avg_revenue_per_encounter")))
    top = top_n(g, [F.desc("year"), F.desc("month"), F.desc_nulls_last("total_revenue"), "specialty_name"], n)
    return top.drop("year", "month")


# ---- S11 ----------------------------------------------------------------------
def monthly_specialty_revenue(star: dict) -> DataFrame:
    """The monthly revenue rollup proposed as a materialised table."""
    f = star["fact_encounters"].select("date_key", "specialty_key", "total_claim_amount", "total_allowed_amount")
    d = star["dim_date"].select("date_key", "year", "month", "month_year")
    s = star["dim_specialty"].select("specialty_key", "specialty_name")
    return (f.join(d, "date_key").join(s, "specialty_key")
            .groupBy("year", "month", "month_year", "specialty_key", "specialty_name")
            .agg(F.count(F.lit(1)).alias("encounters"),
                 F.sum("total_claim_amount").cast(MONEY_SUM).alias("total_billed"),
                 F.sum("total_allowed_amount").cast(MONEY_SUM).alias("total_revenue")))

