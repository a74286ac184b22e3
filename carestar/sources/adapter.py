"""Test adapter: the driver's TPC-H-like tables -> the hospital OLTP model.

Plain column expressions, so the same derivation can be written in the DuckDB
oracle (``oracles/prelude.py``). Every order, line and part is used: a line gives
a diagnosis link, a procedure link and a bill, a part a diagnosis and a
procedure. Deliberate faults, by modulus of a key, exercise every reject type:
nation 24 has no specialty, department 99 does not exist, some birth dates are
null or in the future, 'Telehealth' is not an encounter type, and some parts
have no diagnosis or no procedure.
"""

from __future__ import annotations

import functools
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carestar import schemas
from carestar.operators.keys import sequence_within
from carestar.sources.readers import read_tables
from carestar.sources.sinks import scratch_table

# Fixed values of the fixture (name lists used to dress patients).
FIRST_NAMES = ["Ada", "Ben", "Cleo", "Dan", "Eva", "Finn", "Gia", "Hugo", "Iris", "Jon",
               "Kira", "Liam", "Maya", "Noah", "Olga", "Paul", "Quinn", "Rosa", "Sam", "Tara"]
LAST_NAMES = ["Adams", "Baker", "Clark", "Davis", "Evans", "Foster", "Garcia", "Hill",
              "Irwin", "Jones", "King", "Lopez", "Moore", "Nolan", "Owens"]
CREDENTIALS = ["MD", "RN", "PA"]          # by s_suppkey % 3
CLAIM_STATUS = {"R": "Paid", "A": "Pending", "N": "Denied"}   # by l_returnflag
MISSING_NATION = 24                        # specialties lack this nation
MISSING_DEPARTMENT = 99                    # providers with s_suppkey % 50 = 49 point here
NO_DIAGNOSIS = (997, 3)                    # parts with p_partkey % 997 = 3 have no diagnosis
NO_PROCEDURE = (991, 5)                    # parts with p_partkey % 991 = 5 have no procedure


def _pick(values: list[str], index) -> F.Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def specialties(nation: DataFrame) -> DataFrame:
    return (nation.filter(F.col("n_nationkey") != MISSING_NATION)
            .select(F.col("n_nationkey").cast("long").alias("specialty_id"),
                    F.col("n_name").alias("specialty_name"),
                    F.concat(F.lit("S"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0"))
                    .alias("specialty_code")))


def departments(region: DataFrame) -> DataFrame:
    k = F.col("r_regionkey")
    return region.select(k.cast("long").alias("department_id"), F.col("r_name").alias("department_name"),
                         (k + 1).cast("int").alias("floor"), (10 * (k + 1)).cast("int").alias("capacity"))


def providers(supplier: DataFrame, nation: DataFrame) -> DataFrame:
    s = supplier.join(nation.select("n_nationkey", "n_regionkey"),
                      supplier.s_nationkey == nation.n_nationkey, "left")
    dept = F.when(F.col("s_suppkey") % 50 == 49, F.lit(MISSING_DEPARTMENT)).otherwise(F.col("n_regionkey"))
    return s.select(F.col("s_suppkey").cast("long").alias("provider_id"),
                    F.lit("Supplier").alias("first_name"),
                    F.substring("s_name", 10, 1 << 20).alias("last_name"),
                    _pick(CREDENTIALS, F.col("s_suppkey") % 3).alias("credential"),
                    F.col("s_nationkey").cast("long").alias("specialty_id"),
                    dept.cast("long").alias("department_id"))


def patients(customer: DataFrame) -> DataFrame:
    k = F.col("c_custkey")
    dob = (F.when(k % 97 == 0, F.lit(None).cast("date"))
           .when(k % 101 == 0, F.lit("2999-01-01").cast("date"))
           .otherwise(F.date_add(F.lit("1930-01-01").cast("date"), (k * 7919 % 34000).cast("int"))))
    return customer.select(k.cast("long").alias("patient_id"),
                           _pick(FIRST_NAMES, k % 20).alias("first_name"),
                           _pick(LAST_NAMES, k % 15).alias("last_name"),
                           dob.alias("date_of_birth"),
                           F.when(k % 2 == 0, "F").otherwise("M").alias("gender"),
                           F.concat(F.lit("MRN"), F.lpad(k.cast("string"), 8, "0")).alias("mrn"))


def encounters(orders: DataFrame, provider_df: DataFrame, n_suppliers) -> DataFrame:
    """``n_suppliers``: a number or a scalar subquery."""
    k = F.col("o_orderkey")
    cls = k % 10
    etype = (F.when(k % 499 == 0, "Telehealth").when(cls < 6, "Outpatient")
             .when(cls < 9, "Inpatient").otherwise("ER"))
    stay_h = F.when(cls < 6, 1 + k % 3).when(cls < 9, 24 + k % 168).otherwise(2 + k % 10)
    start = F.timestamp_add("HOUR", (k % 24).cast("int"), F.col("o_orderdate"))
    end = F.when((F.col("o_orderstatus") == "P") & (k % 7 == 0), F.lit(None)) \
        .otherwise(F.timestamp_add("HOUR", stay_h.cast("int"), start))
    enc = orders.select(k.cast("long").alias("encounter_id"),
                        F.col("o_custkey").cast("long").alias("patient_id"),
                        ((k * 31 + F.col("o_custkey") * 17) % n_suppliers).cast("long").alias("provider_id"),
                        etype.alias("encounter_type"),
                        start.cast("timestamp_ntz").alias("encounter_date"),
                        end.cast("timestamp_ntz").alias("discharge_date"))
    dept = provider_df.select("provider_id", "department_id")
    return enc.join(dept, "provider_id", "left").select(*schemas.ENCOUNTERS.fieldNames())


LINE_ORDER = ["l_partkey", "l_linenumber", "l_suppkey", "l_shipdate", "l_quantity", "l_extendedprice",
              "l_discount", "l_tax", "l_returnflag", "l_linestatus"]


def numbered_lines(lineitem: DataFrame) -> DataFrame:
    """Own line numbers per order, and a line id that no two lines share.

    (l_orderkey, l_linenumber) repeats in the driver data. ``line_id`` is the order key times one
    more than the lines of the longest order, plus the line number. The orders are counted once, for that and for
    whether any of them is huge.
    """
    sizes = lineitem.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"))
    longest = sizes.agg(F.max("n")).first()[0] or 0
    numbered = sequence_within(lineitem, ["l_orderkey"], LINE_ORDER, "rn", split_on="l_partkey", largest=longest)
    return numbered.withColumn("line_id", (F.col("l_orderkey") * F.lit(longest + 1).cast("long") + F.col("rn")).cast("long"))


def encounter_diagnoses(lines: DataFrame) -> DataFrame:
    return lines.select(F.col("line_id").alias("encounter_diagnosis_id"),
                        F.col("l_orderkey").cast("long").alias("encounter_id"),
                        F.col("l_partkey").cast("long").alias("diagnosis_id"),
                        F.col("rn").cast("int").alias("diagnosis_sequence"))


def encounter_procedures(lines: DataFrame, n_parts) -> DataFrame:
    """``n_parts``: a number or a scalar subquery."""
    return lines.select(F.col("line_id").alias("encounter_procedure_id"),
                        F.col("l_orderkey").cast("long").alias("encounter_id"),
                        ((F.col("l_partkey") * 7 + F.col("l_linenumber")) % n_parts).cast("long").alias("procedure_id"),
                        F.to_date("l_shipdate").alias("procedure_date"))


def billing(lines: DataFrame) -> DataFrame:
    cents = F.round(F.col("l_extendedprice") * 100).cast("long")
    disc = F.round(F.col("l_discount") * 100).cast("long")
    allowed_cents = F.floor(cents * (100 - disc) / 100).cast("long")
    cent = F.lit(Decimal("0.01"))
    status = F.coalesce(*[F.when(F.col("l_returnflag") == f, F.lit(s)) for f, s in CLAIM_STATUS.items()])
    return lines.select(F.col("line_id").alias("billing_id"),
                        F.col("l_orderkey").cast("long").alias("encounter_id"),
                        (cents.cast("decimal(12,0)") * cent).cast("decimal(12,2)").alias("claim_amount"),
                        (allowed_cents.cast("decimal(12,0)") * cent).cast("decimal(12,2)").alias("allowed_amount"),
                        F.to_date("l_shipdate").alias("claim_date"),
                        status.alias("claim_status"))


def _without(part: DataFrame, gap: tuple[int, int]) -> DataFrame:
    return part.filter(F.col("p_partkey") % gap[0] != gap[1])


def diagnoses(part: DataFrame) -> DataFrame:
    return _without(part, NO_DIAGNOSIS).select(
        F.col("p_partkey").cast("long").alias("diagnosis_id"),
        F.concat(F.lit("D"), F.lpad(F.col("p_partkey").cast("string"), 9, "0")).alias("icd10_code"),
        F.col("p_name").alias("icd10_description"))


def procedures(part: DataFrame) -> DataFrame:
    return _without(part, NO_PROCEDURE).select(
        F.col("p_partkey").cast("long").alias("procedure_id"),
        (F.col("p_partkey") + 90000).cast("string").alias("cpt_code"),
        F.concat_ws(" ", "p_name", "p_type").alias("cpt_description"))


# what links, procedures and bills are made of; the first two are plain selections of the stored lines, while filters on bills
# reach the scan of a table of their own
LINE_COLUMNS = ["line_id", "rn", "l_orderkey", "l_partkey", "l_linenumber", "l_extendedprice", "l_discount", "l_returnflag", "l_shipdate"]
OF_LINES = ("encounter_diagnoses", "encounter_procedures")
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]


def oltp_makers(spark: SparkSession, sf_dir: str) -> dict:
    """How to derive each OLTP table from the driver's files; nothing runs before a table is asked for."""
    t = read_tables(spark, sf_dir, TABLES)
    rows = lambda df: df.agg(F.count(F.lit(1))).scalar()  # noqa: E731  counted when the query runs
    prov = providers(t["supplier"], t["nation"])
    lines = functools.cache(lambda: scratch_table(numbered_lines(t["lineitem"]).select(*LINE_COLUMNS), "lines", lasting=True))   # once for links, procedures and bills
    return {
        "patients": lambda: patients(t["customer"]),
        "specialties": lambda: specialties(t["nation"]),
        "departments": lambda: departments(t["region"]),
        "providers": lambda: prov,
        "encounters": lambda: encounters(t["orders"], prov, rows(t["supplier"])),
        "diagnoses": lambda: diagnoses(t["part"]),
        "encounter_diagnoses": lambda: encounter_diagnoses(lines()),
        "procedures": lambda: procedures(t["part"]),
        "encounter_procedures": lambda: encounter_procedures(lines(), rows(t["part"])),
        "billing": lambda: billing(lines()),
    }


def oltp_from_driver(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All ten OLTP tables as lazy DataFrames over the driver parquet files (the numbered lines are written once)."""
    return {name: make() for name, make in oltp_makers(spark, sf_dir).items()}
