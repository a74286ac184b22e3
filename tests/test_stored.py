"""Quarantine, stored ranges, the monthly aggregate, mergeable distinct counts, the one-row sample."""
import os
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from carestar import schemas
from carestar.operators.sampling import sample_one
from carestar.plans import rollups as RU
from carestar.plans.questions import monthly_specialty_revenue
from carestar.sources import ranges as RG
from carestar.sources import sinks
from carestar.sources.quarantine import load_csv, load_declared


def files(path):
    return {os.path.join(d, f): os.path.getmtime(os.path.join(d, f)) for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}


def test_three_bad_lines_of_a_csv_file(spark, tmp_path):
    path = tmp_path / "patients.csv"
    path.write_text('patient_id,last_name,first_name,date_of_birth,mrn,age\n'
                    '1,"O""Hara, jr.",Ann,1980-02-29,M1,40\n'
                    '2,Bo,Ben,1980-13-29,M2,40\n'                 # no such month
                    '3,Cole\n'                                    # fields are missing
                    '4,Dee,"Dan,1980-01-01,M4,40\n'               # a quote stays open
                    '5,,,,,\n')
    rows, rejects = load_csv(spark, str(path), schemas.PATIENTS, "patients", "patient_id")
    assert rows.columns == schemas.PATIENTS.fieldNames()
    got = {r.patient_id: (r.last_name, str(r.date_of_birth), r.gender) for r in rows.collect()}
    assert got == {1: ('O"Hara, jr.', "1980-02-29", None), 5: (None, "None", None)}
    bad = sorted((r.source_id or 0, r.error_type, r.field_name or "", r.field_value or "") for r in rejects.collect())
    assert bad == [(0, "COLUMN_EXTRA", "age", ""), (0, "COLUMN_MISSING", "gender", ""), (2, "BAD_VALUE", "date_of_birth", "1980-13-29"),
                   (3, "FIELD_COUNT", "", "3,Cole"), (4, "UNCLOSED_QUOTE", "", '4,Dee,"Dan,1980-01-01,M4,40')]


def test_a_csv_file_without_faults_or_rows(spark, tmp_path):
    path = tmp_path / "departments.csv"
    path.write_text("department_id,department_name,floor,capacity\n1,A,2,3\n")
    rows, rejects = load_csv(spark, str(path), schemas.DEPARTMENTS, "departments", "department_id")
    assert [tuple(r) for r in rows.collect()] == [(1, "A", 2, 3)] and rejects.count() == 0
    path.write_text("department_id,department_name,floor,capacity\n")
    rows, rejects = load_csv(spark, str(path), schemas.DEPARTMENTS, "departments", "department_id")
    assert rows.count() == 0 and rejects.count() == 0


def test_declared_types_on_a_scan(spark):
    found = spark.createDataFrame([("7", "A", 2.0, "x"), ("b", "B", 3.0, "x"), (None, "C", 1.0, "x")], "department_id string, department_name string, floor double, note string")
    rows, rejects = load_declared(found, schemas.DEPARTMENTS, "departments", "department_id")
    assert [tuple(r) for r in rows.collect()] == [(7, "A", 2, None)]
    kinds = sorted((r.error_type, r.field_name) for r in rejects.collect())
    assert kinds == [("BAD_VALUE", "department_id"), ("COLUMN_EXTRA", "note"), ("COLUMN_MISSING", "capacity"), ("COLUMN_TYPE", "department_id"),
                     ("COLUMN_TYPE", "floor"), ("MISSING_VALUE", "department_id")]
    sound = spark.createDataFrame([(1, "A", 2, 3)], schemas.DEPARTMENTS)
    assert load_declared(sound, schemas.DEPARTMENTS, "departments", "department_id")[1].count() == 0


def _pairs(df):
    return sorted((r.id, r.v) for r in df.collect())


def test_a_stored_range_is_replaced_in_its_folders_only(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    RG.write_ranges(spark.range(-20, 100).select("id", F.lit("old").alias("v")), path, "id", 10)
    before = files(path)
    new = spark.range(0, 60).select("id", F.lit("new").alias("v")).filter("id % 2 = 0")
    RG.replace_stored_range(spark, path, new, "id", 25, 44, 10)
    want = sorted([(i, "old") for i in range(-20, 100) if not 25 <= i <= 44] + [(i, "new") for i in range(25, 45) if i % 2 == 0])
    assert _pairs(RG.read_ranges(spark, path)) == want
    after = files(path)
    untouched = [f for f in before if not any(f"key_range={k}/" in f for k in (2, 3, 4))]
    assert untouched and all(after[f] == before[f] for f in untouched)
    RG.replace_stored_range(spark, path, new, "id", 25, 44, 10)
    assert _pairs(RG.read_ranges(spark, path)) == want                      # repeating it changes nothing
    RG.replace_stored_range(spark, path, new.limit(0), "id", 20, 29, 10)    # a folder that loses all its rows goes
    want = [(i, v) for i, v in want if not 20 <= i <= 29]
    assert _pairs(RG.read_ranges(spark, path)) == want and not os.path.exists(os.path.join(path, "key_range=2"))

    class Cut(BaseException):
        pass

    def cut(*args):
        raise Cut
    real = sinks.replace_partitions

    def half(df, where, by):                                               # the folders are taken away, and there it ends
        for k in (5, 6):
            sinks.drop_folder(spark, os.path.join(where, f"key_range={k}"))
        raise Cut
    monkeypatch.setattr(RG.sinks, "replace_partitions", half)
    with pytest.raises(Cut):
        RG.replace_stored_range(spark, path, new, "id", 55, 64, 10)
    monkeypatch.setattr(RG.sinks, "replace_partitions", real)
    assert RG.recover(spark, path) and not RG.recover(spark, path)
    want = sorted([(i, v) for i, v in want if not 55 <= i <= 64] + [(i, "new") for i in (56, 58)])
    assert _pairs(RG.read_ranges(spark, path)) == want


def _star(spark, facts):
    dates = spark.createDataFrame([(y * 10000 + m * 100 + 1, y, (m + 2) // 3, m, f"{m} {y}") for y in (2020, 2021) for m in range(1, 13)],
                                  "date_key int, year int, quarter int, month int, month_year string")
    fact = spark.createDataFrame(facts, "date_key int, specialty_key long, patient_key long, total_claim_amount decimal(12,2), total_allowed_amount decimal(12,2)")
    return {"fact_encounters": fact, "dim_date": dates, "dim_specialty": spark.createDataFrame([(1, "A"), (2, "B")], "specialty_key long, specialty_name string")}


def _facts(n=400, top=70_000):

    rnd = random.Random(4)
    return [(y * 10000 + m * 100 + 1, rnd.randint(1, 2), rnd.choice([1, 2, 32768, 32769, rnd.randint(1, top)]), Decimal(i), Decimal(i))
            for i in range(n) for y, m in [(rnd.choice([2020, 2021]), rnd.randint(1, 12))]]


def test_distinct_counts_roll_up(spark):
    facts = _facts()
    maps = RU.monthly_patients(_star(spark, facts))
    for groups, of in ((["year"], lambda f: (f[0] // 10000,)), (["year", "quarter", "specialty_key"], lambda f: (f[0] // 10000, (f[0] // 100 % 100 + 2) // 3, f[1])),
                       (["specialty_key"], lambda f: (f[1],))):
        want = {}
        for f in facts:
            want.setdefault(of(f), set()).add(f[2])
        got = {tuple(r[g] for g in groups): r.n for r in RU.roll_up(maps, groups, "n").collect()}
        assert got == {k: len(v) for k, v in want.items()}
    assert RU.roll_up(RU.monthly_patients(_star(spark, [])), ["year"], "n").count() == 0


def test_only_the_touched_months_are_written(spark, tmp_path):
    path, facts = str(tmp_path / "agg"), _facts(200)
    odd = (20201201, 1, 5, Decimal(1), Decimal(1))
    late = [f for f in facts if f[0] in (20200301, 20210701)]
    first = [f for f in facts if f not in late] + [odd]
    sinks.write_table(monthly_specialty_revenue(_star(spark, first)), path, ["year", "month"])
    before = files(path)
    now = [f for f in first if f[0] != 20201201] + late                    # March and July come, December 2020 loses all its rows
    star = _star(spark, now)
    touched = RU.touched_months(_star(spark, late + [odd])["fact_encounters"], star["dim_date"])
    for _ in range(2):
        RU.refresh_months(spark, star, touched, path)
        stored = spark.read.parquet(path)
        whole = monthly_specialty_revenue(star).select(*stored.columns)
        assert stored.exceptAll(whole).count() == 0 and whole.exceptAll(stored).count() == 0
    after = files(path)
    stay = {f for f in before if not any(m in f for m in ("year=2020/month=3/", "year=2021/month=7/", "year=2020/month=12/"))}
    assert stay and all(after.get(f) == before[f] for f in stay)
    assert not set(before) - stay & set(after)


def test_one_row_of_a_table(spark):
    df = spark.range(1000).withColumnRenamed("id", "k").withColumn("v", F.col("k") * 2)
    rows = {sample_one(df.repartition(n), "k", 7).first() for n in (1, 3, 8)}
    assert len(rows) == 1 and rows.pop().asDict()["v"] % 2 == 0
    assert len({sample_one(df, "k", seed).first().k for seed in range(6)}) > 3
    assert sample_one(df.limit(0), "k", 7).count() == 0
