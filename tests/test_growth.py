"""What keeps the work of the larger queries in proportion to their input: plans, stored tables, folders, partitions."""

import os
from types import SimpleNamespace

from pyspark.sql import functions as F

from carestar import session
from carestar.operators import batches as B
from carestar.operators import bridges as BR
from carestar.operators import fact as FA
from carestar.operators import quality as QC
from carestar.plans import catalog
from carestar.plans import questions as Q
from carestar.sources import sinks

from conftest import SF


def shape(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_links_are_stored_once(spark):
    b = catalog.build(spark, SF)
    assert b.bridge_diagnoses.count() and b.bridge_procedures.count() and b.errors.count()
    here = set(sinks.folder_names(spark, b.store)) | set(sinks.folder_names(spark, os.path.join(os.path.dirname(b.store), "oltp")))
    assert not here & {"resolved_diagnoses", "resolved_procedures", "encounter_diagnoses", "encounter_procedures"}


def test_procedures_are_numbered_where_their_encounter_lies(spark):
    df = spark.createDataFrame
    lookup = df([(1, 11, 2), (1, 12, 2), (2, 13, 1)], "encounter_id long, encounter_key long, procedure_count int")
    links = df([(5, 1, 7, "2000-01-02"), (6, 1, 8, "2000-01-01"), (7, 2, 7, "2000-01-01"), (8, 3, 7, "2000-01-01")],
               "encounter_procedure_id long, encounter_id long, procedure_id long, procedure_date string")
    dim = df([(7, 70), (8, 80)], "procedure_id long, procedure_key long")
    resolved = BR.resolve_links(links, lookup.hint("merge"), F.broadcast(dim), "procedure_id", "procedure_key")
    for largest in (None, 2):
        bridge = BR.build_bridge_procedures(resolved, largest)
        assert sorted((r.encounter_key, r.procedure_key, r.procedure_sequence) for r in bridge.collect()) == [
            (11, 70, 2), (11, 80, 1), (12, 70, 2), (12, 80, 1), (13, 70, 1)]
    assert shape(bridge).split("Initial Plan")[-1].count("Exchange hashpartitioning") == 2          # the two sides of the join


def test_link_rejects_in_one_pass(spark):
    df = spark.createDataFrame
    resolved = df([(1, 5, None, 7, None), (2, 5, 50, 7, None), (3, 5, 50, 7, 70), (4, None, None, None, None), (5, 6, 60, None, None)],
                  "encounter_diagnosis_id long, encounter_id long, encounter_key long, diagnosis_id long, diagnosis_key long")
    got = BR.diagnosis_rejects(resolved)
    assert sorted((r.source_id, r.error_type, r.error_message, r.field_name, r.field_value) for r in got.collect()) == [
        (1, "ORPHAN_DIAGNOSIS", "Encounter 5 not in fact table", "encounter_id", "5"),
        (2, "MISSING_DIAGNOSIS_KEY", "Diagnosis 7 not found", "diagnosis_id", "7"),
        (4, "ORPHAN_DIAGNOSIS", None, "encounter_id", None), (5, "MISSING_DIAGNOSIS_KEY", None, "diagnosis_id", None)]
    assert "Union" not in shape(got)


def test_partitions_follow_the_source(spark):
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    before = spark.conf.get(key, None)
    try:
        session.size_shuffles(spark, 1 << 20)
        assert spark.conf.get(key) == spark.conf.get("spark.sql.shuffle.partitions")
        session.size_shuffles(spark, 4000 << 20)
        assert int(spark.conf.get(key)) == 1000 == session.partitions_of(4000 << 20)
        assert spark.range(1000).repartition("id").rdd.getNumPartitions() <= 1000
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def test_names_only_for_the_first_pairs(spark):
    """Ties go by the names, whose order is not that of the ids; ids and names may be null or come twice."""
    dx = [(1, "Z", "z"), (2, "A", "b"), (3, "A", "a"), (4, None, "n"), (5, "A", "a"), (6, "M", "m"), (6, "M", "m"), (None, "K", "k")]
    px = [(7, "9", "q"), (8, "10", "q"), (9, "10", None)]
    dl = [(e, d) for e in range(6) for d in (1, 2, 3, 4, 5, 6)]
    pl = [(e, p) for e in range(6) for p in (7, 8, 9) if (e + p) % 2 or p == 8]
    df = spark.createDataFrame
    oltp = {"diagnoses": df(dx, "diagnosis_id long, icd10_code string, icd10_description string"),
            "procedures": df(px, "procedure_id long, cpt_code string, cpt_description string"),
            "encounter_diagnoses": df(dl, "encounter_id long, diagnosis_id long"),
            "encounter_procedures": df(pl, "encounter_id long, procedure_id long")}
    counts = {}
    for e, d in dl:
        for (i, *dn) in dx:
            for e2, p in pl:
                for (j, *pn) in px:
                    if i == d and j == p and e == e2:
                        counts[(*dn, *pn)] = counts.get((*dn, *pn), 0) + 1
    rows = [(*k, n) for k, n in counts.items() for _ in range(2 if k[0] == "M" else 1)]      # a name of two rows comes twice
    rows.sort(key=lambda r: (-r[4], *[(v is not None, v or "") for v in r[:4]]))
    for n in (3, 7, 100):
        got = Q.q2_oltp(oltp, n)
        assert [tuple(r) for r in got.collect()] == rows[:n]
    assert shape(got).count("TakeOrderedAndProject") >= 2


def test_keys_and_measures_are_not_broadcast(spark):
    b = catalog.build(spark, SF)
    ready = FA.loadable(b.resolved_encounters)
    keys = ready.select("encounter_id", F.col("encounter_id").alias("encounter_key"))
    rows = FA.fact_rows(ready, keys, b.measures, "2025-01-01 02:00:00")
    assert rows.count() == ready.count()
    assert "Broadcast" not in shape(rows)


def test_differing_rows_in_one_pass(spark, monkeypatch):
    """Rows of one load only, rows of another value and rows that one load has twice, by range."""
    df = spark.createDataFrame
    kind = "encounter_id long, v string"
    a = df([(1, "a"), (2, "b"), (2, "b"), (3, "c"), (11, "k"), (12, None)], kind)
    whole = df([(1, "a", 0), (2, "b", 0), (3, "d", 0), (4, "e", 0), (12, None, 0)], kind + ", date_year int")
    marks = df([(0, 1, 10), (1, 11, 20), (2, 21, 30)], "range_no long, range_start long, range_end long")
    monkeypatch.setattr(catalog, "_batched", lambda s, d: (SimpleNamespace(fact=whole), "root"))
    monkeypatch.setattr(B, "loaded", lambda s, root: a)
    monkeypatch.setattr(B, "marks", lambda s, root: marks)
    got = catalog.batch_equivalence(spark, SF)
    assert sorted(tuple(r) for r in got.collect()) == [(0, 1, 10, 4), (1, 11, 20, 1), (2, 21, 30, 0)]
    assert "Generate" not in shape(got) and "NestedLoopJoin BuildRight, LeftOuter" not in shape(got)


def test_orphans_are_counted_per_key(spark):
    df = spark.createDataFrame
    bridge = df([(1,)] * 5 + [(2,)] * 3 + [(None,)] * 2, "encounter_key long")
    got = QC.orphans(bridge, df([(1,), (1,), (None,)], "encounter_key long"))
    assert got.first()["n"] == 5 and QC.orphans(bridge.limit(0), bridge).first()["n"] == 0
    under = shape(got).split("Initial Plan")[-1].split("LeftAnti")[1]
    assert "HashAggregate" in under


def test_a_wide_span_of_ids_makes_few_folders(spark, monkeypatch, tmp_path):
    bills = spark.range(0, 1200).select((F.col("id") * 60_000 + 17).alias("billing_id"),
                                        F.lit("10.00").cast("decimal(12,2)").alias("claim_amount"),
                                        F.lit("9.00").cast("decimal(12,2)").alias("allowed_amount"))
    monkeypatch.setattr(catalog, "_oltp", lambda s, d: {"billing": bills})
    monkeypatch.setattr(catalog, "_scratch", lambda s: str(tmp_path / "table"))
    got = catalog.range_replace_stored(spark, SF)
    low, high = 17, 1199 * 60_000 + 17
    lo, hi = low + (high - low) // 4, low + (high - low) // 2
    want = {i * 60_000 + 17: "8.00" if lo <= i * 60_000 + 17 <= hi else "9.00" for i in range(1200)}
    assert {r.billing_id: str(r.allowed_amount) for r in got.collect()} == want and got.count() == 1200
    assert len(sinks.folder_names(spark, str(tmp_path / "table"))) <= catalog.RANGE_FOLDERS + 1
