"""Plan shape of the questions on a written star (what ``explain`` must show at scale)."""

import os
import tempfile

import pytest

from carestar.plans import questions as Q
from carestar.plans.pipeline import run_pipeline
from carestar.plans.star import TEST_PARAMS as P
from carestar.schemas import OLTP
from carestar.sources import sinks
from carestar.sources.adapter import oltp_from_driver

from conftest import SF

STAR = ["dim_date", "dim_patient", "dim_provider", "dim_specialty", "dim_department", "dim_encounter_type",
        "dim_diagnosis", "dim_procedure", "fact_encounters", "bridge_encounter_diagnoses",
        "bridge_encounter_procedures"]


@pytest.fixture(scope="module")
def models(spark):
    base = tempfile.mkdtemp(prefix="carestar-plans-")
    for n, df in oltp_from_driver(spark, SF).items():
        sinks.write_table(df, os.path.join(base, "oltp", n))
    oltp = {n: spark.read.parquet(os.path.join(base, "oltp", n)) for n in OLTP}
    run_pipeline(spark, oltp, os.path.join(base, "star"), P, batch_id="PLANS", publish_failed=True)
    star = {n: sinks.read_star(spark, os.path.join(base, "star"), n) for n in STAR}
    return oltp, star


def plan(df) -> str:
    df.collect()                                   # final adaptive plan
    return df._jdf.queryExecution().executedPlan().toString()


def questions(oltp, star):
    return {"q1_oltp": Q.q1_oltp(oltp, P.since), "q1_star": Q.q1_star(star, P.since_year),
            "q2_oltp": Q.q2_oltp(oltp), "q2_star": Q.q2_star(star),
            "q3_oltp": Q.q3_oltp(oltp, P.since), "q3_star": Q.q3_star(star, P.since_year),
            "q4_oltp": Q.q4_oltp(oltp, P.since), "q4_star": Q.q4_star(star, P.since_year)}


def test_no_pair_explosion(models):
    for name, df in questions(*models).items():
        text = plan(df)
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name


def test_star_scans_prune_partitions_and_columns(models):
    oltp, star = models
    for name in ("q1_star", "q4_star"):
        df = questions(oltp, star)[name]
        text = df._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(date_year" in text and "(date_year" in text, name
        assert "etl_loaded_date" not in text and "discharge_date" not in text, name   # column pruning
        assert "BroadcastHashJoin" in text, name


def test_filters_reach_the_scan(models):
    oltp, _ = models
    text = Q.q4_oltp(oltp, P.since)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(claim_status), EqualTo(claim_status,Paid)" in text
    assert "GreaterThanOrEqual(encounter_date" in text


REGISTERED = ["q1_oltp", "q1_star", "q2_oltp", "q2_star", "q3_oltp", "q3_star", "q4_oltp", "q4_star", "monthly_revenue_agg",
              "diagnosis_counts", "dq_revenue", "union_distinct", "error_records"]


def test_registered_queries_scan_pruned_files(spark):
    """The plans of ``queries()`` itself: files, not copies in row form; filters and columns reach the scan."""
    import __spark_entry__ as E
    text = {n: E.queries()[n](spark, SF)._jdf.queryExecution().executedPlan().toString() for n in REGISTERED}
    assert not any("ExistingRDD" in t for t in text.values())
    assert "PartitionFilters: [isnotnull(date_year" in text["q1_star"] and "total_claim_amount" not in text["q1_star"]
    assert "EqualTo(claim_status,Paid)" in text["q4_oltp"] and "claim_date" not in text["q4_oltp"]
    assert "GreaterThanOrEqual(encounter_date" in text["q1_oltp"] and "EqualTo(encounter_type,Inpatient)" in text["q3_oltp"]


def test_a_star_question_builds_no_bridge(spark, tmp_path):
    import os
    from carestar.plans.star import LazyTables, StarBuild
    from carestar.sources.adapter import oltp_makers
    store = str(tmp_path)
    build = StarBuild(spark, LazyTables(oltp_makers(spark, SF), os.path.join(store, "oltp")), P, os.path.join(store, "star"))
    assert Q.q1_star(build.tables(), P.since_year).count() == 10
    assert "fact_encounters" in os.listdir(os.path.join(store, "star"))
    assert not any(t.startswith("bridge") for t in os.listdir(os.path.join(store, "star")))
    assert "encounter_procedures" in os.listdir(os.path.join(store, "oltp"))          # the fact counts them


def test_bucketed_tables_are_joined_where_they_lie(spark, models):
    """Co-occurrence and the fact-to-link join on tables in buckets of the encounter key: no exchange below the joins."""
    from carestar.sources.bucketed import bucketed_star, drop_bucketed
    star = models[1]
    stored = bucketed_star(spark, star, tempfile.mkdtemp(prefix="carestar-buckets-"), "plans_test", 8)
    try:
        a, b = Q.q2_star(star), Q.q2_star(stored)
        assert [tuple(r) for r in a.collect()] == [tuple(r) for r in b.collect()]
        assert _encounter_exchanges(plan(a)) > 0 and _encounter_exchanges(plan(b)) == 0
        links = stored["bridge_encounter_diagnoses"].groupBy("encounter_key").count()
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        joined = stored["fact_encounters"].select("encounter_key", "diagnosis_count").join(links, "encounter_key", "left")
        assert "Exchange" not in plan(joined)
        assert joined.filter("coalesce(count, 0) > diagnosis_count").count() == 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        drop_bucketed(spark, "plans_test")


def _encounter_exchanges(text: str) -> int:
    """Shuffles by the encounter key in a plan."""
    return sum("Exchange hashpartitioning(encounter_key" in line for line in text.splitlines())
