"""Driver contract: entry runs, every query has an oracle, and a sample matches DuckDB at sf0.001."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from tools.check_oracle import TABLES, digest, norm

from conftest import SF

SAMPLE = ["q1_oltp", "q2_star", "q3_oltp", "q3_star", "q4_oltp", "fact_encounters", "bridge_procedures",
          "error_records", "dq_report", "batch_status", "batch_equivalence", "step_details", "run_status",
          "resolve_errors", "dq_unique"]


def test_entry_runs(spark):
    rows = E.entry(spark).collect()
    assert len(rows) >= 3 and all(r.total_inpatient_discharges >= 10 for r in rows)
    rates = [(-r.readmission_rate_pct, r.specialty_name) for r in rows]
    assert rates == sorted(rates)
    assert E.entry(spark).columns == ["specialty_name", "total_inpatient_discharges",
                                      "readmissions_within_30_days", "readmission_rate_pct"]


@pytest.mark.parametrize("name", [f"q{i}_{m}" for i in range(1, 5) for m in ("oltp", "star")])
def test_rows_of_the_questions_come_in_order(spark, name):
    """The answers are ordered lists: row by row, as the SQL orders them."""
    con = duckdb.connect()
    for t in TABLES:
        if os.path.exists(p := os.path.join(SF, f"{t}.parquet")):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    df = E.queries()[name](spark, SF)
    order = " ORDER BY readmission_rate_pct DESC, specialty_name" if name.startswith("q3") else ""      # the others end in theirs
    cur = con.execute(E.oracle_sql()[name] + order)
    at = [[d[0] for d in cur.description].index(c) for c in df.columns]
    rows = [tuple(norm(v) for v in r) for r in df.collect()]
    want = [tuple(norm(r[i]) for i in at) for r in cur.fetchall()]
    assert rows and rows == want


def test_every_query_has_an_oracle():
    from carestar.plans import catalog
    assert set(E.oracle_sql()) <= set(E.queries())
    assert set(catalog.QUERIES) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", SAMPLE)
def test_oracle_sample(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(SF, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    df = E.queries()[name](spark, SF)
    cur = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(ocols)
    assert digest(df.columns, [tuple(r) for r in df.collect()])[0] == digest(ocols, cur.fetchall())[0]
