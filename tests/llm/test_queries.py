import ast
import os

import duckdb
import pytest

import __spark_entry__ as E
import corpus_pipeline
from carestar.llm import queries
from tools.check_oracle import TABLES, digest

SF = "/root/testdata/sf0.001"

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def test_all_operators_and_the_pipeline_are_registered():
    assert [n.split("_")[0] for n in queries.QUERIES] == [f"op{i}" for i in range(1, 14)]
    assert set(queries.QUERIES) | {"pipeline"} <= set(E.queries())
    assert set(queries.ORACLE_SQL) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        if os.path.exists(p := f"{SF}/{t}.parquet"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    df = E.queries()[name](spark, SF)
    cur = con.execute(E.oracle_sql()[name])
    cols = [d[0] for d in cur.description]
    assert sorted(cols) == sorted(df.columns)
    assert digest(df.columns, [tuple(r) for r in df.collect()])[0] == digest(cols, cur.fetchall())[0]


def test_nothing_else_imports_the_package():
    for folder, _, files in os.walk(ROOT):
        parts = os.path.relpath(folder, ROOT).split(os.sep)
        if "llm" in parts or parts[0].startswith(".git"):
            continue
        for f in files:
            if f.endswith(".py") and f not in ("corpus_pipeline.py", "__spark_entry__.py"):
                with open(os.path.join(folder, f)) as source:
                    for node in ast.walk(ast.parse(source.read())):
                        names = [a.name for a in node.names] if isinstance(node, ast.Import) else [node.module or ""] if isinstance(node, ast.ImportFrom) else []
                        assert not any("llm" in n or n == "corpus_pipeline" for n in names), (folder, f)


def test_pipeline_stages(spark):
    """Each stage over what the one before kept, against what the operators say about that input."""
    from carestar.llm import decontaminate, line_dedup, simhash, toxicity
    from carestar.llm.store import materialize
    docs = queries.table(spark, SF, "documents")
    labels, bench = queries.table(spark, SF, "labels"), queries.table(spark, SF, "benchmark")
    columns, ids = docs.columns, lambda df: {r["doc_id"] for r in df.select("doc_id").collect()}
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "line_dedup", "simhash_dedup", "decontaminate", "encode"]

    a = materialize(stages["toxicity"](spark, docs, SF), "t1")
    assert a.columns == columns
    assert ids(a) == ids(toxicity.toxicity_scores(docs, labels).where("predicted = 0"))
    b = materialize(stages["line_dedup"](spark, a, SF), "t2")
    assert b.columns == columns
    want = {r["doc_id"]: r["text"] for r in line_dedup.deduplicate(a).collect()}
    got = {r["doc_id"]: r for r in b.collect()}
    assert all(r["text"] == want[i] and r["n_chars"] == len(r["text"]) for i, r in got.items())
    assert all(not any(c.isalnum() for c in want[i]) for i in ids(a) - set(got))
    c = materialize(stages["simhash_dedup"](spark, b, SF), "t3")
    assert c.columns == columns
    assert ids(c) == ids(simhash.near_duplicates(b).where("doc_id = component_id"))
    d = materialize(stages["decontaminate"](spark, c, SF), "t4")
    assert d.columns == columns and ids(c) - ids(d) == ids(decontaminate.leaks(c, bench))
    e = stages["encode"](spark, d, SF)
    assert {r["doc_id"]: r["decoded"] for r in e.collect()} == {r["doc_id"]: r["text"] for r in d.collect()}
    assert ids(corpus_pipeline.run(spark, SF)) == ids(d)


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_take_awkward_and_empty_tables(spark, name):
    import helpers as H
    stage, last = dict(corpus_pipeline.STAGES)[name], corpus_pipeline.STAGES[-1][0]
    for docs, most in ((H.awkward(spark), len(H.AWKWARD)), (H.empty(spark), 0)):
        out = stage(spark, docs, SF)
        rows = out.collect()
        assert len(rows) <= most
        if name != last:
            assert out.columns == docs.columns
            clean = [i for i, t in H.AWKWARD if i in (7, 8, 11, 12, -5)] if most else []
            assert set(clean) <= {r["doc_id"] for r in rows}                # nothing is wrong with these
            given = {(i, t) for i, t in H.AWKWARD}
            if name != "line_dedup":
                assert {(r["doc_id"], r["text"]) for r in rows} <= given
