import datetime as dt
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from carestar.operators.keys import sequence_within, with_surrogate_key


def test_surrogate_key_equals_global_row_number(spark):
    rnd = random.Random(7)
    ids = sorted(rnd.sample(range(0, 200_000), 3000))          # gaps everywhere
    df = spark.createDataFrame([(i, f"n{i}") for i in rnd.sample(ids, len(ids))], "id long, name string")
    got = with_surrogate_key(df, "id", "k").select("id", "k").collect()
    want = {i: n + 1 for n, i in enumerate(ids)}
    assert {r.id: r.k for r in got} == want


def test_surrogate_key_clustered_ids_and_start(spark):
    ids = list(range(10)) + list(range(10**9, 10**9 + 500))     # one dense cluster far away
    df = spark.createDataFrame([(i,) for i in ids], "id long")
    got = with_surrogate_key(df, "id", "k", start=100).orderBy("id").collect()
    assert [r.k for r in got] == list(range(100, 100 + len(ids)))


def test_surrogate_key_empty(spark):
    df = spark.createDataFrame([], "id long")
    assert with_surrogate_key(df, "id", "k").count() == 0


def test_sequence_within_splits_large_groups(spark):
    rnd = random.Random(3)
    rows = []
    for enc in range(5):
        n = 400 if enc == 0 else rnd.randint(1, 6)               # encounter 0 is a hot group
        for j in range(n):
            d = None if j % 97 == 0 else dt.date(2024, 1, 1) + dt.timedelta(days=rnd.randint(0, 3))
            rows.append((enc, d, enc * 10_000 + j * 7 + rnd.randint(0, 6)))
    df = spark.createDataFrame(rows, "e long, d date, id long").dropDuplicates(["id"])
    want = df.withColumn("seq", F.row_number().over(Window.partitionBy("e").orderBy("d", "id")))
    b = {(r.id, r.seq) for r in want.collect()}
    for hot_rows in (50, 1 << 20):                 # encounter 0 hot / everything on the plain path
        got = sequence_within(df, ["e"], ["d", "id"], "seq", split_on="id", split_width=16, hot_rows=hot_rows)
        assert {(r.id, r.seq) for r in got.collect()} == b


def test_one_outlier_does_not_fill_one_part(spark):
    """200,000 ids and one far away: the parts that are numbered on their own stay small."""
    from carestar.operators.keys import number_keys
    df = spark.range(200_000).withColumnRenamed("id", "k").unionByName(
        spark.createDataFrame([(9_000_000_000_000_000_000,), (-9_000_000_000_000_000_000,)], "k long"))
    out = number_keys(df, "k", "n")
    assert out.agg(F.min("n"), F.max("n"), F.count_distinct("n")).first() == (1, 200_002, 200_002)
    parts = df.repartitionByRange(8, "k").groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert parts < 60_000


def test_lines_of_a_long_order_get_ids_of_their_own(spark):
    from carestar.sources.adapter import numbered_lines
    rows = [(o, i % 7, i % 5, 1, float(i), 1.0, 0.0, 0.0, "N", "O", dt.date(2024, 1, 1)) for o, n in ((1, 150), (2, 3), (3, 1))
            for i in range(n)]
    lines = spark.createDataFrame(rows + rows[:2], "l_orderkey long, l_partkey long, l_linenumber long, l_suppkey long, "
                                  "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                                  "l_returnflag string, l_linestatus string, l_shipdate date")
    got = numbered_lines(lines).collect()
    assert len({r.line_id for r in got}) == len(got) == 156
    assert sorted(r.rn for r in got if r.l_orderkey == 1) == list(range(1, 153))
