import random

import helpers as H
from carestar.llm.components import connected_components


def test_equals_union_find(spark):
    rnd = random.Random(7)
    edges = [(rnd.randint(0, 150), rnd.randint(0, 150)) for _ in range(110)]
    edges += [(i, i + 1) for i in range(200, 260)] + [(300, i) for i in range(301, 330)] + [(5, 5), edges[0]]
    got = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    linked = [(a, b) for a, b in edges if a != b]
    assert got == H.components({x for e in linked for x in e}, linked)


def test_no_edges(spark):
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0
