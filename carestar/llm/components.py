"""Connected components by alternating star contraction, one shared table per round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carestar.llm.store import materialize


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct()
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def connected_components(edges: DataFrame, name: str = "components") -> DataFrame:
    """``edges`` (u, v: long) to one row (node, root) per node that has an edge; the root is the smallest node.

    Self-loops and repeated edges are ignored; rows with a null are dropped.
    """
    def state(df):
        row = df.agg(F.count("*").alias("n"), F.sum(F.hash("u", "v").cast("decimal(20,0)")).alias("s")).first()
        return row["n"], row["s"]

    current = materialize(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                          .distinct(), name)
    before = state(current)
    while before[0]:
        current = materialize(_small_star(_large_star(current)), name)
        after = state(current)
        if after == before:
            break
        before = after
    roots = current.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.union(current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
