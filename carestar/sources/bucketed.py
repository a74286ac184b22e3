"""J3 / J9 / J12 — encounter tables stored in buckets of the encounter key.

Tables that are joined by encounter lie in the same number of hash buckets, one
sorted file each, so their joins and the groupings that contain the key need no
exchange. The catalog knows the buckets; the files lie in a folder of the caller.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

CO_LOCATED = ("fact_encounters", "bridge_encounter_diagnoses", "bridge_encounter_procedures")


def write_bucketed(df: DataFrame, name: str, path: str, key: str, buckets: int) -> DataFrame:
    """Store ``df`` as table ``name`` with one file per bucket of ``key``. A key with a large share of the rows makes a large
    bucket, so this is for keys whose groups are small against the table, such as encounters."""
    df.repartition(buckets, key).write.mode("overwrite").bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(name)
    return df.sparkSession.table(name)


def bucketed_star(spark: SparkSession, star: dict, root: str, prefix: str, buckets: int) -> dict:
    """The star with its encounter tables in buckets of ``encounter_key`` under ``root``, as tables ``prefix_<name>``."""
    stored = {n: write_bucketed(star[n], f"{prefix}_{n}", os.path.join(root, n), "encounter_key", buckets) for n in CO_LOCATED}
    return dict(star) | stored


def drop_bucketed(spark: SparkSession, prefix: str) -> None:
    """Forget the tables of ``bucketed_star`` (their files stay)."""
    for n in CO_LOCATED:
        spark.sql(f"DROP TABLE IF EXISTS `{prefix}_{n}`")
