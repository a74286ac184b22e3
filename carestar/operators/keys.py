"""P1 / W1 — surrogate keys and ordered sequences without a single-task window.

``ROW_NUMBER() OVER (ORDER BY id)`` would pull the whole table into one task.
``with_surrogate_key`` range-partitions the ids alone (Spark samples the bounds,
so outliers and gaps do not matter), keeps that cut as a narrow table, numbers
each part on its own and shifts it by the running sum of the parts' counts — a
row per part, hence safe to broadcast. The numbers equal the global row number,
so they depend neither on the bounds nor on the run.

``sequence_within`` numbers inside groups (lines of an order, procedures of an
encounter) with one window; only groups above ``hot_rows`` rows are cut into
sub-groups along the order, so one huge group is numbered by many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from carestar.sources.sinks import scratch_table

BEFORE = (Window.unboundedPreceding, -1)


def number_keys(keys: DataFrame, key: str, name: str, start: int = 1) -> DataFrame:
    """``key`` and its dense number from ``start`` on, in key order. Keys are unique, integral and not null."""
    parts = scratch_table(keys.select(key).repartitionByRange(key).withColumn("_part", F.spark_partition_id()), "keys")
    counts = parts.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    # one row per part
    shift = counts.select("_part", (F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(*BEFORE)), F.lit(0))
                                    + F.lit(start - 1)).alias("_shift"))
    local = F.row_number().over(Window.partitionBy("_part").orderBy(key))
    return (parts.withColumn("_local", local).join(F.broadcast(shift), "_part")
            .select(key, (F.col("_shift") + F.col("_local")).cast("long").alias(name)))


def with_surrogate_key(df: DataFrame, natural_key: str, name: str, start: int = 1) -> DataFrame:
    """Dense key ``start, start+1, ...`` in natural-key order (``AUTO_INCREMENT`` on load).

    ``natural_key`` must be an integral, unique, non-null column; any value range will do.
    """
    return df.join(number_keys(df, natural_key, name, start), natural_key).select(name, *df.columns)


def sequence_within(df: DataFrame, partition_by: list[str], order_by: list[str], name: str,
                    split_on: str, split_width: int = 1 << 16, hot_rows: int = 1 << 20,
                    size: Column | None = None, largest: int | None = None) -> DataFrame:
    """``ROW_NUMBER() OVER (PARTITION BY p ORDER BY o...)`` that never gives one task a huge group.

    ``size`` is the number of rows of a row's group where the caller has it at hand (it may be too
    large, not too small); otherwise groups are counted by one partially aggregated pass over the
    key columns. Groups above ``hot_rows`` are numbered in sub-groups: the ordering columns before
    ``split_on`` (an integral ordering column) and ``split_on`` div ``split_width``. ``largest``: rows of the
    largest group (or more) where the caller knows it; if no group is huge, nothing is counted or looked for.
    """
    if largest is not None and largest <= hot_rows:
        return _plain_sequence(df, partition_by, order_by, name)
    if size is None:
        # at most rows / hot_rows groups; with none, adaptive execution drops the second branch
        hot = F.broadcast(df.groupBy(*partition_by).agg(F.count(F.lit(1)).alias("_size"))
                          .filter(F.col("_size") > hot_rows).select(*partition_by))
        normal, heavy = df.join(hot, partition_by, "left_anti"), df.join(hot, partition_by, "left_semi")
    else:
        is_hot = F.coalesce(size > hot_rows, F.lit(False))
        normal, heavy = df.filter(~is_hot), df.filter(is_hot)
    return _plain_sequence(normal, partition_by, order_by, name).select(*df.columns, name).unionByName(
        _split_sequence(heavy, partition_by, order_by, name, split_on, split_width))


def _plain_sequence(df: DataFrame, partition_by: list[str], order_by: list[str], name: str) -> DataFrame:
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*partition_by).orderBy(*order_by)).cast("int"))


def _split_sequence(df: DataFrame, partition_by: list[str], order_by: list[str], name: str,
                    split_on: str, split_width: int) -> DataFrame:
    """Sub-groups are (p, ordering columns before ``split_on``, ``split_on`` div width): each is numbered
    on its own and shifted by the rows of the sub-groups before it."""
    lead = order_by[:order_by.index(split_on)]
    cut = df.withColumn("_sub", F.floor(F.col(split_on) / F.lit(split_width)).cast("long"))
    group = [*partition_by, *lead, "_sub"]
    counts = cut.groupBy(*group).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*partition_by).orderBy(*lead, "_sub").rowsBetween(*BEFORE)
    shift = counts.select(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(group)],
                          F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_shift"))
    numbered = cut.withColumn("_local", F.row_number().over(Window.partitionBy(*group).orderBy(*order_by)))
    same = [numbered[c].eqNullSafe(shift[f"_o{i}"]) for i, c in enumerate(group)]     # ordering columns may be null
    return numbered.join(shift, same).select(*df.columns, (F.col("_shift") + F.col("_local")).cast("int").alias(name))
