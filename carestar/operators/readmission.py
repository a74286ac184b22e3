"""J8 — 30-day readmissions as an interval join that never forms encounter pairs.

Question: for each index stay e1 (group g, patient p, discharge d), the
readmissions are the encounters e2 of the same patient with
``d < e2.t <= d + 30 days`` and ``e2 <> e1``; per group we need the distinct e2.

A self join on ``patient_id`` would compare every pair of a patient's
encounters, which for a patient holding a large share of the rows is quadratic.
Instead time is cut into buckets exactly one window long (W = 30 days). An
index stay in bucket k can only be matched in buckets k and k+1, and in each
only one bound is active:

* bucket k   : match iff ``e2.t > d``        (``t <= d + W`` holds automatically)
* bucket k+1 : match iff ``e2.t <= d + W``   (``t > d`` holds automatically)

So per (patient, group, bucket) only the smallest ``d`` of the stays of bucket k
and the largest ``d + W`` of those of bucket k - 1 matter, each with the stay it
comes from: one aggregation, with partial aggregation before the shuffle, however
many stays a patient has. Each candidate meets at most one bounds row per group of
its (patient, bucket): the fan-out is bounded by the number of groups, never by
the number of encounters. The totals come from the same bounds.

``e2 <> e1``: a stay can meet its own bound only if it starts after its own
discharge, which is a fault of the data. Where such a stay is itself the bound of
its group and nothing else decides, it is held against the group's other stays; as
that is one stay per bound at most, this too grows with the rows alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

EPOCH = "1970-01-01 00:00:00"


def time_bucket(ts, width_seconds: int):
    secs = F.timestamp_diff("SECOND", F.lit(EPOCH).cast("timestamp_ntz"), ts.cast("timestamp_ntz"))
    return F.floor(secs / F.lit(width_seconds)).cast("long")


def _rows(idx: DataFrame, days: int, width: int) -> DataFrame:
    """Two rows per stay: its lower bound in its own bucket, its upper bound in the next one."""
    kb = time_bucket(F.col("discharge"), width)
    pair = F.array(F.struct(F.lit(0).alias("kind"), kb.alias("kb"), F.col("discharge").alias("v")),
                   F.struct(F.lit(1).alias("kind"), (kb + 1).alias("kb"),
                            F.timestamp_add("DAY", F.lit(days), F.col("discharge")).alias("v")))
    return idx.select("patient", "grp", F.col("e1").alias("id"), F.explode(pair).alias("b")) \
        .select("patient", "grp", "b.kb", "b.v", "id", "b.kind")


def _bounds(rows: DataFrame) -> DataFrame:
    """Per (patient, grp, kb): the lower bound lv of stay lid, the upper bound hv of stay hid, and the stays."""
    low, high = F.when(F.col("kind") == 0, F.col("v")), F.when(F.col("kind") == 1, F.col("v"))
    return rows.groupBy("patient", "grp", "kb").agg(
        F.min(low).alias("lv"), F.min_by("id", low).alias("lid"), F.max(high).alias("hv"), F.max_by("id", high).alias("hid"),
        F.count(low).alias("stays"))


def readmission_counts(index_stays: DataFrame, candidates: DataFrame, days: int = 30) -> DataFrame:
    """Per group: ``index_stays`` (e1) and ``readmissions`` (distinct e2).

    index_stays: columns ``e1, patient, grp, discharge`` (discharge not null). candidates: columns ``e2, patient, t``.
    e1 and e2 are primary keys, so each (e2, group) meets one bounds row at most
    and plain counts are distinct counts.
    """
    width = days * 86400
    rows = _rows(index_stays, days, width)
    bounds = _bounds(rows)
    cand = candidates.select("e2", "patient", "t", time_bucket(F.col("t"), width).alias("kb")) \
        .filter(F.col("t").isNotNull() & F.col("patient").isNotNull())
    yes = lambda c: F.coalesce(c, F.lit(False))
    below, above = yes(F.col("lv") < F.col("t")), yes(F.col("hv") >= F.col("t"))
    other_low, other_high = F.col("lid") != F.col("e2"), F.col("hid") != F.col("e2")
    met = cand.join(bounds, ["patient", "kb"]).filter(below | above).withColumn(
        "sure", yes(below & other_low) | yes(above & other_high))
    hits = met.filter("sure").select("grp")
    mine = met.filter("NOT sure").select("e2", "t", *[F.col(k).alias(f"_{k}") for k in ("patient", "grp", "kb")])
    same = [rows[k].eqNullSafe(mine[f"_{k}"]) for k in ("patient", "grp", "kb")]
    reach = F.when(F.col("kind") == 0, F.col("v") < F.col("t")).otherwise(F.col("v") >= F.col("t"))
    rest = mine.join(rows, [*same, rows["id"] != mine["e2"], reach]).select("e2", "grp").distinct().select("grp")
    zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    marks = (bounds.select("grp", F.col("stays").alias("s"), zero.alias("r"))
             .unionByName(hits.unionByName(rest).select("grp", zero.alias("s"), one.alias("r"))))
    return marks.groupBy("grp").agg(F.sum("s").alias("index_stays"), F.sum("r").alias("readmissions"))
