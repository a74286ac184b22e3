"""Audit of how filters interact, for every order in which they can be applied.

Each document gets a mask of the filters it fails. Counts by part and mask (the
cells) are all that the audit needs: a Gray-code walk over the filter sets
toggles one filter at a time, keeps for each mask the number of active filters
that it fails, and moves a cell out of or back into the running survivors when
that number leaves or reaches zero. The survivors of all ``2 ** n`` sets are
stored, and every step of every order is a difference of two of them.

Defined results: a null text is empty, a null part is the empty string. Labels of
a doc_id count once however often they are listed (1 if any row says so); without
a label a document is neither good nor toxic. Filter E compares texts by SHA-256:
a row fails it if its text also stands at a smaller doc_id. Rows without a doc_id
have no smaller one, do not fail it and have no labels. Repeated rows count each.
An empty table has no parts, so it gives no rows; further columns are left out.
"""

from __future__ import annotations

import hashlib
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carestar.llm.store import documents, materialize
from carestar.llm.words import chunks, split_words, text_column

MIN_WORDS = 50
MIN_DISTINCT_PCT = 65
MAX_CAPITALS_PCT = 5
SYMBOLS = r"[#$%&*|]"
LETTERS = "ABCDE"           # bit i of a mask: the document fails filter LETTERS[i]
MEASURES = ("docs", "good", "toxic")
PARTS_AT_ONCE = 64


def _distinct_words(w) -> np.ndarray:
    size = max(len(w.vocab), 1)
    found = np.unique(w.rows * size + w.ids) // size
    return np.bincount(found, minlength=len(w.starts) - 1)


def _flag(batches):
    for batch in chunks(batches):
        texts = text_column(batch)
        w = split_words(texts)
        chars = pc.utf8_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
        capitals = pc.count_substring_regex(texts, "[A-Z]").to_numpy(zero_copy_only=False).astype(np.int64)
        fails = [w.counts < MIN_WORDS, 100 * _distinct_words(w) < MIN_DISTINCT_PCT * w.counts,
                 100 * capitals > MAX_CAPITALS_PCT * chars,
                 pc.match_substring_regex(texts, SYMBOLS).to_numpy(zero_copy_only=False)]
        mask = sum(f.astype(np.int32) << i for i, f in enumerate(fails))
        digests = [hashlib.sha256(t.as_buffer()).digest() for t in texts]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("part"), pa.array(digests, pa.binary()),
                                          pa.array(mask, pa.int32())], names=["doc_id", "part", "digest", "mask"])


def flags(docs: DataFrame, part_col: str = "source") -> DataFrame:
    """doc_id, part, digest (of the text), mask (filters A to D) of every row."""
    base = documents(docs, part_col).toDF("doc_id", "text", "part").withColumn("part", F.coalesce(F.col("part").cast("string"), F.lit("")))
    return base.mapInArrow(_flag, "doc_id long, part string, digest binary, mask int")


def cells(flagged: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask (all filters) with its number of documents, good ones and toxic ones.

    Equal rows are counted before the labels are joined, and the rows of a text are added up before its smallest
    doc_id is looked for, so a text or an id that many rows share is one row by then.
    """
    key = ["doc_id", "part", "digest", "mask"]
    known = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max((F.col("quality") == 1).cast("long")).alias("good"), F.max((F.col("toxic") == 1).cast("long")).alias("toxic"))
    rows = flagged.where(F.col("doc_id").isNotNull()).groupBy(*key).agg(F.count("*").alias("docs")).join(known, "doc_id", "left").select(
        *key, "docs", *[(F.col("docs") * F.coalesce(c, F.lit(0))).alias(c) for c in MEASURES[1:]])
    nameless = flagged.where(F.col("doc_id").isNull()).groupBy(*key).agg(F.count("*").alias("docs")).select(
        *key, "docs", *[F.lit(0).cast("long").alias(c) for c in MEASURES[1:]])

    sums = [F.sum(c).alias(c) for c in MEASURES]
    head = F.min(F.struct("doc_id", *MEASURES)).alias("head")           # (doc_id, part, digest) is unique here
    texts = rows.groupBy("digest", "part", "mask").agg(*sums, head)
    least = materialize(texts, "texts")
    first = least.groupBy("digest").agg(F.min("head.doc_id").alias("first_id"))
    here = F.col("head.doc_id") == F.col("first_id")
    passing = [F.when(here, F.col(f"head.{c}")).otherwise(F.lit(0)).alias(c) for c in MEASURES]
    failing = [F.when(here, F.col(c) - F.col(f"head.{c}")).otherwise(F.col(c)).alias(c) for c in MEASURES]
    repeat = 1 << LETTERS.index("E")
    both = least.join(first, "digest").select("part", F.explode(F.array(
        F.struct("mask", *passing), F.struct(F.col("mask").bitwiseOR(F.lit(repeat)).alias("mask"), *failing))).alias("c"))
    counted = both.select("part", "c.*").where("docs > 0").unionByName(nameless.select("part", "mask", *MEASURES))
    return counted.groupBy("part", "mask").agg(*sums)


def gray_walk(masks: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Survivors of each of the ``2 ** n`` filter sets. ``values``: parts x masks x measures; result: sets x parts x measures."""
    failures = np.zeros(len(masks), np.int64)
    alive = values.sum(1)
    states = np.empty((1 << n, *alive.shape), values.dtype)
    states[0] = alive
    active = 0
    for i in range(1, 1 << n):
        bit = i & -i
        active ^= bit
        touched = (masks & bit) > 0
        if active & bit:
            moved = touched & (failures == 0)
            failures[touched] += 1
            alive = alive - values[:, moved].sum(1)
        else:
            failures[touched] -= 1
            moved = touched & (failures == 0)
            alive = alive + values[:, moved].sum(1)
        states[active] = alive
    return states


def _orders(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Every order of n filters and the set that is active before each of its steps."""
    orders = np.array(list(permutations(range(n))), np.int64).reshape(factorial(n), n)
    bits = 1 << orders
    return orders, np.cumsum(bits, 1) - bits


def _audit(letters: str):
    n = len(letters)

    def run(batches):
        orders, before = _orders(n)
        masks = np.arange(1 << n)
        names = ["".join(letters[f] for f in order) for order in orders]
        for batch in batches:
            for at in range(0, batch.num_rows, PARTS_AT_ONCE):
                piece = batch.slice(at, PARTS_AT_ONCE)
                parts = piece.column("part").to_pylist()
                values = np.zeros((len(parts), 1 << n, len(MEASURES)), np.int64)
                for i, found in enumerate(piece.column("cells").to_pylist()):
                    for c in found:
                        values[i, c["mask"]] = [c[m] for m in MEASURES]
                states = gray_walk(masks, values, n)
                bit = 1 << orders
                kept = states[before + bit]                              # orders x steps x parts x measures
                removed = states[before] - kept
                failing = (states[0] - states[1 << np.arange(n)])[orders][..., 0]
                full = (1 << n) - 1
                alone = (states[full ^ (1 << np.arange(n))] - states[full])[orders][..., 0]
                total = np.zeros((n, len(parts)), np.int64)
                np.add.at(total, orders.ravel(), removed[..., 0].reshape(-1, len(parts)))
                out = {"kept": kept[..., 0], "removed": removed[..., 0], "redundant": failing - removed[..., 0],
                       "unique_fails": alone, "good_lost": removed[..., 1], "toxic_lost": removed[..., 2], "shapley": total[orders]}
                steps = len(orders) * n
                yield pa.RecordBatch.from_pydict(
                    {"part": pa.array(np.repeat(parts, steps).tolist(), pa.string()),
                     "filter_order": pa.array([x for x in names for _ in range(n)] * len(parts), pa.string()),
                     "step": pa.array(np.tile(np.arange(1, n + 1), len(orders) * len(parts)), pa.int32())}
                    | {k: pa.array(v.reshape(steps, len(parts)).T.ravel(), pa.int64()) for k, v in out.items()})
    return run


def audit(counted: DataFrame, letters: str = LETTERS) -> DataFrame:
    """One row per part, order of the filters and step, from cells (part, mask, docs, good, toxic); bit i of a mask is ``letters[i]``."""
    by_part = counted.groupBy("part").agg(F.collect_list(F.struct("mask", *MEASURES)).alias("cells"))     # 2 ** n cells at most
    counts = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
    return by_part.mapInArrow(_audit(letters), "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in counts))


def filter_audit(docs: DataFrame, labels: DataFrame, part_col: str = "source") -> DataFrame:
    """The audit of the five filters over whole texts."""
    return audit(cells(materialize(flags(docs, part_col), "flags"), labels))
