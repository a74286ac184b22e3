"""Sparse logistic regression trained with follow-the-regularised-leader updates, in shards of a bounded sample."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carestar.llm.store import materialize

BITS = 18                  # hash space of the features
SHARD_ROWS = 2500          # rows that one shard is trained on, one after the other
EPOCHS = 10
ALPHA, BETA, L1, L2 = 2.0, 1.0, 0.0005, 0.0
MAX_TRAIN = 20_000         # labelled rows that a model is fitted on (about; picked by a hash of doc_id)
FOLDS, HELD_OUT = 5, 0


def fold(doc_id: Column) -> Column:
    """The fold that no label is learned from is fold 0."""
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS


def bounded(labels: DataFrame, max_rows: int = MAX_TRAIN) -> DataFrame:
    """A sample of about ``max_rows`` rows by a hash of doc_id (all rows when there are fewer)."""
    n = labels.count()
    share = 1 << 30 if n <= max_rows else int((1 << 30) * max_rows / n)
    return labels.where(F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 30)) < share)


def labelled(docs: DataFrame, labels: DataFrame, label: str, max_rows: int = MAX_TRAIN) -> DataFrame:
    """doc_id, text, y of the training folds: a bounded sample, so its ids may be broadcast. Of several labels the largest counts."""
    rows = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("double").alias("y"))
            .where("doc_id is not null and y is not null").where(fold(F.col("doc_id")) != HELD_OUT)
            .groupBy("doc_id").agg(F.max("y").alias("y")))
    ids = materialize(bounded(materialize(rows, "labels"), max_rows), "sample")
    return materialize(docs.join(F.broadcast(ids), "doc_id"), "train")


def unit_rows(rows: np.ndarray, hashes: np.ndarray, n_rows: int, bits: int = BITS):
    """Sparse rows of square-root counts scaled to length 1: offsets, feature numbers, values."""
    keys, counts = np.unique(rows.astype(np.uint64) << np.uint64(bits) | hashes >> np.uint64(64 - bits), return_counts=True)
    row = (keys >> np.uint64(bits)).astype(np.int64)
    starts = np.searchsorted(row, np.arange(n_rows + 1))
    total = np.bincount(row, counts, n_rows)
    return starts, (keys & np.uint64((1 << bits) - 1)).astype(np.int64), np.sqrt(counts / total[row])


def weights_of(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    shrunk = np.sign(z) * np.maximum(np.abs(z) - L1, 0)
    return -shrunk / ((BETA + np.sqrt(n)) / ALPHA + L2)


def ftrl(starts, index, value, y, size: int, epochs: int = EPOCHS) -> np.ndarray:
    """Weights after per-coordinate updates, one example at a time; the last weight is the bias. Labels may be soft."""
    z, n = np.zeros(size + 1), np.zeros(size + 1)
    order = np.arange(len(y))
    for _ in range(epochs):
        for i in order.tolist():
            a, b = starts[i], starts[i + 1]
            at, x = np.append(index[a:b], size), np.append(value[a:b], 1.0)
            w = weights_of(z[at], n[at])
            p = 1 / (1 + np.exp(-np.clip(w @ x, -35, 35)))
            g = (p - y[i]) * x
            grown = n[at] + g * g
            z[at] += g - (np.sqrt(grown) - np.sqrt(n[at])) / ALPHA * w
            n[at] = grown
    return weights_of(z, n)


def train(sample: DataFrame, features: Callable, size: int) -> np.ndarray:
    """Mean of the weights that each shard of ``sample`` (doc_id, text, y, maybe more) arrives at.

    ``features(table)`` gives offsets, feature numbers and values of the table's rows. The sample is bounded, and
    so is what comes back: a vector for each shard.
    """
    def fit(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by("order")
        starts, index, value = features(table)
        w = ftrl(starts, index, value, table.column("y").to_numpy(), size)
        return pa.table({"n": pa.array([table.num_rows], pa.int64()), "w": pa.array([w.astype("<f4").tobytes()], pa.binary())})

    shards = max(1, round(sample.count() / SHARD_ROWS))
    dealt = (sample.withColumn("order", F.xxhash64("doc_id", "text"))
             .withColumn("shard", F.pmod(F.col("order"), F.lit(shards))))
    parts = dealt.groupBy("shard").applyInArrow(fit, "n long, w binary").collect()
    if not parts:
        return np.zeros(size + 1, np.float32)
    return np.average([np.frombuffer(p["w"], "<f4") for p in parts], axis=0, weights=[p["n"] for p in parts]).astype(np.float32)


def score(starts, index, value, w: np.ndarray) -> np.ndarray:
    """Probability of label 1 for each sparse row."""
    c = np.concatenate([[0.0], np.cumsum(w[index].astype(np.float64) * value)])
    return 1 / (1 + np.exp(-np.clip(c[starts[1:]] - c[starts[:-1]] + float(w[-1]), -35, 35)))
