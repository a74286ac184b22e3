"""Corpus-wide lookups of window hashes by blocks of documents.

Documents are dealt to blocks of bounded size; a block sends each distinct hash
once (so however often a passage is repeated, a bucket hears of it once per
block), buckets own ranges of the hash space and answer to the blocks that
asked. Blocks and buckets are ordinary group keys, and their number follows the
size of the table.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carestar.llm.store import documents

BLOCK_BYTES = 8 << 20
LEAST_BLOCKS = 24


def blocked(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> tuple[DataFrame, int]:
    """block, doc_id, text, and the number of blocks. Rows are dealt by id and text, so null ids spread too."""
    base = documents(docs)
    total = base.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    n = max(LEAST_BLOCKS, math.ceil(total / block_bytes))
    return base.select(F.pmod(F.xxhash64("doc_id", "text"), F.lit(n)).cast("int").alias("block"), "doc_id", "text"), n


def pack(values: np.ndarray) -> bytes:
    """64-bit values with their bytes transposed: equal high bytes then lie together, which shuffles compress."""
    return np.ascontiguousarray(values.astype(np.uint64).view(np.uint8).reshape(-1, 8).T).tobytes()


def unpack(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).reshape(-1).view(np.uint64)


def bucket_bounds(hashes: np.ndarray, n: int) -> np.ndarray:
    """Where each bucket's range starts in sorted hashes."""
    edges = np.array([(i << 64) // n for i in range(n)], np.uint64)
    return np.append(np.searchsorted(hashes, edges), len(hashes))


def to_buckets(block: int, hashes: np.ndarray, columns: dict[str, np.ndarray], n: int) -> pa.Table:
    """One row per bucket that owns some of the (sorted, distinct) hashes."""
    at = bucket_bounds(hashes, n)
    full = np.flatnonzero(at[1:] > at[:-1]).tolist()
    data = {"bucket": pa.array(full, pa.int32()), "block": pa.array([block] * len(full), pa.int32())}
    for name, values in {"hash": hashes, **columns}.items():
        data[name] = pa.array([pack(values[at[b]:at[b + 1]]) for b in full], pa.binary())
    return pa.table(data)


def column(table: pa.Table, name: str) -> np.ndarray:
    """All values of a packed column, in row order."""
    parts = [unpack(x) for x in table.column(name).to_pylist()]
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64)


def grouped(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sort order of the keys, the start of each distinct key in it, and the distinct keys."""
    order = np.argsort(keys, kind="stable")
    sorted_keys = keys[order]
    starts = np.flatnonzero(np.concatenate([[True], sorted_keys[1:] != sorted_keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return order, starts, sorted_keys[starts]


def low_and_high(keys: list[np.ndarray], low: np.ndarray, high: np.ndarray) -> tuple[list[np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
    """Distinct rows of the keys, sorted, with the smallest ``low`` and the largest ``high`` of each; and where each row went."""
    if not len(low):
        return keys, low, high, np.zeros(0, np.int64)
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), bool)
    new[0] = True
    for k in keys:
        new[1:] |= k[order[1:]] != k[order[:-1]]
    starts = np.flatnonzero(new)
    at = np.empty(len(order), np.int64)
    at[order] = np.cumsum(new) - 1
    return [k[order[starts]] for k in keys], np.minimum.reduceat(low[order], starts), np.maximum.reduceat(high[order], starts), at


def position(needles: np.ndarray, hay: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of each needle in the sorted array ``hay`` and whether it is there."""
    if not len(hay):
        return np.zeros(len(needles), np.int64), np.zeros(len(needles), bool)
    at = np.minimum(np.searchsorted(hay, needles), len(hay) - 1)
    return at, hay[at] == needles
