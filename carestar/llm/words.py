"""Vectorised word splitting shared by the operators (Arrow and numpy, inside tasks)."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 4 << 20
_BASE = 0x9E3779B97F4A7C15


def chunks(batches, column: str = "text", max_bytes: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that the texts of one piece take about ``max_bytes`` (a longer text is a piece of its own)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        start, total = 0, 0
        for i, n in enumerate(sizes):
            if i > start and total + n > max_bytes:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += int(n)
        yield batch.slice(start)


@dataclass
class Words:
    """Word ``k`` of text ``i`` is ``vocab[ids[starts[i] + k]]``."""

    starts: np.ndarray
    ids: np.ndarray
    vocab: pa.Array

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.starts)

    @property
    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.starts) - 1), self.counts)

    def sums(self, per_word: np.ndarray) -> np.ndarray:
        """Per text, the sum of a value given for each word position."""
        c = np.concatenate([np.zeros(1, per_word.dtype), np.cumsum(per_word)])
        return c[self.starts[1:]] - c[self.starts[:-1]]


def text_column(batch: pa.RecordBatch, column: str = "text") -> pa.Array:
    return pc.fill_null(batch.column(column).cast(pa.string()), "")


def split_words(texts: pa.Array) -> Words:
    """Words ``[^\\x20\\x09-\\x0D]+`` of each text (null: none), numbered within this piece."""
    lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    flat = lists.flatten().dictionary_encode()
    starts = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))]).astype(np.int64)
    ids, vocab = flat.indices.to_numpy(zero_copy_only=False).astype(np.int64), flat.dictionary
    empty = pc.index(vocab, "").as_py() if len(vocab) else -1
    if empty >= 0:
        keep = ids != empty
        starts = np.concatenate([[0], np.cumsum(keep)]).astype(np.int64)[starts]
        ids = ids[keep]
    return Words(starts, ids, vocab)


def windows(w: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Start positions of all ``size``-word windows that lie within one text, and the text of each."""
    per_text = np.maximum(w.counts - size + 1, 0)
    rows = np.repeat(np.arange(len(per_text)), per_text)
    first = np.concatenate([[0], np.cumsum(per_text)])[:-1]
    return np.arange(per_text.sum()) - np.repeat(first - w.starts[:-1], per_text), rows


def hash_words(vocab: pa.Array) -> np.ndarray:
    """A 64-bit hash of each word, the same in every task: the sum of a random value for each byte at its place."""
    words = pa.concat_arrays([vocab.cast(pa.large_binary())])
    if not len(words):
        return np.zeros(0, np.uint64)
    ends = np.frombuffer(words.buffers()[1], np.int64)[words.offset:words.offset + len(words) + 1]
    data = words.buffers()[2]
    data = np.frombuffer(data, np.uint8)[ends[0]:ends[-1]] if data is not None else np.zeros(0, np.uint8)
    ends = ends - ends[0]
    sizes = np.diff(ends)
    place = np.arange(len(data)) - np.repeat(ends[:-1], sizes)
    with np.errstate(over="ignore"):
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(place * 256 + data + 1))])
        return mix(sums[ends[1:]] - sums[ends[:-1]] + sizes.astype(np.uint64) * np.uint64(_BASE))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser over 64 bits."""
    x = x.astype(np.uint64, copy=True)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(factor)
    x ^= x >> np.uint64(31)
    return x


def rolling(values: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` consecutive values: element ``i`` covers ``values[i:i + size]``."""
    n = len(values)
    if n < size:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(values) * _powers(_BASE, n))])
        return mix((sums[size:] - sums[:n - size + 1]) * _powers(pow(_BASE, -1, 1 << 64), n - size + 1))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out)
