"""Removal of word passages that repeat across documents, by level-wise doubling.

The first level looks at windows of BASE words, each further level at windows of
twice the length, the last at the full length. Of each full window only the one
shorter window with the smallest hash is sent (equal windows send the same), and
those that occur in one document alone are dropped: what repeats at one length
alone is extended to the next. A level without survivors ends the work. A longer
repeat consists of repeated windows of the full length, so doubling further
could not remove another word.

A window is removed when the same words start in a document with a smaller
doc_id, judged on the input. Full windows are told apart by two hashes of 64
bits each.

Defined results: a null or blank text has no words. Rows without a doc_id keep
all words and remove nothing elsewhere. Rows that repeat a doc_id are rows of
their own and do not remove from each other. Texts shorter than a window are
kept. An empty table gives an empty result; further columns are left out.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from carestar.llm.blocks import blocked, column, low_and_high, pack, position, to_buckets
from carestar.llm.store import materialize, release
from carestar.llm.words import Words, hash_words, mix, rolling, split_words, windows

WINDOW = 50
BASE = 25                      # words of the windows of the first level
SIGN = np.uint64(1 << 63)      # doc_ids are compared as unsigned values with the sign bit turned


def _ids(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Order-preserving unsigned doc_ids, and which rows have one."""
    raw = table.column("doc_id").combine_chunks()
    known = raw.is_valid().to_numpy(zero_copy_only=False)
    return raw.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64) ^ SIGN, known


def _sliding_min(values: np.ndarray, size: int) -> np.ndarray:
    """Minimum of each run of ``size`` values, by doubling."""
    out, span = values, 1
    while span * 2 <= size:
        out = np.minimum(out[:-span], out[span:])
        span *= 2
    rest = size - span
    return np.minimum(out[:len(out) - rest], out[rest:]) if rest else out


class _Block:
    """The full-length windows of a block's documents."""

    def __init__(self, table: pa.Table, window: int):
        self.texts = table.column("text").combine_chunks().fill_null("")
        self.ids, known = _ids(table)
        self.words: Words = split_words(self.texts)
        self.at, rows = windows(self.words, window)
        keep = known[rows]
        self.at, rows = self.at[keep], rows[keep]
        self.doc = self.ids[rows]
        self.hashed = hash_words(self.words.vocab)[self.words.ids]
        self.window = window

    def shorter(self, length: int) -> np.ndarray:
        """Smallest hash of a window of ``length`` words within each full window."""
        hashes = rolling(self.hashed, length)
        if not len(self.at):
            return np.zeros(0, np.uint64)
        return mix(_sliding_min(hashes, self.window - length + 1)[self.at])     # minima are small: mixed, they fill all buckets

    def full(self) -> list[np.ndarray]:
        """Two independent hashes of each full window."""
        if not len(self.at):
            return [np.zeros(0, np.uint64)] * 2
        return [rolling(self.hashed ^ np.uint64(seed), self.window)[self.at] for seed in (0, 0xA0761D6478BD642F)]


SHORTER = "bucket int, block int, hash binary, low binary, high binary"
FULL = "bucket int, block int, hash binary, check binary, low binary, high binary"


def levels(window: int, base: int = BASE) -> list[int]:
    """Lengths of the levels: from ``base`` by doubling, and the full length at last."""
    lengths = [base]
    while 2 * lengths[-1] < window:
        lengths.append(2 * lengths[-1])
    return [n for n in lengths if n < window] + [window]


def _sent(key: tuple, b: _Block, length: int, keep: np.ndarray | slice, n: int) -> pa.Table:
    """What a block sends of its kept full windows: the shorter windows that stand for them."""
    hashes, doc = b.shorter(length)[keep], b.doc[keep]
    first = np.ones(len(hashes), bool)
    first[1:] = (hashes[1:] != hashes[:-1]) | (doc[1:] != doc[:-1])
    (hashes,), low, high, _ = low_and_high([hashes[first]], doc[first], doc[first])
    return to_buckets(key[0].as_py(), hashes, {"low": low, "high": high}, n)


def _first_level(window: int, length: int, n: int):
    def run(key: tuple, docs: pa.Table) -> pa.Table:
        return _sent(key, _Block(docs, window), length, slice(None), n)
    return run


def _survivors(b: _Block, length: int, repeated: pa.Table) -> np.ndarray:
    """Full windows whose shorter window repeats."""
    return position(b.shorter(length), np.sort(column(repeated, "hash")))[1]


def _next_level(window: int, known: int, length: int, n: int):
    def run(key: tuple, docs: pa.Table, repeated: pa.Table) -> pa.Table:
        if not repeated.num_rows or not docs.num_rows:
            none = np.zeros(0, np.uint64)
            return to_buckets(0, none, {"low": none, "high": none}, n)
        b = _Block(docs, window)
        return _sent(key, b, length, _survivors(b, known, repeated), n)
    return run


def _repeated(key: tuple, table: pa.Table) -> pa.Table:
    """Per asking block, its hashes that occur in more than one document."""
    hashes = column(table, "hash")
    _, least, most, at = low_and_high([hashes], column(table, "low"), column(table, "high"))
    return _replies(table, (least < most)[at], {"hash": hashes})


def _last_level(window: int, known: int, n: int):
    def run(key: tuple, docs: pa.Table, repeated: pa.Table) -> pa.Table:
        none = np.zeros(0, np.uint64)
        if not repeated.num_rows or not docs.num_rows:
            return to_buckets(0, none, {"check": none, "low": none, "high": none}, n)
        b = _Block(docs, window)
        found = _survivors(b, known, repeated)
        doc = b.doc[found]
        (hashes, check), low, high, _ = low_and_high([x[found] for x in b.full()], doc, doc)
        return to_buckets(key[0].as_py(), hashes, {"check": check, "low": low, "high": high}, n)
    return run


def _removable(key: tuple, table: pa.Table) -> pa.Table:
    """Per asking block, its windows that start in a document smaller than one of its own, with the smallest such doc_id."""
    hashes, check, high = column(table, "hash"), column(table, "check"), column(table, "high")
    _, least, _, at = low_and_high([hashes, check], column(table, "low"), high)
    return _replies(table, least[at] < high, {"hash": hashes, "check": check, "low": least[at]})


def _replies(table: pa.Table, keep: np.ndarray, columns: dict[str, np.ndarray]) -> pa.Table:
    ends = np.concatenate([[0], np.cumsum([len(x) // 8 for x in table.column("hash").to_pylist()])]).astype(np.int64)
    spans = zip(table.column("block").to_pylist(), ends[:-1].tolist(), ends[1:].tolist())
    rows = [(b, s, e) for b, s, e in spans if keep[s:e].any()]
    data = {"block": pa.array([b for b, _, _ in rows], pa.int32())}
    for name, values in columns.items():
        data[name] = pa.array([pack(values[s:e][keep[s:e]]) for _, s, e in rows], pa.binary())
    return pa.table(data)


def _cut(window: int, keep_text: bool):
    def run(key: tuple, docs: pa.Table, found: pa.Table) -> pa.Table:
        b = _Block(docs, window)
        removed = np.zeros(len(b.words.ids) + 1, np.int64)
        if found.num_rows:
            pair = mix(column(found, "hash") ^ mix(column(found, "check")))
            order, low = np.argsort(pair), column(found, "low")
            hashes, check = b.full()
            at, hit = position(mix(hashes ^ mix(check)), pair[order])
            starts = b.at[hit & (low[order][at] < b.doc)]
            np.add.at(removed, starts, 1)
            np.add.at(removed, starts + window, -1)
        removed = np.cumsum(removed)[:-1] > 0
        n_removed = b.words.sums(removed.astype(np.int64))
        shas, texts = [], []
        for i, text in enumerate(b.texts.to_pylist()):
            words = text.encode().split()
            if n_removed[i]:
                gone = removed[b.words.starts[i]:b.words.starts[i + 1]].tolist()
                words = [w for w, g in zip(words, gone) if not g]
            kept = b" ".join(words)
            shas.append(hashlib.sha256(kept).hexdigest())
            if keep_text:
                texts.append(kept.decode())
        out = {"doc_id": docs.column("doc_id"), "n_words": pa.array(b.words.counts, pa.int64()),
               "n_removed": pa.array(n_removed, pa.int64()), "kept_sha256": pa.array(shas, pa.string())}
        return pa.table(out | ({"kept_text": pa.array(texts, pa.string())} if keep_text else {}))
    return run


def remove_repeats(docs: DataFrame, window: int = WINDOW, keep_text: bool = True, base: int = BASE) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and on demand kept_text (kept words joined by one space)."""
    blocks, n = blocked(docs)
    by_block = blocks.groupBy("block")
    *lengths, _ = levels(window, base) if window > base else [(window + 1) // 2, window]
    sent, repeated = by_block.applyInArrow(_first_level(window, lengths[0], n), SHORTER), None
    for at, length in enumerate(lengths):
        before, repeated = repeated, sent.groupBy("bucket").applyInArrow(_repeated, "block int, hash binary")
        if at < len(lengths) - 1:       # written: it decides whether there is a next level, which reads it
            repeated = materialize(repeated, "repeated")
            if before is not None:
                release(before)
            if repeated.isEmpty():
                break
            sent = by_block.cogroup(repeated.groupBy("block")).applyInArrow(_next_level(window, length, lengths[at + 1], n), SHORTER)
    full = by_block.cogroup(repeated.groupBy("block")).applyInArrow(_last_level(window, length, n), FULL)
    found = full.groupBy("bucket").applyInArrow(_removable, "block int, hash binary, check binary, low binary")
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", kept_text string" * keep_text
    return by_block.cogroup(found.groupBy("block")).applyInArrow(_cut(window, keep_text), schema)
