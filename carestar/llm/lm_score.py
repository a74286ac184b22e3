"""Stupid-backoff language-model scores of documents by counts from the whole corpus.

Each block of documents counts its n-grams; the counts are summed per n-gram in
buckets of the hash space (the n-gram tables), joined back to the blocks that hold
the n-gram and summed over each document's words. This goes level by level: one
and two words first, then one word more at a time. An n-gram can only occur
``min_count`` times if both n-grams of one word less inside it do, so a block asks
for no others, and what is not asked for is known to be too rare. Each level is
written before the next one begins.

N-grams are told apart by 64-bit hashes, and travel as packed arrays, a row per
block and bucket.

The score of a word is the relative frequency after its ``order - 1`` words
before it if that n-gram occurs ``min_count`` times in the corpus, else
``backoff`` times the score after one word less; at the start of a text the
context is shorter. Logarithms are natural, rounded to a millionth per word, so
sums do not depend on their order.

Defined results: a null or blank text has no words and score 0. Repeated rows
are rows of their own, and each counts. An empty table gives an empty result;
further columns are left out.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carestar.llm.blocks import LEAST_BLOCKS, blocked, column, pack, to_buckets, unpack
from carestar.llm.store import materialize
from carestar.llm.words import hash_words, rolling, split_words, windows

ORDER = 3
MIN_COUNT = 2
BACKOFF = 0.4
MICRO = 1_000_000
BLOCK_BYTES = 4 << 20       # a worker holds some dozen numbers for each word of a block at once
BLOCKS_PER_BUCKET = 2


def _tables(order: int) -> list[tuple[int, ...]]:
    """The lengths of n-grams that are counted together, level by level."""
    return [tuple(range(1, min(order, 2) + 1))] + [(k,) for k in range(3, order + 1)]


def _starts(ascending: np.ndarray) -> np.ndarray:
    """Where each distinct value starts."""
    new = np.ones(len(ascending), bool)
    new[1:] = ascending[1:] != ascending[:-1]
    return np.flatnonzero(new)


class _Grams:
    """The n-grams of a block: per length, the words that they start at and their hashes."""

    def __init__(self, table: pa.Table, order: int):
        self.words = split_words(table.column("text").combine_chunks().fill_null(""))
        self.hashed = hash_words(self.words.vocab)[self.words.ids]
        self.order = order

    def at(self, k: int, rare: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Words that the n-grams of ``k`` words start at, and their hashes; without those that hold an n-gram of one
        word less that starts at a word marked in ``rare``."""
        at = windows(self.words, k)[0]
        if rare is not None and len(at):
            at = at[~(rare[at] | rare[at + 1])]
        return at, rolling(self.hashed ^ np.uint64(k), k)[at] if len(at) else np.zeros(0, np.uint64)

    def asked(self, lengths: tuple[int, ...], rare: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        """What a block asks for at a level: distinct hashes, ascending, and how often it has each."""
        every = np.concatenate([self.at(k, rare)[1] for k in lengths])
        every.sort()
        starts = _starts(every)
        return every[starts], np.diff(np.append(starts, len(every))).astype(np.uint64)

    def answered(self, lengths: tuple[int, ...], rare: np.ndarray | None, counts: np.ndarray) -> list[np.ndarray]:
        """Per length, the count of the n-gram that starts at each word, from those of the distinct hashes."""
        grams = [self.at(k, rare) for k in lengths]
        ats, every = [at for at, _ in grams], np.concatenate([h for _, h in grams])
        del grams                                              # what is not needed any more goes before the next array comes
        order = np.argsort(every)
        every = every[order]
        starts = _starts(every)
        if len(counts) != len(starts):
            raise ValueError("the answer does not cover the block's n-grams")
        times = np.diff(np.append(starts, len(every)))
        del every, starts
        found = np.empty(len(order))
        found[order] = np.repeat(counts, times)
        del order, times
        out, begin = [], 0
        for at in ats:
            c = np.zeros(len(self.words.ids) + 1)              # one more, so that every word has one behind it
            c[at] = found[begin:begin + len(at)]
            begin += len(at)
            out.append(c)
        return out

    def known(self, totals: pa.Table, levels: int, min_count: int) -> list[np.ndarray]:
        """Per length, the corpus count of the n-gram that starts at each word (0: too rare, or none), from the answers
        of the first ``levels`` levels."""
        of: list[np.ndarray] = []
        at, bucket, packed = totals.column("level").to_numpy(), totals.column("bucket").to_numpy(), totals.column("n")
        for level, lengths in enumerate(_tables(self.order)[:levels]):
            rows = np.flatnonzero(at == level)
            rows = rows[np.argsort(bucket[rows])].tolist()
            counts = np.concatenate([np.zeros(0), *[unpack(packed[i].as_buffer()).astype(np.float64) for i in rows]])
            of += self.answered(lengths, of[-1] < min_count if level else None, counts)
        return of


def _ask(order: int, level: int, min_count: int, n: int):
    def first(key: tuple, docs: pa.Table) -> pa.Table:
        distinct, counts = _Grams(docs, order).asked(_tables(order)[0], None)
        return to_buckets(key[0].as_py(), distinct, {"n": counts}, n)

    def later(key: tuple, docs: pa.Table, totals: pa.Table) -> pa.Table:
        g = _Grams(docs, order)
        rare = g.known(totals, level, min_count)[-1] < min_count
        distinct, counts = g.asked(_tables(order)[level], rare)
        return to_buckets(key[0].as_py() if key[0].is_valid else 0, distinct, {"n": counts}, n)
    return later if level else first


def _total(key: tuple, table: pa.Table) -> pa.Table:
    hashes, counts = column(table, "hash"), column(table, "n")
    order = np.argsort(hashes)
    starts = _starts(hashes[order])
    totals = np.empty(len(hashes), np.uint64)
    if len(starts):
        totals[order] = np.repeat(np.add.reduceat(counts[order], starts), np.diff(np.append(starts, len(hashes))))
    sizes = pc.binary_length(table.column("hash")).to_numpy().astype(np.int64) // 8
    ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    parts = [pack(totals[s:e]) for s, e in zip(ends[:-1].tolist(), ends[1:].tolist())]
    return pa.table({"block": table.column("block"), "bucket": table.column("bucket"), "n": pa.array(parts, pa.binary())})


def _score(order: int, min_count: int, backoff: float):
    def micro(x: np.ndarray) -> np.ndarray:
        return np.rint(np.log(x) * MICRO).astype(np.int64)

    def run(key: tuple, docs: pa.Table, totals: pa.Table) -> pa.Table:
        g = _Grams(docs, order)
        of, size = g.known(totals, len(_tables(order)), min_count), len(g.words.ids)
        index = np.arange(size) - np.repeat(g.words.starts[:-1], g.words.counts)
        value, open_, cost = np.zeros(size, np.int64), np.ones(size, bool), np.zeros(size)
        for k in range(order, 1, -1):
            here = np.flatnonzero(open_ & (index >= k - 1))
            whole, context = of[k - 1][here - k + 1], of[k - 2][here - k + 1]
            seen = whole >= min_count
            hit = here[seen]
            value[hit] = micro(backoff ** cost[hit] * whole[seen] / context[seen])
            open_[hit] = False
            cost[here[~seen]] += 1
        rest = np.flatnonzero(open_)
        value[rest] = micro(backoff ** cost[rest] * of[0][rest])
        return pa.table({"doc_id": docs.column("doc_id"), "n_words": pa.array(g.words.counts, pa.int64()),
                         "n_backed_off": pa.array(g.words.sums(open_.astype(np.int64)), pa.int64()),
                         "sum_micro": pa.array(g.words.sums(value), pa.int64())})
    return run


def lm_scores(docs: DataFrame, order: int = ORDER, min_count: int = MIN_COUNT, backoff: float = BACKOFF) -> DataFrame:
    """doc_id, n_words, n_backed_off (words scored by their own frequency), score_micro (sum of log scores, millionths)."""
    base, blocks = blocked(docs, BLOCK_BYTES)
    by_block, totals, n = base.groupBy("block"), None, max(LEAST_BLOCKS, math.ceil(blocks / BLOCKS_PER_BUCKET))
    for level in range(len(_tables(order))):
        ask, schema = _ask(order, level, min_count, n), "bucket int, block int, hash binary, n binary"
        asked = by_block.cogroup(totals.groupBy("block")).applyInArrow(ask, schema) if level else by_block.applyInArrow(ask, schema)
        answers = asked.groupBy("bucket").applyInArrow(_total, "block int, bucket int, n binary").withColumn("level", F.lit(level))
        answers = materialize(answers, f"lm-counts-{level}")
        totals = answers if totals is None else totals.unionByName(answers)
    scored = materialize(
        by_block.cogroup(totals.groupBy("block")).applyInArrow(
            _score(order, min_count, backoff), "doc_id long, n_words long, n_backed_off long, sum_micro long"), "lm")
    words = scored.agg(F.sum("n_words")).first()[0] or 1
    shift = round(math.log(words) * MICRO)
    return scored.select("doc_id", "n_words", "n_backed_off",
                         (F.col("sum_micro") - F.col("n_backed_off") * shift).alias("score_micro"))
