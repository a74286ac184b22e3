"""Toxicity by weak supervision.

1. Lexicons. From a bounded sample of labelled rows (never fold 0, see
   ``linear``) word beginnings are kept that are far more frequent in toxic than
   in other documents: *sure* terms by documents that hold them at all, *pattern*
   terms by documents that hold them twice or more.
2. Voters. Counts of these terms against fixed limits give VOTERS binary votes
   for every document of the corpus.
3. Label model. The counts of the at most 2 ** VOTERS vote patterns over all
   documents are fitted by a two-class generative model (expectation
   maximisation). Voters that are still correlated within a class are estimated
   jointly, the others by their own accuracy. It yields a probability per pattern.
4. Classifier. A linear classifier (``linear``) is trained on these posterior
   labels of a bounded sample and scores every document over its whole text.

Defined results: a null or blank text has no votes and is scored by the bias.
Repeated rows are rows of their own. Without labels there are no lexicons, and
every score is that of a document without votes. An empty table gives an empty
result; further columns are left out.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carestar.llm.linear import BITS, HELD_OUT, MAX_TRAIN, bounded, fold, labelled, score, train, unit_rows
from carestar.llm.store import documents, materialize
from carestar.llm.words import Words, chunks, hash_words, split_words, text_column

THRESHOLD = 0.5
SHORTEST, LONGEST = 3, 8           # letters of a term
SURE_ODDS, PATTERN_ODDS = 3.0, 2.0  # least log odds of a term
LEAST_SHARE = 0.01                 # of the toxic documents that must hold a term
MAX_TERMS = 500                    # per lexicon, best first
TERM_BYTES = 2 << 20               # of text that terms are counted in at a time
VOTERS = 10
GROUP = 4                          # most voters that are estimated jointly
CORRELATED = 0.2                   # least correlation within a class for that
STEPS = 100
EXTRA = 64                         # features beside the hashed ones


def _cores(vocab: pa.Array) -> list[str]:
    """Each word in lower case, from its first letter to the end of that run of letters."""
    letters = re.compile(r"[^\W\d_]+").search
    return [m.group().lower() if (m := letters(x)) else "" for x in vocab.to_pylist()]


# -- lexicons -------------------------------------------------------------

def _beginnings(vocab: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Of each word the numbers of its beginnings of SHORTEST to LONGEST letters (-1: too short), and these terms."""
    cores = pa.array(_cores(vocab), pa.string())
    lengths = pc.utf8_length(cores).to_numpy(zero_copy_only=False)
    sizes = range(SHORTEST, LONGEST + 1)
    terms = pa.concat_arrays([pc.utf8_slice_codeunits(cores, 0, size) for size in sizes]).dictionary_encode()
    numbers = terms.indices.to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(sizes), -1).T
    return np.where(lengths[:, None] >= np.array(sizes), numbers, -1), terms.dictionary


def _term_counts(batches):
    """Per piece of the sample: each word beginning with the documents of either label that hold it once, and twice."""
    for batch in chunks(batches, max_bytes=TERM_BYTES):
        w = split_words(text_column(batch))
        numbers, terms = _beginnings(w.vocab)
        size = max(len(w.vocab), 1)
        pairs, times = np.unique(w.rows * size + w.ids, return_counts=True)
        found = numbers[pairs % size]
        held = found >= 0
        keys = (pairs // size)[:, None] * max(len(terms), 1) + found
        keys, where = np.unique(keys[held], return_inverse=True)
        n = np.bincount(where, np.broadcast_to(times[:, None], found.shape)[held], len(keys))
        term, toxic = keys % max(len(terms), 1), (batch.column("y").to_numpy(zero_copy_only=False) > 0.5)[keys // max(len(terms), 1)]
        columns = [np.bincount(term[(n >= least) & (toxic == y)], minlength=len(terms)) for least in (1, 2) for y in (True, False)]
        some = np.flatnonzero(sum(columns))
        yield pa.RecordBatch.from_arrays([terms.take(pa.array(some)), *[pa.array(c[some].astype(np.int64)) for c in columns]],
                                         names=["term", "t1", "c1", "t2", "c2"])


@dataclass
class Lexicons:
    sure: dict[str, float]
    pattern: dict[str, float]


def _widest(rows: list[tuple[str, int, float]]) -> dict[str, float]:
    """Of terms that begin alike, the longest that loses no documents: a term goes if a shorter one finds clearly more at like odds."""
    known = {t: (n, s) for t, n, s in rows}
    kept = {}
    for term, n, s in rows:
        shorter = [known[term[:k]] for k in range(SHORTEST, len(term)) if term[:k] in known]
        if not any(m > 1.2 * n and o >= s - 0.5 for m, o in shorter):
            kept[term] = s
    # and a shorter one goes if a longer one finds nearly as much
    return {t: s for t, s in kept.items()
            if not any(u != t and u.startswith(t) and known[u][0] >= known[t][0] / 1.2 for u in kept)}


def mine_lexicons(sample: DataFrame) -> Lexicons:
    """Lexicons from a bounded sample (doc_id, text, y)."""
    n = {r["toxic"]: r["n"] for r in sample.groupBy((F.col("y") > 0.5).alias("toxic")).agg(F.count("*").alias("n")).collect()}
    toxic, clean = n.get(True, 0), n.get(False, 0)
    least = max(5, LEAST_SHARE * toxic)

    def odds(t: str, c: str):
        return F.log((F.col(t) + 0.5) / (toxic + 1)) - F.log((F.col(c) + 0.5) / (clean + 1))

    counts = sample.select("text", "y").mapInArrow(_term_counts, "term string, t1 long, c1 long, t2 long, c2 long")
    terms = counts.groupBy("term").agg(*[F.sum(c).alias(c) for c in ("t1", "c1", "t2", "c2")])
    terms = materialize(terms.where(F.greatest("t1", "t2") >= least), "terms")

    def best(found: str, other: str, limit: float) -> dict[str, float]:
        rows = (terms.where(F.col(found) >= least).select("term", F.col(found).alias("n"), odds(found, other).alias("s"))
                .where(F.col("s") >= limit).orderBy(F.desc(F.col("s") * F.sqrt("n")), "term").limit(MAX_TERMS).collect())
        return _widest([(r["term"], r["n"], r["s"]) for r in rows])

    sure = best("t1", "c1", SURE_ODDS)
    return Lexicons(sure, {t: s for t, s in best("t2", "c2", PATTERN_ODDS).items() if t not in sure})


# -- voters ---------------------------------------------------------------

def term_hits(w: Words, lex: Lexicons) -> np.ndarray:
    """Per text: words that match sure terms of either half, and pattern terms."""
    per_word = np.zeros((len(w.vocab), 3), np.int64)
    for i, core in enumerate(_cores(w.vocab)):
        found = pattern = False
        for size in range(SHORTEST, min(LONGEST, len(core)) + 1):
            term = core[:size]
            if not found and term in lex.sure:
                per_word[i, sum(map(ord, term)) % 2] = 1
                found = True
            if not pattern and term in lex.pattern:
                per_word[i, 2] = 1
                pattern = True
    return np.stack([w.sums(per_word[w.ids, k]) for k in range(3)], axis=1)


def votes(hits: np.ndarray, n_words: np.ndarray) -> np.ndarray:
    """The binary votes of each text, as columns."""
    a, b, p = hits[:, 0], hits[:, 1], hits[:, 2]
    share = (a + b + p) / np.maximum(n_words, 1)
    return np.stack([a > 0, b > 0, a + b > 1, a + b > 2, p > 1, p > 2, p > 3, (a + b + p) > 3,
                     (share >= 0.005) & (a + b + p > 1), (share >= 0.02) & (a + b + p > 1)], axis=1)


def pattern_numbers(v: np.ndarray) -> np.ndarray:
    return (v.astype(np.int64) << np.arange(v.shape[1])).sum(1)


# -- label model ----------------------------------------------------------

class LabelModel:
    """Two latent classes; voters in groups, each with a joint table of its votes per class."""

    def __init__(self, patterns: np.ndarray, counts: np.ndarray, m: int = VOTERS):
        self.m = m
        self.bits = (patterns[:, None] >> np.arange(m)) & 1
        self.counts = counts.astype(float)
        start = 1 / (1 + np.exp(-2.0 * (self.bits.sum(1) - 1.5)))
        self.groups: list[tuple[int, ...]] = [(j,) for j in range(m)]
        q = self._fit(start)
        self.groups = self._grouped(q)
        self.q = self._fit(q)

    def _cells(self, group) -> np.ndarray:
        return (self.bits[:, list(group)] << np.arange(len(group))).sum(1)

    def _fit(self, q: np.ndarray) -> np.ndarray:
        cells = [(self._cells(g), 1 << len(g)) for g in self.groups]
        for _ in range(STEPS):
            log_odds = np.log((self.counts @ q + 1) / (self.counts @ (1 - q) + 1)) * np.ones(len(q))
            self.tables = []
            for cell, size in cells:
                one = np.bincount(cell, self.counts * q, size) + 0.5
                zero = np.bincount(cell, self.counts * (1 - q), size) + 0.5
                table = np.log(one / one.sum()) - np.log(zero / zero.sum())
                self.tables.append(table)
                log_odds = log_odds + table[cell]
            self.prior = float(np.log((self.counts @ q + 1) / (self.counts @ (1 - q) + 1)))
            q = 1 / (1 + np.exp(-np.clip(log_odds, -35, 35)))
        return q

    def _grouped(self, q: np.ndarray) -> list[tuple[int, ...]]:
        """Voters joined while their correlation within the classes is above CORRELATED, strongest pairs first."""
        strength = {}
        for a, b in combinations(range(self.m), 2):
            worst = 0.0
            for weight in (self.counts * q, self.counts * (1 - q)):
                total = weight.sum() + 1e-9
                x, y = self.bits[:, a], self.bits[:, b]
                mx, my = weight @ x / total, weight @ y / total
                spread = np.sqrt(mx * (1 - mx) * my * (1 - my))
                if spread > 1e-6:
                    worst = max(worst, abs(weight @ (x * y) / total - mx * my) / spread)
            strength[a, b] = worst
        group = {j: frozenset([j]) for j in range(self.m)}
        for (a, b), s in sorted(strength.items(), key=lambda x: (-x[1], x[0])):
            both = group[a] | group[b]
            if s >= CORRELATED and len(both) <= GROUP:
                for j in both:
                    group[j] = both
        return sorted({tuple(sorted(g)) for g in group.values()})

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        """Probability of toxicity for any pattern; more votes never make a text without them more toxic than one with."""
        bits = (np.asarray(patterns)[:, None] >> np.arange(self.m)) & 1
        log_odds = np.full(len(bits), self.prior)
        for g, table in zip(self.groups, self.tables):
            log_odds += table[(bits[:, list(g)] << np.arange(len(g))).sum(1)]
        return 1 / (1 + np.exp(-np.clip(log_odds, -35, 35)))


def pattern_counts(docs: DataFrame, lex: Lexicons) -> tuple[np.ndarray, np.ndarray]:
    """Vote patterns over all documents: at most 2 ** VOTERS rows come back."""
    def run(batches):
        for batch in chunks(batches):
            w = split_words(text_column(batch))
            numbers, counts = np.unique(pattern_numbers(votes(term_hits(w, lex), w.counts)), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(numbers), pa.array(counts.astype(np.int64))], names=["pattern", "n"])

    rows = (docs.select("text").mapInArrow(run, "pattern long, n long").groupBy("pattern").agg(F.sum("n").alias("n"))
            .orderBy("pattern").collect())
    return np.array([r["pattern"] for r in rows], np.int64), np.array([r["n"] for r in rows], np.int64)


# -- classifier -----------------------------------------------------------

def _rows(texts: pa.Array, lex: Lexicons):
    """Sparse rows: hashed words and word beginnings at length 1, then the votes and how many terms were hit."""
    w = split_words(texts)
    cores = pa.array(_cores(w.vocab), pa.string())
    hashed = hash_words(cores)
    begins = hash_words(pc.utf8_slice_codeunits(cores, 0, 5))
    rows = w.rows
    starts, index, value = unit_rows(np.concatenate([rows, rows]), np.concatenate([hashed[w.ids], begins[w.ids]]), len(texts))
    hits = term_hits(w, lex)
    v = votes(hits, w.counts)
    dense = np.concatenate([v, (hits[:, :2].sum(1, keepdims=True) > np.arange(6)), (hits[:, 2:] > np.arange(8)),
                            (hits.sum(1, keepdims=True) > np.arange(8))], axis=1)
    at, which = np.nonzero(dense)
    rows = np.concatenate([np.repeat(np.arange(len(texts)), np.diff(starts)), at])
    order = np.argsort(rows, kind="stable")
    index = np.concatenate([index, (1 << BITS) + which])[order]
    value = np.concatenate([value, np.ones(len(at))])[order]
    return np.searchsorted(rows[order], np.arange(len(texts) + 1)), index, value


def _with_posteriors(docs: DataFrame, lex: Lexicons, model: LabelModel) -> DataFrame:
    table = model.posterior(np.arange(1 << VOTERS))

    def run(batches):
        for batch in chunks(batches):
            texts = text_column(batch)
            w = split_words(texts)
            y = table[pattern_numbers(votes(term_hits(w, lex), w.counts))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), texts, pa.array(y)], names=["doc_id", "text", "y"])

    return docs.mapInArrow(run, "doc_id long, text string, y double")


@dataclass
class ToxicityModel:
    lexicons: Lexicons
    labels: LabelModel
    weights: np.ndarray


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", max_rows: int = MAX_TRAIN) -> ToxicityModel:
    """Lexicons from labels, the label model from the votes of all documents, the classifier from posterior labels."""
    base = documents(docs)
    lex = mine_lexicons(labelled(base, labels, label, max_rows))
    patterns, counts = pattern_counts(base, lex)
    model = LabelModel(patterns, counts) if len(patterns) else LabelModel(np.zeros(1, np.int64), np.ones(1))
    sample = materialize(_with_posteriors(bounded(base, max_rows), lex, model), "posteriors")
    weights = train(sample, lambda t: _rows(t.column("text").combine_chunks(), lex), (1 << BITS) + EXTRA)
    return ToxicityModel(lex, model, weights)


def classify(docs: DataFrame, model: ToxicityModel, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""
    weights, lex = docs.sparkSession.sparkContext.broadcast(model.weights), model.lexicons

    def run(batches):
        for batch in chunks(batches):
            values = score(*_rows(text_column(batch), lex), weights.value)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(values)], names=["doc_id", "score"])

    scored = documents(docs).mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", F.coalesce(fold(F.col("doc_id")) == HELD_OUT, F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))


def toxicity_scores(docs: DataFrame, labels: DataFrame, label: str = "toxic") -> DataFrame:
    return classify(docs, fit(docs, labels, label))


def without_toxic(docs: DataFrame, labels: DataFrame, label: str = "toxic", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, all columns, whose score is below the threshold. The decision is made row by row, in one scan."""
    model = fit(docs, labels, label)
    weights, lex = docs.sparkSession.sparkContext.broadcast(model.weights), model.lexicons

    def run(batches):
        for batch in chunks(batches):
            values = score(*_rows(text_column(batch), lex), weights.value)
            yield batch.filter(pa.array(values < threshold))

    return docs.mapInArrow(run, docs.schema)
