"""Quality classifier: logistic regression over hashed word n-grams, scored as sparse dot products.

Words are taken apart into a lower-case core, a tail of symbols and whether all
letters are capitals; n-grams of one and two cores, tails and capitals are
hashed. A word that equals one of the three before it gives one n-gram whatever
the word, so repetition is learned from words never seen in training.

The model is fitted on at most about MAX_TRAIN labelled rows outside fold 0
(see ``linear``); every document is scored over its whole text.

Defined results: a null or blank text is scored by the bias alone. Repeated rows
are rows of their own. Without labels every score is 0.5. An empty table gives
an empty result; further columns are left out.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carestar.llm.linear import BITS, HELD_OUT, MAX_TRAIN, fold, labelled, score, train, unit_rows
from carestar.llm.store import documents
from carestar.llm.words import chunks, mix, split_words, text_column

THRESHOLD = 0.3
SAME, CAPITALS = 1, 2          # numbers of the n-grams that stand for no certain word


def _parts(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each word: hash of the core, hash of the symbols after it (0: none), all capitals."""
    import xxhash
    h = xxhash.xxh3_64_intdigest
    tail_of = re.compile(r"[^\w\s.,;:'’()\"-]+$").search
    core, tail, upper = (np.zeros(len(words), np.uint64) for _ in range(3))
    for i, word in enumerate(words):
        m = tail_of(word)
        if m:
            tail[i] = h("tail " + m.group())
            word = word[:m.start()]
        upper[i] = len(word) > 1 and word.isupper()
        core[i] = h(word.lower().strip(".,;:'’()\"-"))
    return core, tail, upper


def ngram_rows(texts: pa.Array):
    """Sparse rows of the texts' n-grams."""
    w = split_words(texts)
    core, tail, upper = (x[w.ids] for x in _parts(w.vocab.to_pylist()))
    rows, place = w.rows, np.arange(len(w.ids)) - np.repeat(w.starts[:-1], w.counts)
    found = [(rows, mix(core))]
    with np.errstate(over="ignore"):
        second = np.flatnonzero(place >= 1)
        found.append((rows[second], mix(core[second - 1] * np.uint64(3) + core[second] * np.uint64(5))))
    found.append((rows[tail != 0], mix(tail[tail != 0])))
    capital = rows[upper != 0]
    found.append((capital, mix(np.full(len(capital), CAPITALS, np.uint64))))
    for back in (1, 2, 3):
        at = np.flatnonzero(place >= back)
        same = rows[at[core[at] == core[at - back]]]
        found.append((same, mix(np.full(len(same), SAME + 16 * back, np.uint64))))
    return unit_rows(np.concatenate([r for r, _ in found]), np.concatenate([x for _, x in found]), len(texts))


def _features(table: pa.Table):
    return ngram_rows(table.column("text").combine_chunks().cast(pa.string()))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", max_rows: int = MAX_TRAIN) -> np.ndarray:
    return train(labelled(documents(docs), labels, label, max_rows), _features, 1 << BITS)


def classify(docs: DataFrame, w: np.ndarray, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""
    weights = docs.sparkSession.sparkContext.broadcast(w)

    def run(batches):
        for batch in chunks(batches):
            values = score(*ngram_rows(text_column(batch)), weights.value)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(values)], names=["doc_id", "score"])

    scored = documents(docs).mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", F.coalesce(fold(F.col("doc_id")) == HELD_OUT, F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))


def quality_scores(docs: DataFrame, labels: DataFrame, label: str = "quality") -> DataFrame:
    return classify(docs, fit(docs, labels, label))
