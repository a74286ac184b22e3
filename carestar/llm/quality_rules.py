"""Quality rules with host verdicts.

Each document gets counts over its whole text and a failure flag per rule.
Failures are then summed by host; a host's rate for a rule is shrunk towards all
hosts by a beta prior fitted to the hosts' rates (method of moments), and a host
whose shrunk rate exceeds ``host_limit`` for some rule loses all its documents.

Defined results: a null or blank text has no words, so it fails the base rules.
A document without a host is judged by the base rules alone. Repeated rows are
rows of their own. An empty table gives an empty result. Further columns of the
input are left out.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carestar.llm.store import documents, materialize, small_or_shuffled
from carestar.llm.words import Words, chunks, split_words, text_column, windows

MIN_WORDS = 50
MAX_REPEAT_PCT = 50
SYMBOLS = r"[#*$%&|<>]"
HOST_LIMIT = 0.5
PRIOR_MAX = 1000.0      # most pseudo-documents that the prior may weigh

COUNTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")
RULES = {               # SQL over the counts
    "short": f"n_words < {MIN_WORDS}",
    "repeats": f"100 * n_repeat_words > {MAX_REPEAT_PCT} * n_words",
    "symbols": "10 * n_symbols > n_words",
    "lines": "10 * n_dup_lines > 3 * n_lines",
    "length": "word_chars < 3 * n_words or word_chars > 12 * n_words",
}


def _repeated_words(w: Words) -> np.ndarray:
    """Per text, the words in 3-word windows that the text holds twice or more."""
    at, rows = windows(w, 3)
    size = max(len(w.vocab), 1)
    pair = pd.factorize(w.ids[at] * size + w.ids[at + 1])[0].astype(np.int64)
    window = pd.factorize(pair * size + w.ids[at + 2])[0].astype(np.int64)
    again = at[pd.Series(window * max(len(w.starts), 1) + rows).duplicated(keep=False).to_numpy()]
    covered = np.zeros(len(w.ids), np.int64)
    for k in range(3):
        covered[again + k] = 1
    return w.sums(covered)


def _line_counts(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Per text, lines that hold a word, and those among them equal to an earlier line of the text."""
    lists = pc.split_pattern(texts, "\n")
    flat = lists.flatten().dictionary_encode()
    starts = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))]).astype(np.int64)
    ids = flat.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    lines = Words(starts, ids, flat.dictionary)
    has_word = pc.match_substring_regex(flat.dictionary, r"[^\x20\x09-\x0D]").to_numpy(zero_copy_only=False)[ids]
    again = pd.Series(lines.rows * max(len(flat.dictionary), 1) + ids).duplicated().to_numpy()
    return lines.sums(has_word.astype(np.int64)), lines.sums((has_word & again).astype(np.int64))


def _count(batches):
    for batch in chunks(batches):
        texts = text_column(batch)
        w = split_words(texts)
        n_lines, n_dup_lines = _line_counts(texts)
        lengths = pc.utf8_length(w.vocab).to_numpy(zero_copy_only=False).astype(np.int64)
        values = {
            "n_words": w.counts, "word_chars": w.sums(lengths[w.ids]),
            "n_symbols": pc.count_substring_regex(texts, SYMBOLS).to_numpy(zero_copy_only=False).astype(np.int64),
            "n_lines": n_lines, "n_dup_lines": n_dup_lines, "n_repeat_words": _repeated_words(w),
        }
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("host"), *[pa.array(values[c], pa.int64()) for c in COUNTS]],
            names=["doc_id", "host", *COUNTS])


def rule_counts(docs: DataFrame, host_col: str = "source") -> DataFrame:
    """doc_id, host, the counts, and ``fail_<rule>`` for each rule."""
    base = documents(docs, host_col).toDF("doc_id", "text", "host").withColumn("host", F.col("host").cast("string"))
    counted = base.mapInArrow(_count, "doc_id long, host string, " + ", ".join(f"{c} long" for c in COUNTS))
    return counted.select("*", *[F.expr(rule).alias(f"fail_{name}") for name, rule in RULES.items()])


def host_verdicts(counted: DataFrame, host_limit: float = HOST_LIMIT) -> DataFrame:
    """host, n_docs, ``rate_<rule>`` (shrunk), host_bad. One row per host; the priors are one row of sums."""
    hosts = materialize(
        counted.where(F.col("host").isNotNull()).groupBy("host").agg(
            F.count("*").alias("n_docs"), *[F.sum(F.col(f"fail_{r}").cast("long")).alias(f"n_{r}") for r in RULES]),
        "hosts")
    stats = hosts.agg(*[f(F.col(f"n_{r}") / F.col("n_docs")).alias(f"{k}_{r}")
                        for r in RULES for k, f in (("mean", F.avg), ("var", F.var_pop))]).first()
    out, bad = hosts, F.lit(False)
    for r in RULES:
        mean, var = stats[f"mean_{r}"] or 0.0, stats[f"var_{r}"] or 0.0
        weight = min(PRIOR_MAX, max(1.0, mean * (1 - mean) / var - 1)) if var > 0 else PRIOR_MAX
        out = out.withColumn(f"rate_{r}", (F.col(f"n_{r}") + mean * weight) / (F.col("n_docs") + weight))
        bad = bad | (F.col(f"rate_{r}") > host_limit)
    return out.select("host", "n_docs", *[f"rate_{r}" for r in RULES], bad.alias("host_bad"))


def apply_quality_rules(docs: DataFrame, host_col: str = "source", host_limit: float = HOST_LIMIT) -> DataFrame:
    """One row per input row: the counts, the rule flags, base_failed, host_bad and kept."""
    counted = materialize(rule_counts(docs, host_col), "rules")
    hosts = materialize(host_verdicts(counted, host_limit), "verdicts")
    return (counted.join(small_or_shuffled(hosts.select("host", "host_bad")), "host", "left")
            .withColumn("host_bad", F.coalesce("host_bad", F.lit(False)))
            .withColumn("base_failed", F.col("fail_short") | F.col("fail_repeats"))
            .withColumn("kept", ~F.col("base_failed") & ~F.col("host_bad")))
