"""The whole queries op2 and op9 against plain versions, document by document, on a small table."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

import helpers as H
from carestar.llm import linear, queries, toxicity
from carestar.llm.words import hash_words

MASK = (1 << 64) - 1
SIZE = 1 << linear.BITS


def mix(x):
    x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 & MASK
    x = (x ^ x >> 27) * 0x94D049BB133111EB & MASK
    return x ^ x >> 31


def unit(hashes):
    counts = Counter(h >> 64 - linear.BITS for h in hashes)
    return {f: math.sqrt(n / sum(counts.values())) for f, n in counts.items()}


def sigmoid(x):
    return 1 / (1 + math.exp(-max(-35, min(35, x))))


def weight(z, n):
    return -(z - math.copysign(linear.L1, z)) / ((linear.BETA + math.sqrt(n)) / linear.ALPHA + linear.L2) if abs(z) > linear.L1 else 0.0


def plain_training(examples):
    """Weights from (features, label) in order; feature -1 is the bias."""
    z, n = Counter(), Counter()
    for _ in range(linear.EPOCHS):
        for features, y in examples:
            x = {**features, -1: 1.0}
            w = {f: weight(z[f], n[f]) for f in x}
            p = sigmoid(sum(w[f] * v for f, v in x.items()))
            for f, v in x.items():
                g = (p - y) * v
                z[f] += g - (math.sqrt(n[f] + g * g) - math.sqrt(n[f])) / linear.ALPHA * w[f]
                n[f] += g * g
    return {f: weight(z[f], n[f]) for f in z}


def plain_score(w, features):
    return sigmoid(sum(w.get(f, 0.0) * v for f, v in features.items()) + w.get(-1, 0.0))


def quality_features(text):
    found, cores = [], []
    for word in H.words(text):
        m = re.search(r"[^\w\s.,;:'’()\"-]+$", word)
        if m:
            found.append(xxhash.xxh3_64_intdigest("tail " + m.group()))
            word = word[:m.start()]
        if len(word) > 1 and word.isupper():
            found.append(2)
        cores.append(xxhash.xxh3_64_intdigest(word.lower().strip(".,;:'’()\"-")))
    found += cores + [(3 * a + 5 * b) & MASK for a, b in zip(cores, cores[1:])]
    found += [1 + 16 * back for back in (1, 2, 3) for a, b in zip(cores, cores[back:]) if a == b]
    return unit([mix(x) for x in found])


def cores_of(text):
    found = (re.search(r"[^\W\d_]+", w) for w in H.words(text))
    return [m.group().lower() if m else "" for m in found]


def plain_lexicons(sample):
    toxic, counts = sum(y for _, y in sample), {}
    for text, y in sample:
        held = Counter(c[:k] for c in cores_of(text) for k in range(toxicity.SHORTEST, toxicity.LONGEST + 1) if len(c) >= k)
        for term, n in held.items():
            c = counts.setdefault(term, {1: [0, 0], 2: [0, 0]})
            for times in (1, 2):
                c[times][y] += n >= times

    def best(times, limit):
        known = {}
        for term, c in counts.items():
            clean, hits = c[times]
            odds = math.log((hits + 0.5) / (toxic + 1)) - math.log((clean + 0.5) / (len(sample) - toxic + 1))
            if hits >= max(5, toxicity.LEAST_SHARE * toxic) and odds >= limit:
                known[term] = (hits, odds)
        assert len(known) <= toxicity.MAX_TERMS
        kept = {t for t, (n, s) in known.items()
                if not any(u != t and t.startswith(u) and m > 1.2 * n and o >= s - 0.5 for u, (m, o) in known.items())}
        return {t for t in kept if not any(u != t and u.startswith(t) and known[u][0] >= known[t][0] / 1.2 for u in kept)}

    sure = best(1, toxicity.SURE_ODDS)
    return sure, best(2, toxicity.PATTERN_ODDS) - sure


def plain_hits(text, sure, pattern):
    a = b = p = 0
    for c in cores_of(text):
        begins = [c[:k] for k in range(toxicity.SHORTEST, min(toxicity.LONGEST, len(c)) + 1)]
        first = next((t for t in begins if t in sure), None)
        a += first is not None and sum(map(ord, first)) % 2 == 0
        b += first is not None and sum(map(ord, first)) % 2 == 1
        p += any(t in pattern for t in begins)
    return a, b, p


def plain_votes(a, b, p, words):
    share = (a + b + p) / max(words, 1)
    return [a > 0, b > 0, a + b > 1, a + b > 2, p > 1, p > 2, p > 3, a + b + p > 3,
            share >= 0.005 and a + b + p > 1, share >= 0.02 and a + b + p > 1]


def toxic_features(text, sure, pattern):
    cores, (a, b, p) = cores_of(text), plain_hits(text, sure, pattern)
    hashes = hash_words(pa.array(cores + [c[:5] for c in cores], pa.string())).tolist()
    dense = (plain_votes(a, b, p, len(cores)) + [a + b > k for k in range(6)] + [p > k for k in range(8)] + [a + b + p > k for k in range(8)])
    return {**unit(hashes), **{SIZE + i: 1.0 for i, d in enumerate(dense) if d}}


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rnd, at = random.Random(7), tmp_path_factory.mktemp("classified")
    vocabulary = ["".join(rnd.choice("abcdehilmnorst") for _ in range(rnd.randint(2, 9))) for _ in range(150)]
    rows, labels = [], []
    for i in range(160):
        quality, toxic = int(rnd.random() < 0.6), int(rnd.random() < 0.3)
        words = [rnd.choice(vocabulary) for _ in range(rnd.randint(5, 60))]
        if toxic:
            words += rnd.choices(["vilest", "vilely", "wretchedly", "Scum!!", "scumbag"], k=rnd.randint(1, 6))
        if not quality:
            words += [rnd.choice(["BUY", "now!!!", "$$$", "click", "click"]) for _ in range(12)]
        rnd.shuffle(words)
        rows.append((i, " ".join(words)))
        labels.append((i, quality, toxic))
    rows += [(200, None), (201, ""), (202, " \n"), (203, "ÉTÉ straße 12 _ …"), (None, "no id vilest scum"), rows[3]]
    labels += [(200, 0, 0), (201, 1, 1), (999, 1, 1)]
    H.docs(spark, rows).write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    order = H.docs(spark, rows).select("doc_id", "text", F.xxhash64("doc_id", "text").alias("o")).orderBy("o").collect()
    return str(at), [(r["doc_id"], r["text"]) for r in order], {i: (q, t) for i, q, t in labels}


def fold(i):
    return zlib.crc32(str(i).encode()) % 5


def compare(got, rows, scores, threshold):
    want = sorted(((-1 if i is None else i), i is not None and fold(i) == 0, s) for (i, _), s in zip(rows, scores))
    have = sorted(((-1 if r["doc_id"] is None else r["doc_id"]), r["held_out"], r["score"], r["predicted"]) for r in got.collect())
    assert [w[:2] for w in want] == [h[:2] for h in have]
    assert np.allclose([w[2] for w in want], [h[2] for h in have], atol=1e-4)
    assert all(h[3] == (h[2] >= threshold) for h in have)
    assert min(scores) < 0.1 and max(scores) > 0.9


def test_quality_query(spark, folder):
    path, rows, labels = folder
    w = plain_training([(quality_features(t), labels[i][0]) for i, t in rows if i in labels and fold(i) != 0])
    compare(queries.op2_quality_classifier(spark, path), rows, [plain_score(w, quality_features(t)) for _, t in rows], 0.3)


def test_toxicity_query(spark, folder):
    path, rows, labels = folder
    sure, pattern = plain_lexicons([(t, labels[i][1]) for i, t in rows if i in labels and fold(i) != 0])
    assert sure
    numbers = [sum(1 << k for k, v in enumerate(plain_votes(*plain_hits(t, sure, pattern), len(H.words(t)))) if v) for _, t in rows]
    counts = sorted(Counter(numbers).items())
    model = toxicity.LabelModel(np.array([k for k, _ in counts]), np.array([n for _, n in counts]))
    features = [toxic_features(t, sure, pattern) for _, t in rows]
    w = plain_training(list(zip(features, model.posterior(np.array(numbers)).tolist())))
    compare(queries.op9_toxicity(spark, path), rows, [plain_score(w, f) for f in features], 0.5)
