import random

import numpy as np
import pytest

import helpers as H
from carestar.llm import linear, quality_classifier, toxicity

DATA = "/root/testdata/sf0.01"
LABELS = "doc_id long, quality int, toxic int"


def held_out(df, labels, label):
    rows = df.join(labels, "doc_id").where("held_out").select("score", "predicted", label).collect()
    y, p, s = (np.array([r[k] for r in rows]) for k in (label, "predicted", "score"))
    order = np.argsort(s)
    rank = np.empty(len(s))
    rank[order] = np.arange(len(s))
    ones = (y == 1).sum()
    return (y == p).mean(), (rank[y == 1].sum() - ones * (ones - 1) / 2) / (ones * (len(y) - ones))


def test_quality_on_held_out_labels(spark):
    docs, labels = spark.read.parquet(f"{DATA}/documents.parquet"), spark.read.parquet(f"{DATA}/labels.parquet")
    accuracy, auc = held_out(quality_classifier.quality_scores(docs, labels), labels, "quality")
    assert accuracy >= 0.95 and auc >= 0.98


def test_toxicity_on_held_out_labels(spark):
    docs, labels = spark.read.parquet(f"{DATA}/documents.parquet"), spark.read.parquet(f"{DATA}/labels.parquet")
    accuracy, auc = held_out(toxicity.toxicity_scores(docs, labels), labels, "toxic")
    assert accuracy >= 0.93 and auc >= 0.85


@pytest.mark.parametrize("scores", [quality_classifier.quality_scores, toxicity.toxicity_scores])
def test_awkward_rows_and_missing_labels(spark, scores):
    labels = spark.createDataFrame([(1, 1, 0), (6, 0, 1), (9, None, None), (9, 1, 1), (9, 0, 0), (None, 1, 1), (777, 0, 1)], LABELS)
    for given in (labels, labels.limit(0)):
        rows = scores(H.awkward(spark), given).collect()
        assert len(rows) == len(H.AWKWARD)
        assert all(0 <= r["score"] <= 1 and r["predicted"] in (0, 1) for r in rows)
        assert {r["held_out"] for r in rows if r["doc_id"] is None} == {False}
    assert scores(H.empty(spark), labels).count() == 0


def test_labels_of_the_held_out_fold_are_never_read(spark):
    import zlib
    docs, labels = spark.read.parquet(f"{DATA}/documents.parquet"), spark.read.parquet(f"{DATA}/labels.parquet")
    turned = labels.selectExpr("doc_id", "if(crc32(cast(cast(doc_id as string) as binary)) % 5 = 0, 1 - quality, quality) as quality",
                               "toxic")
    a, b = (quality_classifier.fit(docs, x) for x in (labels, turned))
    assert np.array_equal(a, b)
    rows = quality_classifier.classify(docs, a).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)


def test_updates_follow_the_textbook():
    """One coordinate at a time, as the algorithm is written down."""
    rnd = random.Random(1)
    rows = [sorted(rnd.sample(range(8), 3)) for _ in range(60)]
    y = [float(0 in r) for r in rows]
    starts, index = np.arange(0, 181, 3), np.array([i for r in rows for i in r])
    got = linear.ftrl(starts, index, np.ones(180), np.array(y), 8, epochs=1)
    z, n = [0.0] * 9, [0.0] * 9

    def weight(i):
        if abs(z[i]) <= linear.L1:
            return 0.0
        return -(z[i] - np.sign(z[i]) * linear.L1) / ((linear.BETA + n[i] ** 0.5) / linear.ALPHA + linear.L2)

    for r, t in zip(rows, y):
        w = {i: weight(i) for i in [*r, 8]}
        g = 1 / (1 + np.exp(-sum(w.values()))) - t
        for i in w:
            s = ((n[i] + g * g) ** 0.5 - n[i] ** 0.5) / linear.ALPHA
            z[i] += g - s * w[i]
            n[i] += g * g
    assert np.allclose(got, [weight(i) for i in range(9)])


def test_label_model_recovers_accuracies_and_joins_correlated_voters():
    rng = np.random.default_rng(0)
    n, m = 40_000, toxicity.VOTERS
    y = rng.random(n) < 0.2
    hit = np.where(y[:, None], 0.85, 0.08)
    v = rng.random((n, m)) < hit
    v[:, 3] = v[:, 2] ^ (rng.random(n) < 0.02)                      # a near copy of voter 2
    numbers, counts = np.unique(toxicity.pattern_numbers(v), return_counts=True)
    model = toxicity.LabelModel(numbers, counts)
    assert any({2, 3} <= set(g) for g in model.groups)
    assert ((model.posterior(toxicity.pattern_numbers(v)) > 0.5) == y).mean() > 0.99
    assert abs(1 / (1 + np.exp(-model.prior)) - 0.2) < 0.02
