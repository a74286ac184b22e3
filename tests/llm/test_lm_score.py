import math
import random
import tracemalloc
from collections import Counter

import pyarrow as pa
import pytest

import helpers as H
from carestar.llm import lm_score as L


def plain(rows, order, min_count, backoff):
    grams, total = Counter(), 0
    for _, t in rows:
        w = H.words(t)
        total += len(w)
        for k in range(1, order + 1):
            grams.update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out, shift = [], round(math.log(total) * 1_000_000)
    for i, t in rows:
        w, value, backed = H.words(t), 0, 0
        for p in range(len(w)):
            cost = 0
            for k in range(min(order, p + 1), 1, -1):
                if grams[tuple(w[p - k + 1:p + 1])] >= min_count:
                    s = backoff ** cost * grams[tuple(w[p - k + 1:p + 1])] / grams[tuple(w[p - k + 1:p])]
                    value += round(math.log(s) * 1_000_000)
                    break
                cost += 1
            else:
                value += round(math.log(backoff ** cost * grams[w[p],]) * 1_000_000) - shift
                backed += 1
        out.append((i, len(w), backed, value))
    return Counter(out)


@pytest.mark.parametrize("order", [1, 2, 3, 5])
def test_equals_plain_counts(spark, order):
    rows = H.AWKWARD + [(100 + i, "the cat sat on the mat " * (i % 4) + f"word{i % 7} the cat") for i in range(40)]
    got = L.lm_scores(H.docs(spark, rows, **H.CLASHES), order).collect()
    assert Counter(map(tuple, got)) == plain(rows, order, L.MIN_COUNT, L.BACKOFF)


def test_memory_of_a_block():
    """All levels of one block, of the size that the operator deals, in numpy arrays (86 MB; 190 MB when blocks had 8 MB)."""
    rnd, texts, size = random.Random(1), [], 0
    while size < L.BLOCK_BYTES:
        texts.append(" ".join(f"w{rnd.randint(0, 3000)}" for _ in range(200)))
        size += len(texts[-1])
    docs, totals = pa.table({"doc_id": pa.array(range(len(texts))), "text": texts}), None
    tracemalloc.start()
    for level in range(2):
        asked = L._ask(3, level, 2, 24)((pa.scalar(0),), docs, *([totals] if level else []))
        answers = asked.select(["block", "bucket", "n"]).append_column("level", pa.array([level] * len(asked), pa.int32()))
        totals = pa.concat_tables([totals, answers]) if level else answers
    scores = L._score(3, 2, 0.4)((pa.scalar(0),), docs, totals)
    peak = tracemalloc.get_traced_memory()[1] >> 20
    tracemalloc.stop()
    print(f"PEAK {peak} MB")
    assert len(scores) == len(docs) and peak < 120


def test_empty_table(spark):
    assert L.lm_scores(H.empty(spark)).count() == 0
