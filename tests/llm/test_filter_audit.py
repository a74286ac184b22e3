import collections
import random
import re
from itertools import permutations

import numpy as np
import helpers as H

from carestar.llm import filter_audit as FA

COLUMNS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def plain(rows, labels):
    """The audit document by document. rows: (doc_id, text, source)."""
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    first = {}
    for i, t, _ in rows:
        if i is not None:
            first[t or ""] = min(first.get(t or "", i), i)
    fails = collections.defaultdict(list)
    for i, t, part in rows:
        t = t or ""
        w = H.words(t)
        f = {"A": len(w) < 50, "B": 100 * len(set(w)) < 65 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 5 * len(t),
             "D": bool(re.search(r"[#$%&*|]", t)), "E": i is not None and first[t] < i}
        fails[part or ""].append((i, f))
    out = {}
    for part, docs in fails.items():
        total = collections.Counter()
        for order in map("".join, permutations("ABCDE")):
            left = docs
            for k, x in enumerate(order):
                gone, stay = [i for i, f in left if f[x]], [(i, f) for i, f in left if not f[x]]
                failing = sum(f[x] for _, f in docs)
                out[part, order, k + 1] = [len(stay), len(gone), failing - len(gone),
                                           sum(f[x] and sum(f.values()) == 1 for _, f in docs),
                                           sum(i in good for i in gone), sum(i in toxic for i in gone)]
                total[x] += len(gone)
                left = stay
        for (p, order, k), v in out.items():
            if p == part:
                v.append(total[order[k - 1]])
    return out


def result(df):
    rows = df.collect()
    out = {(r["part"], r["filter_order"], r["step"]): [r[c] for c in COLUMNS] for r in rows}
    assert len(out) == len(rows)
    return out


def corpus():
    rnd = random.Random(3)
    long = [" ".join(rnd.choice("abcdefghij") * rnd.randint(1, 9) for _ in range(80)) for _ in range(6)]
    rows = list(H.AWKWARD) + [(100 + i, long[i % 6] + (" #" if i % 4 == 0 else "")) for i in range(30)]
    rows += [(200, "ABC " * 60), (201, "Word " * 60), (201, "Word " * 60), (202, "Word " * 60), (None, "Word " * 60), (90, long[0])]
    return rows


LABELS = [(1, 1, 0), (1, 0, 1), (9, 1, 1), (100, 1, 0), (106, 1, 1), (201, None, 1), (None, 1, 1), (112, 1, None), (118, 0, 0)]


def test_against_a_plain_version(spark):
    docs = H.docs(spark, corpus(), **H.CLASHES)
    rows = [(r["doc_id"], r["text"], r["source"]) for r in docs.collect()]
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")
    assert result(FA.filter_audit(docs, labels)) == plain(rows, LABELS)


def test_a_third_of_the_rows_equal_and_one_id_in_two_sources(spark):
    docs = spark.createDataFrame([(7, "same text", "a")] * 40 + [(7, "same text", "b")] * 3 + [(i, "same text", "a") for i in range(8, 48)]
                                 + [(None, "same text", "b")] * 5, "doc_id long, text string, source string")
    labels = spark.createDataFrame([(7, 1, 1), (8, 1, 0)], "doc_id long, quality int, toxic int")
    rows = [tuple(r) for r in docs.collect()]
    assert result(FA.filter_audit(docs, labels)) == plain(rows, [tuple(r) for r in labels.collect()])


def test_empty_tables(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert FA.filter_audit(H.empty(spark), labels).count() == 0
    assert FA.filter_audit(H.docs(spark, [(1, "x")]), labels).count() == 600


def test_the_walk_visits_every_set_of_filters():
    rng = np.random.default_rng(1)
    for n in range(1, 7):
        masks = rng.permutation(1 << n)
        values = rng.integers(0, 50, (3, 1 << n, 2))
        states = FA.gray_walk(masks, values, n)
        for chosen in range(1 << n):
            assert (states[chosen] == values[:, masks & chosen == 0].sum(1)).all()
