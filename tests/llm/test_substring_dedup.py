import hashlib
import random
from collections import Counter

import pytest

import helpers as H
from carestar.llm import substring_dedup as S


def plain(rows, window):
    first = {}
    for i, t in rows:
        w = H.words(t)
        for k in range(len(w) - window + 1):
            if i is not None:
                first[tuple(w[k:k + window])] = min(first.get(tuple(w[k:k + window]), i), i)
    out = []
    for i, t in rows:
        w, gone = H.words(t), set()
        for k in range(len(w) - window + 1):
            if i is not None and first[tuple(w[k:k + window])] < i:
                gone.update(range(k, k + window))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return Counter(out)


def test_levels_double():
    assert [S.levels(w) for w in (50, 51, 60, 100, 200)] == [[25, 50], [25, 50, 51], [25, 50, 60], [25, 50, 100], [25, 50, 100, 200]]
    assert S.levels(9, 1) == [1, 2, 4, 8, 9]


@pytest.mark.parametrize("window,seed,base", [(2, 0, 1), (5, 1, 25), (9, 3, 1), (50, 4, 25), (100, 5, 25), (200, 6, 25)])
def test_equals_brute_force(spark, window, seed, base):
    rnd = random.Random(seed)
    passages = [[rnd.choice("abcdefgh") + str(rnd.randint(0, 9)) for _ in range(rnd.randint(window, 3 * window))] for _ in range(6)]
    rows = []
    for i in range(120):
        w = []
        for _ in range(rnd.randint(0, 5)):
            w += rnd.choice(passages) if rnd.random() < 0.5 else [rnd.choice("xyz") + str(rnd.randint(0, 99)) for _ in range(rnd.randint(1, 2 * window))]
        rows.append((rnd.randint(-20, 100), " ".join(w)))
    rows += rows[:9] + H.AWKWARD
    got = S.remove_repeats(H.docs(spark, rows, **H.CLASHES), window, keep_text=False, base=base).collect()
    assert Counter(map(tuple, got)) == plain(rows, window)


def test_kept_text_and_empty_table(spark):
    rows = [(1, "a b c d e"), (2, "x a b c d e y")]
    got = {r["doc_id"]: r["kept_text"] for r in S.remove_repeats(H.docs(spark, rows), 5).collect()}
    assert got == {1: "a b c d e", 2: "x y"}
    assert S.remove_repeats(H.empty(spark)).count() == 0


def test_an_empty_level_ends_the_work(spark, monkeypatch):
    rows = [(i, " ".join(f"w{i}_{k}" for k in range(300))) for i in range(6)] + [(7, "same " * 40), (8, "same " * 40)]
    made, next_level = [], S._next_level
    monkeypatch.setattr(S, "_next_level", lambda *a: made.append(a[1:3]) or next_level(*a))
    got = S.remove_repeats(H.docs(spark, rows), 200, keep_text=False).collect()
    assert Counter(map(tuple, got)) == plain(rows, 200) and made == []
    rows.append((9, " ".join(rows[0][1].split()[20:280])))
    got = S.remove_repeats(H.docs(spark, rows), 200, keep_text=False).collect()
    assert Counter(map(tuple, got)) == plain(rows, 200) and made == [(25, 50), (50, 100)]
