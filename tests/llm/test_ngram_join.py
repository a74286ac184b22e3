import random

import helpers as H
import numpy as np

from carestar.llm import ngram_join as J, queries

SF = "/root/testdata/sf0.001"


def gram_set(text, n=3):
    w = H.words("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return frozenset(tuple(w[i:i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])


def plain(rows, n=3, percent=90):
    """(n_shingles, component) of each row by comparing all pairs of sets."""
    sets = [gram_set(t, n) for _, t in rows]
    distinct = list(dict.fromkeys(s for s in sets if s))
    inside = {}
    for i, s in enumerate(distinct):
        for g in s:
            inside.setdefault(g, []).append(i)
    linked = set()
    for i, s in enumerate(distinct):
        both = {}
        for g in s:
            for j in inside[g]:
                if j < i:
                    both[j] = both.get(j, 0) + 1
        linked |= {(i, j) for j, k in both.items() if 100 * k >= percent * (len(s) + len(distinct[j]) - k)}
    root = H.components(range(len(distinct)), linked)
    place = {s: root[i] for i, s in enumerate(distinct)}
    head = {}
    for (i, _), s in zip(rows, sets):
        if s and i is not None:
            head[place[s]] = min(head.get(place[s], i), i)
    return sorted((str(i), len(s), str(head.get(place[s]) if s else i)) for (i, _), s in zip(rows, sets))


def result(df):
    return sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"])) for r in df.collect())


def near_copies(rnd, n, words=120, edits=4):
    base = [f"b{rnd.randint(0, 10 ** 6)}" for _ in range(words)]
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(rnd.randint(0, edits)):
            w[rnd.randrange(len(w))] = f"e{rnd.randint(0, 10 ** 6)}"
        out.append(" ".join(w))
    return out


def test_query_against_all_pairs(spark):
    rows = [(r["doc_id"], r["text"]) for r in queries.table(spark, SF, "documents").collect()]
    got = result(queries.op12_ngram_join(spark, SF))
    assert got == plain(rows)
    assert any(a != c for a, _, c in got)


def test_awkward_rows_and_near_copies_of_all_sizes(spark):
    rnd = random.Random(5)
    texts = [t for words, edits in ((9, 1), (12, 1), (21, 1), (30, 2), (60, 2), (400, 15), (3000, 60)) for t in near_copies(rnd, 12, words, edits)]
    texts += [" ".join(t.split()[:-rnd.randint(1, 2)]) for t in texts[:60]] + [texts[3].upper(), texts[3].replace(" ", "\n  ")]
    rows = list(H.AWKWARD) + [(1000 + i, t) for i, t in enumerate(texts)] + [(None, texts[40]), (None, "only here and without an id")]
    assert result(J.near_duplicates(H.docs(spark, rows, **H.CLASHES, node=1, sign=3, size=4, u=5, v=6))) == plain(rows)


def test_large_group_of_near_copies_without_a_centre(spark, monkeypatch):
    """Copies that differ from each other about as often as the limit allows, in blocks; a third of all rows is one text."""
    monkeypatch.setattr(J, "BLOCK", 16)
    rnd = random.Random(6)
    rows = [(i, t) for i, t in enumerate(near_copies(rnd, 250, 100, 3) + near_copies(rnd, 60, 20, 1))]
    rows += [(5000 + i, rows[7][1]) for i in range(150)]
    assert result(J.near_duplicates(H.docs(spark, rows))) == plain(rows)


def test_other_sizes_and_limits(spark):
    rnd = random.Random(8)
    rows = [(i, t) for i, t in enumerate(near_copies(rnd, 40, 80, 6))]
    assert result(J.near_duplicates(H.docs(spark, rows), n=5, percent=70)) == plain(rows, 5, 70)


def test_empty_table(spark):
    assert J.near_duplicates(H.empty(spark)).collect() == []


def test_bands_and_signatures_cover_every_linked_pair():
    starts, parts = J.table_params()
    band = lambda s: int(np.searchsorted(starts, s, "right")) - 1
    for a in range(1, 400):
        for b in range(a, a * 10 // 9 + 1):
            assert band(b) - band(a) <= 1
            apart, table = J.most_apart(a + b), band(a)
            assert apart < parts[table] * (J.OPEN + 1) or (parts[table] == 0 and apart == 0)
