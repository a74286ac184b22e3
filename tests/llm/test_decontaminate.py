import random
from collections import Counter

import pyarrow as pa
import pytest

import helpers as H
from carestar.llm import decontaminate as C

ITEMS = "item_id long, text string"


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def tokens(text):
    return [w for w in (x.lower().strip(C._AROUND) for x in H.words(text)) if w]


def plain(rows, items):
    """Leaked (doc, item) pairs by comparing every window."""
    out = Counter()
    for i, t in rows:
        w = tokens(t)
        for item in {(k, x) for k, x in items if k is not None and x is not None}:
            b = tokens(item[1])
            if b and any(distance(w[s:s + len(b)], b) <= int(0.2 * len(b) + 1e-9) for s in range(max(1, len(w) - len(b) + 1))):
                out[i, item[0]] = 1
    return out


def test_bit_parallel_distance():
    rnd = random.Random(1)
    for _ in range(600):
        a, b = ([rnd.randint(0, 4) for _ in range(rnd.randint(0, 90 if rnd.random() < 0.1 else 12))] for _ in range(2))
        assert C.edit_distance(a, b) == distance(a, b)


def _corpus(seed, edits_up_to=1.0):
    rnd = random.Random(seed)
    word = lambda: f"t{rnd.randint(0, 400)}"
    items = [(k, " ".join(word() for _ in range(rnd.choice([1, 4, 5, 9, 15, 26, 40])))) for k in range(25)]
    rows = []
    for i in range(120):
        w = [word() for _ in range(rnd.randint(0, 60))]
        if rnd.random() < 0.6:
            item = rnd.choice(items)[1].split()
            for _ in range(int(rnd.random() * edits_up_to * 0.25 * len(item) + 0.5)):
                at = rnd.randrange(len(item))
                rnd.choice([lambda: item.insert(at, word()), lambda: item.__setitem__(at, word()),
                            lambda: len(item) > 1 and item.pop(at)])()
            cut = rnd.randint(0, len(w))
            w[cut:cut] = [rnd.choice([x, x.upper(), x + ",", '"' + x]) for x in item]
        rows.append((1000 + i, " ".join(w)))
    return rows, items


@pytest.mark.parametrize("seed", [2, 3])
def test_finds_what_brute_force_finds(spark, seed):
    rows, items = _corpus(seed)
    rows += H.AWKWARD
    items += [(None, "t1 t2"), (50, None), (51, ""), (52, "?!"), items[0]]
    got = C.leaks(H.docs(spark, rows, **H.CLASHES), spark.createDataFrame(items, ITEMS)).collect()
    found, want = Counter((r["doc_id"], r["item_id"]) for r in got), plain(rows, items)
    assert not found - want                                            # verification is exact
    assert sum((want & found).values()) >= 0.98 * sum(want.values())   # the target recall
    text = dict(r for r in rows if r[0] is not None)
    for r in got:
        if r["doc_id"] is not None:
            assert 0 < r["n_words"] and r["first_word"] + r["n_words"] <= len(H.words(text[r["doc_id"]]))


def test_recall_at_the_radius():
    rnd = random.Random(9)
    items = [" ".join(f"t{rnd.randint(0, 5000)}" for _ in range(n)) for n in (15, 24, 33, 47, 60) for _ in range(4)]
    index = C.ItemIndex(list(range(len(items))), items, C.SIMILARITY, C.RECALL)
    texts, want = [], []
    for _ in range(400):
        k = rnd.randrange(len(items))
        w = items[k].split()
        for at in rnd.sample(range(len(w)), int(0.2 * len(w))):
            w[at] = "other"
        texts.append(" ".join(["x"] * 20 + w + ["y"] * 20))
        want.append(k)
    found = {(t, i) for t, i, *_ in index.matches(pa.array(texts))}
    assert sum((t, k) in found for t, k in enumerate(want)) >= 0.97 * len(want)


def test_parts_of_a_large_benchmark_and_filter(spark, monkeypatch):
    rows, items = _corpus(4, 0.0)
    df, bench = H.docs(spark, rows, **H.CLASHES), spark.createDataFrame(items, ITEMS)
    whole = Counter((r["doc_id"], r["item_id"]) for r in C.leaks(df, bench).collect())
    monkeypatch.setattr(C, "PART_BYTES", 1500)
    assert Counter((r["doc_id"], r["item_id"]) for r in C.leaks(df, bench).collect()) == whole
    clean = C.clean_documents(df, bench)
    assert set(clean.columns) == set(df.columns)
    assert {r["doc_id"] for r in clean.collect()} == {i for i, _ in rows} - {i for i, _ in whole}


def test_closest_passage():
    rnd = random.Random(3)
    for _ in range(200):
        a, b = ([rnd.randint(0, 3) for _ in range(rnd.randint(1, n))] for n in (9, 20))
        least, end = C.closest_passage(a, b)
        every = {(i, j): distance(a, b[i:j]) for i in range(len(b) + 1) for j in range(i, len(b) + 1)}
        assert least == min(every.values())
        assert min(d for (_, j), d in every.items() if j == end) == least


def _damaged(words, share, rnd):
    """Words with that share of edits: half of them substitutions, the others insertions and deletions."""
    out = list(words)
    for _ in range(int(share * len(words))):
        at = rnd.randrange(len(out))
        kind = rnd.random()
        if kind < 0.5:
            out[at] = f"e{rnd.randint(0, 999)}"
        elif kind < 0.75:
            out.insert(at, f"e{rnd.randint(0, 999)}")
        else:
            out.pop(at)
    return out


@pytest.mark.parametrize("size, copies", [(120, 40), (1000, 20), (5000, 6)])
def test_long_items(size, copies):
    """Items that are cut into blocks are found at any share of edits within the limit, and not beyond it."""
    rnd = random.Random(size)
    word = lambda: f"t{rnd.randint(0, 5000)}"
    items = [[word() for _ in range(size)] for _ in range(2)]
    index = C.ItemIndex([7, 8], [" ".join(x) for x in items], C.SIMILARITY, C.RECALL)
    assert max(index.classes) <= C.LONG and max(c.repetitions for c in index.classes.values()) < 400
    texts, want = [], set()
    for t in range(copies):
        k, share = t % 2, (0.0, 0.05, 0.12, 0.17, 0.3)[t // 2 % 5]
        found = _damaged(items[k], share, rnd)
        texts.append(" ".join([word() for _ in range(rnd.randint(0, 50))] + found + [word() for _ in range(rnd.randint(0, 50))]))
        if share <= 0.2:
            want.add((t, 7 + k))
    got = index.matches(pa.array(texts + ["short text", " ".join(items[0][:size // 2])]))
    assert {(t, i) for t, i, *_ in got} - want == set()
    assert len({(t, i) for t, i, *_ in got} & want) >= 0.95 * len(want)
    for t, i, first, n, edits in got:
        row = texts[t].split()[first:first + n]
        assert n <= size and C.edit_distance([hash(x) for x in items[i - 7]], [hash(x) for x in row]) == edits <= size // 5


def test_a_very_long_item_and_its_whole_way(spark):
    rnd = random.Random(50)
    item = [f"t{rnd.randint(0, 50000)}" for _ in range(50_000)]
    rows = [(1, " ".join(_damaged(item, 0.1, rnd))), (2, " ".join(item[:30_000])), (3, "clean text"), (4, " ".join(item[::-1]))]
    got = C.leaks(H.docs(spark, rows), spark.createDataFrame([(9, " ".join(item)), (10, "clean text of others")], ITEMS)).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == {(1, 9)}


def test_rows_are_judged_one_by_one(spark):
    """Leaking rows without a doc_id go; a clean row stays though another one of its doc_id leaks."""
    item = " ".join(f"t{i}" for i in range(20))
    rows = [(None, "a " + item), (None, "clean"), (None, None), (5, item + " b"), (5, "also clean"), (6, item), (6, item), (7, "x")]
    left = C.clean_documents(H.docs(spark, rows, **H.CLASHES, text_h=1), spark.createDataFrame([(1, item)], ITEMS))
    assert sorted(((r["doc_id"], r["text"]) for r in left.collect()), key=str) == sorted([(None, "clean"), (None, None), (5, "also clean"), (7, "x")], key=str)


def test_empty_tables(spark):
    none = spark.createDataFrame([], ITEMS)
    assert C.leaks(H.empty(spark), none).count() == 0
    assert C.leaks(H.awkward(spark), none).count() == 0
    assert C.clean_documents(H.awkward(spark), none).count() == len(H.AWKWARD)
