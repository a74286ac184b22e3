from collections import Counter

import helpers as H
from carestar.llm import quality_rules as Q


def plain(text):
    w = H.words(text)
    grams = Counter(zip(w, w[1:], w[2:]))
    covered = {i + k for i in range(len(w) - 2) for k in range(3) if grams[tuple(w[i:i + 3])] > 1}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if H.words(line):
            dup += line in seen
            seen.add(line)
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(covered))


def test_counts_equal_plain_version_on_awkward_rows(spark):
    got = Q.apply_quality_rules(H.awkward(spark)).select("doc_id", *[c for c in Q.COUNTS if c != "n_lines"]).collect()
    assert Counter(map(tuple, got)) == Counter((i, *plain(t)) for i, t in H.AWKWARD)


def test_empty_table(spark):
    assert Q.apply_quality_rules(H.empty(spark)).count() == 0


def test_host_verdicts_shrink_and_come_back_to_documents(spark):
    good, bad = " ".join(f"word{i}" for i in range(80)), " ".join(f"word{i} ###" for i in range(60))
    rows = [(i, bad if i % 3 == 0 else good) for i in range(90)]          # s0 is all symbols
    out = {r["doc_id"]: r for r in Q.apply_quality_rules(H.docs(spark, rows)).collect()}
    assert all(out[i]["kept"] == (i % 3 != 0) and not out[i]["base_failed"] for i in range(90) if i not in (4, 5))
    one = [(i, good) for i in range(1, 60)] + [(0, bad)]
    out = {r["doc_id"]: r for r in Q.apply_quality_rules(H.docs(spark, one)).collect()}
    assert out[0]["kept"] and not out[0]["host_bad"]                       # one bad page does not condemn its host
