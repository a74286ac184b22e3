import datetime as dt
import random

from bruteforce import readmission_pairs_bruteforce
from carestar.operators.readmission import readmission_counts

IDX = "e1 long, patient long, grp string, discharge timestamp_ntz"
CAND = "e2 long, patient long, t timestamp_ntz"
T0 = dt.datetime(2024, 3, 1, 12, 0, 0)


def run(spark, idx, cand):
    a = spark.createDataFrame(idx, IDX)
    c = spark.createDataFrame(cand, CAND)
    fast = {r.grp: (r.index_stays, r.readmissions) for r in readmission_counts(a, c).collect()}
    # with start known: a stay is only set apart when it starts after its discharge
    t = {e: x for e, _, x in cand}
    timed = spark.createDataFrame([(*r, t.get(r[0], r[3])) for r in idx], IDX + ", start timestamp_ntz")
    assert {r.grp: (r.index_stays, r.readmissions) for r in readmission_counts(timed, c).collect()} == fast
    slow = {r.grp: (r.index_stays, r.readmissions) for r in readmission_pairs_bruteforce(a, c).collect()}
    return fast, slow


def test_boundaries(spark):
    d = dt.timedelta
    idx = [(1, 7, "A", T0)]
    cand = [(10, 7, T0),                         # same instant: excluded (strict >)
            (11, 7, T0 + d(seconds=1)),          # one second later: included
            (12, 7, T0 + d(days=30)),            # exactly 30 days: included
            (13, 7, T0 + d(days=30, seconds=1)),  # 30 days + 1 s: excluded
            (14, 8, T0 + d(days=1))]             # other patient
    fast, slow = run(spark, idx, cand)
    assert fast == slow == {"A": (1, 2)}


def test_self_match_excluded_and_shared_readmission(spark):
    d = dt.timedelta
    # e1=1 is discharged before its own admission: it may not count itself
    idx = [(1, 5, "A", T0), (2, 5, "B", T0 - d(days=2)), (3, 5, "A", T0 - d(days=1))]
    cand = [(1, 5, T0 + d(hours=1)), (4, 5, T0 + d(days=3))]
    fast, slow = run(spark, idx, cand)
    assert fast == slow
    assert fast["B"] == (1, 2)          # one readmission counts in both specialties


def test_random_against_bruteforce(spark):
    rnd = random.Random(11)
    idx, cand = [], []
    for i in range(400):
        p = rnd.choice([0, 0, 0, 1, 2, 3, 4, 5])         # patient 0 is hot
        t = T0 + dt.timedelta(seconds=rnd.randint(0, 200 * 86400))
        idx.append((i, p, rnd.choice("ABC"), t))
        if rnd.random() < 0.7:
            cand.append((i, p, t - dt.timedelta(seconds=rnd.randint(-3 * 86400, 86400))))
    for j in range(400, 700):
        cand.append((j, rnd.randint(0, 5), T0 + dt.timedelta(seconds=rnd.randint(0, 220 * 86400))))
    fast, slow = run(spark, idx, cand)
    assert fast == slow
