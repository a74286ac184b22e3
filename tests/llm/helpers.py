"""Small tables that hold the awkward cases, and plain versions of shared pieces."""

from __future__ import annotations

import re

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")

AWKWARD = [
    (1, "alpha beta gamma delta epsilon zeta\nsecond line of words here\n\nalpha beta gamma delta epsilon zeta"),
    (2, None), (3, ""), (4, " \t\n \r\n"), (5, "…!?"), (6, "one"), (7, "x" * 30_000),
    (8, " ".join(f"w{i % 997}" for i in range(20_000))), (9, "tie tie tie tie tie tie"), (9, "tie tie tie tie tie tie"),
    (10, "alpha beta gamma delta epsilon zeta\nsecond line of words here"), (None, "no id but some words here"),
    (None, None), (11, "\x00 odd   characters \U0001F600 ▁ here"), (-5, "negative id words are fine"),
    (12, " ".join(["nbsp joined"] * 60)),
]


def docs(spark, rows, **more):
    """A documents table; ``more`` adds constant columns, such as names that operators use themselves."""
    full = [(i, t, None if i == 2 else "en", None if i in (4, 5) else f"s{(i or 0) % 3}", len(t) if t is not None else None)
            for i, t in rows]
    df = spark.createDataFrame(full, DOC_SCHEMA)
    for name, value in more.items():
        from pyspark.sql import functions as F
        df = df.withColumn(name, F.lit(value))
    return df


CLASHES = {"n_words": 1, "fp": 2, "block": 3, "text_hash": 4, "h": 5, "json": "x", "score": 0.5, "key": 6, "root": 7,
           "component_id": 8, "removed": 9, "hash": 10, "host": "q", "row": 11, "_id": 12}


def awkward(spark):
    return docs(spark, AWKWARD, **CLASHES)


def empty(spark):
    return spark.createDataFrame([], DOC_SCHEMA)


def words(text):
    return WORD.findall(text or "")


def components(nodes, linked):
    """Smallest node reachable from each, by union-find."""
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in linked:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}
