"""SimHash near-duplicates by covering locality-sensitive hashing.

Bit ``i`` of a fingerprint gets a nonzero vector of ``radius + 1`` bits; table
``t`` keeps the bits whose vector has an odd overlap with ``t``. For any set of
at most ``radius`` differing bits some ``t`` is orthogonal to all their vectors,
so two fingerprints within the radius agree on all that table ``t`` keeps: no
pair is missed. Documents are first gathered by fingerprint. A bucket of few
fingerprints is compared pair by pair; in a larger one every fingerprint is
keyed by the places where it may differ (all but ``radius`` bits fixed), whose
groups hold at most ``2 ** radius`` fingerprints, all within the radius, and
is linked to the smallest of its group, so no bucket is expanded into its pairs.

Defined results: a null or blank text has fingerprint zero and is linked like
any other. Repeated rows come out as often as they went in. A null doc_id takes
part in links but is never a component_id unless its component has no other.
An empty table gives an empty result; further columns are left out.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carestar.llm.components import connected_components
from carestar.llm.store import documents, materialize, small_or_shuffled
from carestar.llm.words import chunks, text_column

SEED = 42
BITS = 64
PAIRWISE = 64       # largest bucket that is compared pair by pair


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """SimHash of a text's word shingles (A-Z lower-cased), unsigned."""
    import xxhash
    h = xxhash.xxh64_intdigest
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    size = min(shingle, len(words))
    spans = list(zip(starts[:len(words) - size + 1].tolist(), ends[size - 1:].tolist()))
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(spans), 1 << 16):
        part = spans[at:at + (1 << 16)]
        hashes = np.fromiter((h(joined[a:b], SEED) for a, b in part), np.uint64, len(part))
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = (2 * ones > len(spans)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = 3, *more: str) -> DataFrame:
    """doc_id, fp (the fingerprint's bits as a long) and the named further columns (long)."""
    def run(batches):
        for batch in chunks(batches):
            fps = np.array([fingerprint(t.encode(), shingle) for t in text_column(batch).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(fps.view(np.int64)), *[batch.column(c) for c in more]],
                                             names=["doc_id", "fp", *more])

    return documents(docs, *more).mapInArrow(run, ", ".join(f"{c} long" for c in ("doc_id", "fp", *more)))


def masks(radius: int, bits: int = BITS) -> list[int]:
    """Covering masks: 2 ** (radius + 1) - 1 of them, each keeping a bit over half of the bits."""
    top = (1 << (radius + 1)) - 1
    return [sum(1 << i for i in range(bits) if bin((1 + i % top) & t).count("1") % 2) for t in range(1, top + 1)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def links(fps: DataFrame, radius: int = 2) -> DataFrame:
    """(u, v) links between distinct fingerprints ``fp``: their components are those of all pairs within ``radius``."""
    tables = F.array(*[F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(_signed(m)).cast("long")).alias("k"))
                       for t, m in enumerate(masks(radius))])
    keyed = fps.select("fp", F.explode(tables).alias("b")).select("b.t", "b.k", "fp")
    sizes = keyed.groupBy("t", "k").agg(F.count("*").alias("size"), F.min("fp").alias("low")).where("size > 1")
    shared = materialize(keyed.join(sizes, ["t", "k"]).select("t", "k", "fp", "size"), "buckets")

    few = shared.where(F.col("size") <= PAIRWISE)
    pairs = (few.select("t", "k", F.col("fp").alias("u")).join(few.select("t", "k", F.col("fp").alias("v")), ["t", "k"])
             .where((F.col("u") < F.col("v")) & (F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= radius))
             .select("u", "v"))

    wild = [sum(1 << i for i in places) for places in combinations(range(BITS), radius)]
    crowd = shared.where(F.col("size") > PAIRWISE).select("fp").distinct()
    holes = F.explode(F.array(*[F.lit(_signed(w)).cast("long") for w in wild])).alias("hole")
    opened = crowd.select("fp", holes).select(
        "fp", "hole", F.col("fp").bitwiseAND(F.bitwise_not("hole")).alias("rest"))
    groups = opened.groupBy("hole", "rest").agg(F.collect_set("fp").alias("fps")).where(F.size("fps") > 1)
    stars = (groups.select(F.explode("fps").alias("u"), F.array_min("fps").alias("v")).where("u <> v"))
    return pairs.union(stars.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct()


def _placed(fps: DataFrame, radius: int) -> DataFrame:
    """fp, first_id (smallest doc_id), root (a fingerprint of its component) of each fingerprint."""
    classes = materialize(fps.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "classes")
    roots = materialize(connected_components(materialize(links(classes.select("fp"), radius), "links"), "simhash"), "roots")
    placed = classes.join(small_or_shuffled(roots), classes.fp == roots.node, "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root"))
    return materialize(placed, "placed")


def near_duplicates(docs: DataFrame, shingle: int = 3, radius: int = 2) -> DataFrame:
    """One row per input row: doc_id, fp, fingerprint (hex), component_id (smallest doc_id linked to it)."""
    fps = materialize(fingerprints(docs, shingle), "fingerprints")
    placed = _placed(fps, radius)
    heads = placed.groupBy("root").agg(F.min("first_id").alias("component_id"))
    ids = placed.join(heads, "root").select("fp", "component_id")
    return fps.join(ids, "fp").select(
        "doc_id", "fp", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def representatives(docs: DataFrame, shingle: int = 3, radius: int = 2) -> DataFrame:
    """The rows of ``docs``, all columns, that stay when each component keeps one row.

    It is the row with the smallest doc_id, a null one being the largest; of rows that share that doc_id the one with the
    smallest hash of its text. Rows that share a doc_id but not their component are judged apart. Of rows equal in doc_id
    and text one stays.
    """
    text_hash = F.xxhash64(F.col("text").cast("string")).alias("text_hash")
    fps = materialize(fingerprints(docs.select("doc_id", "text", text_hash), shingle, "text_hash"), "fingerprints")
    first = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_hash")
    heads = (fps.groupBy("fp").agg(F.min(first).alias("first")).join(_placed(fps, radius), "fp")
             .groupBy("root").agg(F.min("first").alias("first")).select(F.col("first.doc_id").alias("head_id"), F.col("first.text_hash").alias("head_hash")))
    heads = materialize(heads, "heads")
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("doc_id"), text_hash)
    kept = rows.join(heads, F.col("doc_id").eqNullSafe(F.col("head_id")) & (F.col("text_hash") == F.col("head_hash")), "left_semi")
    return kept.dropDuplicates(["doc_id", "text_hash"]).select("row.*")
