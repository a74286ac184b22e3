"""Jaccard self-join of documents on word n-grams by PartEnum signatures.

Set sizes fall into bands, each as wide as the similarity allows, so that linked
sets lie in one band or in two that are next to each other; a set signs for the
table of its band and for that of the band below. Linked sets of a table differ in
at most ``k`` n-grams. The n-gram domain is cut by hash into ``n1`` parts, each of
``SECOND`` cells. As ``k < n1 * (OPEN + 1)``, linked sets differ in at most
``OPEN`` n-grams of some part, so they agree on some ``SECOND - OPEN`` cells of it:
each such subset of cells is one signature, a hash of the n-grams in it. No linked
pair is missed.

Documents are first gathered by their set. Sets that share a signature are
compared with the hub of that bucket (the set that shares most with others), which
joins large groups without expanding them. What the hubs left apart is compared
across components: an odd sketch (parities of the n-grams per cell; sets differ in
at least as many n-grams as sketches in bits) is held against the allowed
difference inside the join, and what passes is measured exactly. Blocks of a large
bucket are tasks of their own.

N-grams, sets and signatures are told apart by hashes of 64, 128 and 64 bits.

Defined results: a text of fewer words than an n-gram is one n-gram; a null or
blank text has an empty set and is linked with nothing. Repeated rows come out as
often as they went in. A row without a doc_id takes part in links but is never a
component_id unless its component has no other. An empty table gives an empty
result; further columns are left out.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from carestar.llm.components import connected_components
from carestar.llm.store import documents, materialize
from carestar.llm.words import chunks, hash_words, mix, rolling, split_words

NGRAM = 3
PERCENT = 90            # least similarity
SECOND, OPEN = 3, 1     # cells of a part, and those that a signature leaves out
SKETCH = 8              # 64-bit words of a set's sketch
BLOCK = 512             # members of a bucket that one task compares with the rest of it
LARGEST = 1 << 40       # sizes of sets that the bands cover
SHORT = np.uint64(0xD6E8FEB86659FD93)


def band_starts(percent: int = PERCENT) -> list[int]:
    """Smallest size of each band: no set is linked with one of two bands on."""
    starts = [1]
    while starts[-1] < LARGEST:
        starts.append(starts[-1] * 100 // percent + 1)
    return starts


def most_apart(total, percent: int = PERCENT):
    """Most n-grams in which two linked sets of ``total`` n-grams together may differ."""
    return total * (100 - percent) // (100 + percent)


def table_params(percent: int = PERCENT) -> tuple[np.ndarray, np.ndarray]:
    """Per table: the start of its lower band, and its number of parts (0: linked sets are equal there)."""
    starts = band_starts(percent)
    last = [s - 1 for s in starts[1:]]
    apart = [most_apart(m + m * 100 // percent, percent) for m in last]
    return np.array(starts[:-1], np.int64), np.array([-(-(k + 1) // (OPEN + 1)) if k else 0 for k in apart], np.int64)


class _Sets:
    """The distinct n-gram hashes of some texts: those of text ``i`` are ``grams[starts[i]:starts[i + 1]]``, ascending."""

    def __init__(self, texts: pa.Array, n: int):
        w = split_words(pc.ascii_lower(pc.fill_null(texts, "")))
        hashed = hash_words(w.vocab)[w.ids]
        counts, parts, owners = w.counts, [], []
        for size in range(1, n + 1):                           # texts of fewer words are one n-gram of all of them
            runs = rolling(hashed, size)
            if size == n:
                per = np.maximum(counts - n + 1, 0)
                owner = np.repeat(np.arange(len(counts)), per)
                first = np.concatenate([[0], np.cumsum(per)])[:-1]
                at = np.arange(per.sum()) - np.repeat(first - w.starts[:-1], per)
                parts.append(runs[at] if len(at) else np.zeros(0, np.uint64))
            else:
                owner = np.flatnonzero(counts == size)
                parts.append(mix(runs[w.starts[owner]] ^ SHORT) if len(owner) else np.zeros(0, np.uint64))
            owners.append(owner)
        grams, owner = np.concatenate(parts), np.concatenate(owners)
        order = np.lexsort((grams, owner))
        grams, owner = grams[order], owner[order]
        new = np.ones(len(grams), bool)
        new[1:] = (grams[1:] != grams[:-1]) | (owner[1:] != owner[:-1])
        self.grams, self.owner = grams[new], owner[new]
        self.sizes = np.bincount(self.owner, minlength=len(counts)).astype(np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)])

    def sums(self, values: np.ndarray) -> np.ndarray:
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])
        return total[self.starts[1:]] - total[self.starts[:-1]]

    def keys(self) -> list[np.ndarray]:
        """128 bits that name a set."""
        with np.errstate(over="ignore"):
            return [mix(self.sums(mix(self.grams ^ np.uint64(s)))).view(np.int64) for s in (0x2545F4914F6CDD1D, 0xA0761D6478BD642F)]


def _records(batch, columns: dict[str, pa.Array]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id")} | columns)


def sets(docs: DataFrame, n: int = NGRAM) -> DataFrame:
    """doc_id, n_shingles, h1, h2 (the key of its set) of every row."""
    def run(batches):
        for batch in chunks(batches):
            s = _Sets(batch.column("text"), n)
            h1, h2 = s.keys()
            yield _records(batch, {"n_shingles": pa.array(s.sizes), "h1": pa.array(h1), "h2": pa.array(h2)})

    return documents(docs).mapInArrow(run, "doc_id long, n_shingles long, h1 long, h2 long")


def _signatures(s: _Sets, starts: np.ndarray, parts: np.ndarray) -> pa.Array:
    """The signatures of each set, for both its tables."""
    found = [[np.zeros(0, np.uint64), np.zeros(0, np.int64)]]
    band = np.searchsorted(starts, s.sizes, "right") - 1
    for table in (band, band - 1):
        n1 = np.where((table >= 0) & (s.sizes > 0), parts[np.maximum(table, 0)], 0)
        first = np.concatenate([[0], np.cumsum(n1 * SECOND)])
        with np.errstate(over="ignore"):
            mixed = mix(s.grams ^ np.uint64(0x9FB21C651E98DF25))
            cells = (n1 * SECOND)[s.owner]
            use = cells > 0
            where = first[:-1][s.owner[use]] + ((mixed[use] >> np.uint64(32)) * cells[use].astype(np.uint64) >> np.uint64(32)).astype(np.int64)
            order = np.argsort(where, kind="stable")
            total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(mixed[use])[order], dtype=np.uint64)])
            ends = np.searchsorted(where[order], np.arange(first[-1]), "right")
            at = total[np.concatenate([[0], ends])]
            in_cell = (at[1:] - at[:-1]).reshape(-1, SECOND)                    # one row per part
            owner = np.repeat(np.arange(len(n1)), n1)
            place = np.arange(len(owner)) - np.repeat(np.concatenate([[0], np.cumsum(n1)])[:-1], n1)
            tag = mix(mix(table[owner].astype(np.uint64)) + place.astype(np.uint64))
            for i, chosen in enumerate(combinations(range(SECOND), SECOND - OPEN)):
                sign = mix(tag + np.uint64(i))
                for c in chosen:
                    sign = mix(sign + mix(in_cell[:, c] + np.uint64(c)))
                found.append([sign, owner])
    signs, owners = (np.concatenate(x) for x in zip(*found))
    order = np.argsort(owners, kind="stable")
    ends = np.concatenate([[0], np.cumsum(np.bincount(owners, minlength=len(s.sizes)))]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(signs[order].view(np.int64)))


def signatures(docs: DataFrame, n: int = NGRAM, percent: int = PERCENT) -> DataFrame:
    """doc_id, h1, h2, signs of every row."""
    starts, parts = table_params(percent)

    def run(batches):
        for batch in chunks(batches):
            s = _Sets(batch.column("text"), n)
            h1, h2 = s.keys()
            yield _records(batch, {"h1": pa.array(h1), "h2": pa.array(h2), "signs": _signatures(s, starts, parts)})

    return documents(docs).mapInArrow(run, "doc_id long, h1 long, h2 long, signs array<long>")


def _sketches(s: _Sets) -> pa.Array:
    """Parities of the number of n-grams in each of 64 * SKETCH cells."""
    bits = 64 * SKETCH
    cell = s.owner * bits + (mix(s.grams ^ np.uint64(0xE7037ED1A0B428DB)) >> np.uint64(32)).astype(np.int64) % bits
    odd = (np.bincount(cell, minlength=len(s.sizes) * bits) & 1).astype(np.uint8)
    words = np.packbits(odd, bitorder="little").view(np.int64)
    return pa.ListArray.from_arrays(pa.array(np.arange(0, len(words) + 1, SKETCH, dtype=np.int32)), pa.array(words))


def gram_sets(docs: DataFrame, n: int = NGRAM) -> DataFrame:
    """doc_id, h1, h2, grams, sketch of every row."""
    def run(batches):
        for batch in chunks(batches):
            s = _Sets(batch.column("text"), n)
            h1, h2 = s.keys()
            grams = pa.ListArray.from_arrays(pa.array(s.starts.astype(np.int32)), pa.array(s.grams.view(np.int64)))
            yield _records(batch, {"h1": pa.array(h1), "h2": pa.array(h2), "grams": grams, "sketch": _sketches(s)})

    return documents(docs).mapInArrow(run, "doc_id long, h1 long, h2 long, grams array<long>, sketch array<long>")


def _of_nodes(rows: DataFrame, nodes: DataFrame, *columns: str) -> DataFrame:
    """The named columns at the row that stands for each node (its set and smallest doc_id)."""
    n = nodes.select("node", F.col("h1").alias("_h1"), F.col("h2").alias("_h2"), "first_id")
    same = (rows.h1 == n._h1) & (rows.h2 == n._h2) & rows.doc_id.eqNullSafe(n.first_id)
    return rows.join(n, same).groupBy("node").agg(*[F.first(c).alias(c) for c in columns])


def _similar(a: Column, b: Column, percent: int) -> Column:
    both = F.size(F.array_intersect(a, b)).cast("long")
    return 100 * both >= percent * (F.size(a) + F.size(b) - both)


def verified(pairs: DataFrame, grams: DataFrame, percent: int) -> DataFrame:
    """Those of the distinct pairs (u, v) whose sets are similar enough. A set that many pairs name as v is dealt to them in copies."""
    dealt = pairs.withColumn("salt", F.pmod(F.xxhash64("u"), F.lit(1 << 20)))
    copies = pairs.groupBy("v").agg(F.ceil(F.count("*") / BLOCK).alias("copies"))
    left = dealt.join(grams.select(F.col("node").alias("u"), F.col("grams").alias("a")), "u").join(copies, "v").select(
        "u", "v", "a", F.pmod("salt", F.col("copies")).alias("salt"))
    right = copies.join(grams.select(F.col("node").alias("v"), F.col("grams").alias("b")), "v").select(
        "v", "b", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)).alias("salt"))
    return left.join(right, ["v", "salt"]).where(_similar(F.col("a"), F.col("b"), percent)).select("u", "v")


def _labelled(shared: DataFrame, roots: DataFrame) -> DataFrame:
    """Members of the buckets that hold more than one component, with their component."""
    named = shared.join(roots.withColumnRenamed("root", "comp"), "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    span = Window.partitionBy("sign")
    return named.withColumn("lo", F.min("comp").over(span)).withColumn("hi", F.max("comp").over(span)).where("lo <> hi").drop("lo", "hi")


def _apart(members: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs of members of one bucket and different components that their sketches do not tell apart.

    Pairs within the largest component of a bucket need no look; each other member is held against the bucket, in blocks.
    """
    sizes = members.groupBy("sign", "comp").agg(F.count("*").alias("n"))
    buckets = sizes.groupBy("sign").agg(F.max_by("comp", F.struct("n", "comp")).alias("main"),
                                        (F.sum("n") - F.max("n")).alias("others"))
    full = materialize(members.join(buckets, "sign").join(sketches, "node"), "members")
    blocks = F.ceil(F.col("others") / BLOCK)
    few = full.where("comp <> main").select(
        "sign", F.pmod(F.xxhash64("node"), blocks).alias("block"), *[F.col(c).alias(f"{c}_u") for c in ("node", "comp", "size", "sketch")], "main")
    many = full.select("sign", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)).alias("block"),
                       *[F.col(c).alias(f"{c}_v") for c in ("node", "comp", "size", "sketch")])
    differing = sum(F.bit_count(F.col("sketch_u")[i].bitwiseXOR(F.col("sketch_v")[i])) for i in range(SKETCH))
    apart = F.col("comp_u") != F.col("comp_v")
    once = (F.col("comp_v") == F.col("main")) | (F.col("node_u") < F.col("node_v"))
    total = F.col("size_u") + F.col("size_v")
    sizes_fit = 100 * F.least("size_u", "size_v") >= percent * F.greatest("size_u", "size_v")
    close = differing <= F.floor(total * (100 - percent) / (100 + percent))
    pairs = few.join(many, ["sign", "block"]).where(apart & once & sizes_fit & close)
    return pairs.select(F.least("node_u", "node_v").alias("u"), F.greatest("node_u", "node_v").alias("v")).distinct()


def components(docs: DataFrame, nodes: DataFrame, n: int = NGRAM, percent: int = PERCENT) -> DataFrame:
    """node, root for each set (node, h1, h2, first_id) that has a link."""
    signed = _of_nodes(signatures(docs, n, percent), nodes, "signs").select("node", F.explode("signs").alias("sign"))
    shared = materialize(signed.withColumn("n", F.count("*").over(Window.partitionBy("sign"))).where("n > 1"), "shared")
    weights = shared.groupBy("node").agg(F.sum("n").alias("weight"))
    used = nodes.join(weights, "node", "left_semi")
    grams = materialize(_of_nodes(gram_sets(docs, n), used, "grams", "sketch").withColumn("size", F.size("grams").cast("long")), "grams")

    hubs = shared.join(weights, "node").groupBy("sign").agg(F.max_by("node", F.struct("weight", -F.col("node"))).alias("v"))
    spokes = shared.join(hubs, "sign").where("node <> v").select(F.col("node").alias("u"), "v").distinct()
    links = materialize(verified(materialize(spokes, "spokes"), grams, percent), "links")
    roots = materialize(connected_components(links, "hubs"), "roots")

    left = materialize(_labelled(shared.drop("n"), roots), "left")
    pairs = materialize(_apart(left, grams.drop("grams"), percent), "pairs")
    more = materialize(verified(pairs, grams, percent), "links")
    return connected_components(links.union(more), "ngrams")


def near_duplicates(docs: DataFrame, n: int = NGRAM, percent: int = PERCENT) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id (smallest doc_id reachable by links)."""
    rows = materialize(sets(docs, n), "sets")
    nodes = materialize(rows.where("n_shingles > 0").groupBy("h1", "h2").agg(F.min("doc_id").alias("first_id"))
                        .withColumn("node", F.monotonically_increasing_id()), "nodes")
    roots = materialize(components(docs, nodes, n, percent), "roots")
    placed = nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    heads = placed.groupBy("root").agg(F.min("first_id").alias("component_id"))
    ids = materialize(placed.join(heads, "root").select("h1", "h2", "component_id"), "ids")
    full = rows.where("n_shingles > 0").join(ids, ["h1", "h2"]).select("doc_id", "n_shingles", "component_id")
    return full.unionByName(rows.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))
