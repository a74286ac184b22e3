"""Benchmark decontamination by CGK embedding and bit-sampling locality-sensitive hashing.

A document leaks an item when some window of as many words as the item (or the
whole text, when that is shorter) is within ``(1 - similarity)`` edits per item
word of it. Words are compared in lower case without punctuation around them.

* Windows. An item within ``d`` edits of a window keeps one of any ``d + 1``
  pieces whole, at most ``d`` words from its place. Windows of an item's size at
  such places are embedded; no other window can match.
* Embedding. A CGK walk copies the current word and steps on or stays, as a hash
  of walk, step and word says, so that few edits become few differing places.
* Candidates. Each repetition samples places of one walk; a window that agrees
  with an item of its size on all of them is a candidate. The number of
  repetitions per size follows from the collision rate measured on items with
  ``d`` random edits, such that the target recall is reached.
* Long items. An item of more than LONG words is cut into blocks of about BLOCK
  words, which go through the steps above as items of their own: whatever edits it
  has, some block has no more than its share. Where a block is met, the passage of
  the text that is closest to the whole item is looked for (bit-parallel too) around
  the place that the block says, and a window of the item's size there is verified.
* Verification. Candidates are verified by exact (bit-parallel) edit distance.

Items travel to the tasks in parts of bounded size, one pass over the documents
for each part and one part after the other, so a benchmark of any size is covered.

Defined results: null and wordless texts and items match nothing. Repeated rows
of documents come out each; repeated items count once per item_id. Rows without
a doc_id are reported with null. ``clean_documents`` decides by doc_id and text, so
leaking rows without a doc_id go and other rows of a leaking doc_id stay. Empty
tables give an empty result; further columns are left out of ``leaks``.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carestar.llm.store import documents, materialize
from carestar.llm.words import chunks, hash_words, mix, rolling, split_words, text_column

SIMILARITY = 0.8
RECALL = 0.99
SAMPLED = 4              # places that a repetition compares
SEED_WORDS = 4           # most words of a piece that are looked up
TRIALS = 400             # edited items that the collision rate of a size is measured on
PART_BYTES = 2 << 20     # of items in one pass
LONG = 119               # words of the longest items that are looked for whole
BLOCK = 60               # least words of the blocks of longer ones (fewer than twice as many: none is longer than LONG)
MOST_REPETITIONS = 4096  # of the calibration; items and blocks of up to LONG words need about 200 at a recall of 0.99
SLAB = 8192              # walks that are made together
PAD = np.uint64(0x5BD1E995)


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Offsets, hashes of the compared words, and the place of each among all words of its text."""
    w = split_words(texts)
    vocab = pc.utf8_trim(pc.utf8_lower(w.vocab), characters=_AROUND)
    keep = (pc.binary_length(vocab).to_numpy(zero_copy_only=False) > 0)[w.ids]
    starts = np.concatenate([[0], np.cumsum(keep)]).astype(np.int64)[w.starts]
    place = np.arange(len(w.ids)) - np.repeat(w.starts[:-1], w.counts)
    return starts, hash_words(vocab)[w.ids[keep]], place[keep]


_AROUND = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum()) + "«»“”‘’„…–—¿¡"


def edit_distance(a: list[int], b: list[int]) -> int:
    """Levenshtein distance of two sequences, bit-parallel over ``a``."""
    if not a:
        return len(b)
    match: dict[int, int] = {}
    for i, x in enumerate(a):
        match[x] = match.get(x, 0) | 1 << i
    full, top = (1 << len(a)) - 1, 1 << (len(a) - 1)
    plus, minus, distance = full, 0, len(a)
    for y in b:
        eq = match.get(y, 0)
        horizontal = ((((eq & plus) + plus) ^ plus) | eq) | minus
        up = (minus | ~(horizontal | plus)) & full
        down = plus & horizontal
        if up & top:
            distance += 1
        elif down & top:
            distance -= 1
        up = (up << 1 | 1) & full
        vertical = eq | minus
        plus = ((down << 1) | ~(vertical | up)) & full
        minus = up & vertical
    return distance


def closest_passage(a: list[int], b: list[int]) -> tuple[int, int]:
    """Least edits between ``a`` and any run of ``b``, and where in ``b`` the first such run ends; bit-parallel over ``a``."""
    match: dict[int, int] = {}
    for i, x in enumerate(a):
        match[x] = match.get(x, 0) | 1 << i
    full, top = (1 << len(a)) - 1, 1 << (len(a) - 1)
    plus, minus, distance = full, 0, len(a)
    best = (distance, 0)
    for j, y in enumerate(b):
        eq = match.get(y, 0)
        horizontal = ((((eq & plus) + plus) ^ plus) | eq) | minus
        up = (minus | ~(horizontal | plus)) & full
        down = plus & horizontal
        if up & top:
            distance += 1
        elif down & top:
            distance -= 1
        up = (up << 1) & full                                  # a run may begin anywhere
        vertical = eq | minus
        plus = ((down << 1) | ~(vertical | up)) & full
        minus = up & vertical
        if distance < best[0]:
            best = (distance, j + 1)
    return best


def sampled_keys(rows: np.ndarray, sizes: np.ndarray, walks: np.ndarray, places: np.ndarray,
                 classes: np.ndarray | None = None) -> np.ndarray:
    """For each row: CGK walk number ``walks`` over its first ``sizes`` words, hashed at the sampled ``places``.

    ``classes`` are the item sizes to compare with, where the rows may be shorter.
    """
    classes = sizes if classes is None else classes
    keys = np.empty(len(rows), np.uint64)
    for a in range(0, len(rows), SLAB):
        part = slice(a, a + SLAB)
        row, size, place = rows[part], sizes[part], places[part]
        seed = mix(walks[part].astype(np.uint64) + np.uint64(1))
        at, index = np.zeros(len(row), np.int64), np.arange(len(row))
        steps = int(place.max()) + 1
        walked = np.empty((steps, len(row)), np.uint64)
        for step in range(steps):
            symbol = np.where(at < size, row[index, np.minimum(at, row.shape[1] - 1)], PAD)
            walked[step] = symbol
            at += (mix(symbol ^ seed ^ np.uint64(step * 0xD1B54A32D192ED03 % (1 << 64))) >> np.uint64(63)).astype(np.int64)
        key = mix(classes[part].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ seed)
        for k in range(place.shape[1]):
            key = mix(key ^ (walked[place[:, k], index] + np.uint64(k + 1)))
        keys[part] = key
    return keys


def sampled_places(size: int, repetition: int) -> np.ndarray:
    """Places (of the first ``2 * size`` steps) that a repetition compares; with repeats where there are few."""
    return np.sort(np.random.default_rng([size, repetition]).integers(0, 2 * size, SAMPLED))


def repetitions(rows: np.ndarray, edits: int, recall: float) -> tuple[int, np.ndarray]:
    """Repetitions after which all but ``1 - recall`` of randomly edited rows have collided, and each one's places."""
    rng, size = np.random.default_rng(rows.shape[1]), rows.shape[1]
    picked = rows[rng.integers(0, len(rows), TRIALS)]
    edited = np.stack([_edited(r, edits, rng) for r in picked])
    places, met_at = [], np.full(TRIALS, MOST_REPETITIONS + 1)
    while len(places) < MOST_REPETITIONS and (met_at > len(places)).mean() > 1 - recall:
        left, first = np.flatnonzero(met_at > len(places)), len(places)
        places += [sampled_places(size, first + k) for k in range(16)]
        walks = np.tile(np.arange(first, first + 16), len(left))
        here = np.stack(places[first:])[walks - first]
        full = np.full(len(walks), size)
        same = (sampled_keys(np.repeat(picked[left], 16, 0), full, walks, here)
                == sampled_keys(np.repeat(edited[left], 16, 0), full, walks, here)).reshape(len(left), 16)
        met_at[left] = np.where(same.any(1), first + same.argmax(1) + 1, met_at[left])
    needed = min(len(places), int(np.sort(met_at)[min(TRIALS - 1, math.ceil(recall * TRIALS) - 1)]))
    return needed, np.stack(places[:needed])


@dataclass
class SizeClass:
    """Items and blocks of long items of one size."""

    size: int
    edits: int
    items: list[int | tuple[int, int]] = field(default_factory=list)      # item_id; of a block: number of its item, its place there
    rows: list[np.ndarray] = field(default_factory=list)
    repetitions: int = 0
    places: np.ndarray | None = None


def _edited(row: np.ndarray, edits: int, rng) -> np.ndarray:
    """A row of the same size after random edits: substitutions, and pairs of an insertion and a deletion."""
    words, left = row.tolist(), edits
    while left:
        new = int(rng.integers(0, 1 << 62))
        if left > 1 and rng.random() < 0.5:
            words.insert(int(rng.integers(0, len(words) + 1)), new)
            words.pop(int(rng.integers(0, len(words))))
            left -= 2
        else:
            words[int(rng.integers(0, len(words)))] = new
            left -= 1
    return np.array(words, np.uint64)


class ItemIndex:
    """Seeds and hash tables of a part of the benchmark."""

    def __init__(self, ids: list[int], texts: list[str], similarity: float, recall: float):
        self.classes: dict[int, SizeClass] = {}
        seeds: dict[int, dict[int, set]] = {}
        self.long: list[tuple[int, list[int], int]] = []          # item_id, words, edits
        starts, words, _ = word_hashes(pa.array(texts, pa.string()))
        pieces = []
        for i, item in enumerate(ids):
            row = words[starts[i]:starts[i + 1]]
            if len(row) <= LONG:
                pieces.append((item, row))
                continue
            m = len(row) // BLOCK
            cuts = [round(k * len(row) / m) for k in range(m + 1)]
            pieces += [((len(self.long), a), row[a:b]) for a, b in zip(cuts, cuts[1:])]
            self.long.append((item, row.tolist(), math.floor((1 - similarity) * len(row) + 1e-9)))
        for item, row in pieces:
            size = len(row)
            if not size:
                continue
            edits = math.floor((1 - similarity) * size + 1e-9)
            c = self.classes.setdefault(size, SizeClass(size, edits))
            c.items.append(item)
            c.rows.append(row)
            cuts = [round(k * size / (edits + 1)) for k in range(edits + 2)]
            for a, b in zip(cuts, cuts[1:]):
                n = min(b - a, SEED_WORDS)
                seeds.setdefault(n, {}).setdefault(int(rolling(row[a:a + n], n)[0]), set()).add((size, a))
        table: dict[int, set[tuple[int, int]]] = {}
        for c in self.classes.values():
            stack = np.stack(c.rows)
            c.repetitions, c.places = repetitions(stack, c.edits, recall)
            n = len(c.rows)
            walks = np.tile(np.arange(c.repetitions), n)
            keys = sampled_keys(np.repeat(stack, c.repetitions, 0), np.full(len(walks), c.size), walks, c.places[walks])
            for key, i in zip(keys.tolist(), np.repeat(np.arange(n), c.repetitions).tolist()):
                table.setdefault(key, set()).add((c.size, i))
        self.keys = np.array(sorted(table), np.uint64)
        self.keyed = [sorted(table[k]) for k in self.keys.tolist()]
        self.seeds = {}
        for n, found in seeds.items():
            keys = np.array(sorted(found), np.uint64)
            self.seeds[n] = (keys, [sorted(found[k]) for k in keys.tolist()])

    def window_starts(self, words: np.ndarray, starts: np.ndarray) -> dict[int, set[tuple[int, int]]]:
        """Per size, (text, start) of the windows around pieces of items."""
        found: dict[int, set[tuple[int, int]]] = {}
        for n, (keys, places) in self.seeds.items():
            hashes = rolling(words, n)
            if not len(hashes):
                continue
            marked = np.zeros(1 << 20, bool)
            marked[keys >> np.uint64(44)] = True
            at = np.flatnonzero(marked[hashes >> np.uint64(44)])
            which = np.minimum(np.searchsorted(keys, hashes[at]), len(keys) - 1)
            good = keys[which] == hashes[at]
            at, which = at[good], which[good]
            text = np.searchsorted(starts, at, side="right") - 1
            inside = at + n <= starts[text + 1]
            for p, k, t in zip(at[inside].tolist(), which[inside].tolist(), text[inside].tolist()):
                first, length = int(starts[t]), int(starts[t + 1] - starts[t])
                for size, offset in places[k]:
                    edits = self.classes[size].edits
                    if length < size - edits:
                        continue
                    last = max(0, length - size)
                    middle = p - first - offset
                    for s in range(max(0, min(last, middle - edits)), min(last, max(0, middle + edits)) + 1):
                        found.setdefault(size, set()).add((t, s))
        return found

    def matches(self, texts: pa.Array) -> list[tuple[int, int, int, int, int]]:
        """(text, item, first word, words, edits) of the closest verified window of each leaked item."""
        starts, words, place = word_hashes(texts)
        windows = [(size, t, s) for size, found in self.window_starts(words, starts).items() for t, s in sorted(found)]
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        if not windows:
            return []
        size, text, start = (np.array(x) for x in zip(*windows))
        first = starts[text] + start
        sizes = np.minimum(size, starts[text + 1] - first)
        offered: set[tuple[int, int]] = set()
        around: set[tuple[int, int, int]] = set()                  # text, long item, where its window would begin

        times = np.array([self.classes[n].repetitions for n in size.tolist()])
        for lo in range(0, len(windows), SLAB // 16):
            at = np.repeat(np.arange(lo, min(lo + SLAB // 16, len(windows))), times[lo:lo + SLAB // 16])
            walks = np.arange(len(at)) - np.searchsorted(at, at)
            rows = words[np.minimum(first[at][:, None] + np.arange(size[at].max()), len(words) - 1)]
            places = np.stack([self.classes[n].places[r] for n, r in zip(size[at].tolist(), walks.tolist())])
            keys = sampled_keys(rows, sizes[at], walks, places, size[at])
            where = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
            hit = np.flatnonzero(self.keys[where] == keys)
            for i, k in sorted(set(zip(at[hit].tolist(), where[hit].tolist()))):
                for n, item in self.keyed[k]:
                    if n != size[i] or (i, item) in offered:
                        continue
                    offered.add((i, item))
                    c, a = self.classes[n], int(first[i])
                    if isinstance(c.items[item], tuple):
                        number, offset = c.items[item]
                        around.add((int(text[i]), number, int(start[i]) - offset))
                        continue
                    distance = edit_distance(c.rows[item].tolist(), words[a:a + sizes[i]].tolist())
                    if distance <= c.edits:
                        span = (distance, int(place[a]), int(place[a + sizes[i] - 1]) + 1 - int(place[a]))
                        pair = (int(text[i]), c.items[item])
                        best[pair] = min(best.get(pair, span), span)
        self._long_matches(words, starts, place, around, best)
        return [(t, item, s, n, d) for (t, item), (d, s, n) in sorted(best.items())]

    def _long_matches(self, words: np.ndarray, starts: np.ndarray, place: np.ndarray, around: set[tuple[int, int, int]], best: dict) -> None:
        """Add the closest verified window of long items near the places that their blocks said."""
        looked: dict[tuple[int, int], int] = {}
        for t, number, said in sorted(around):
            item, row, edits = self.long[number]
            if said <= looked.get((t, number), -1 << 60):
                continue                                       # within what was looked through for the block before
            looked[t, number] = said + edits
            whole = words[starts[t]:starts[t + 1]]
            lo, hi = max(0, said - edits), min(len(whole), said + len(row) + 2 * edits)
            region = whole[lo:hi].tolist()
            least, end = closest_passage(row, region)
            if least > edits:
                continue
            length, back = closest_passage(row[::-1], region[:end][::-1])[1], len(region) - len(row)
            begins = {min(max(0, s), max(0, back)) for s in (end - length, end - len(row), (2 * end - length - len(row)) // 2, said - lo)}
            for s in sorted(begins):
                window = region[s:s + len(row)]
                distance = edit_distance(row, window)
                if distance <= edits:
                    a = int(starts[t]) + lo + s
                    span = (distance, int(place[a]), int(place[a + len(window) - 1]) + 1 - int(place[a]))
                    best[t, item] = min(best.get((t, item), span), span)


def _leaks(rows: DataFrame, items: DataFrame, similarity: float, recall: float) -> DataFrame:
    """doc_id, text_hash, item_id, first_word, n_words, edits for rows of doc_id, text, text_hash."""
    spark = rows.sparkSession
    bench = (items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
             .where("item_id is not null and text is not null").distinct())
    total = bench.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    parts, out = max(1, math.ceil(total / PART_BYTES)), None
    for part in range(parts):
        of = bench.where(F.pmod(F.xxhash64("item_id"), F.lit(parts)) == part).orderBy("item_id", "text").collect()
        index = spark.sparkContext.broadcast(ItemIndex([r["item_id"] for r in of], [r["text"] for r in of], similarity, recall))

        def run(batches, index=index):
            for batch in chunks(batches):
                found = index.value.matches(text_column(batch))
                at = pa.array([t for t, *_ in found], pa.int64())
                rest = [pa.array([m[k] for m in found], pa.int64()) for k in range(1, 5)]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(at), batch.column("text_hash").take(at), *rest],
                                                 names=["doc_id", "text_hash", "item_id", "first_word", "n_words", "edits"])

        pairs = rows.mapInArrow(run, "doc_id long, text_hash long, item_id long, first_word long, n_words long, edits long")
        if parts > 1:                                          # one part at a time: its index goes before the next is sent
            pairs = materialize(pairs, "leaks")
            index.destroy()
        out = pairs if out is None else out.union(pairs)
    return out


def leaks(docs: DataFrame, items: DataFrame, similarity: float = SIMILARITY, recall: float = RECALL) -> DataFrame:
    """One row per document and leaked item: doc_id, item_id, first_word, n_words, edits (of the closest window found)."""
    rows = documents(docs).withColumn("text_hash", F.lit(None).cast("long"))
    return _leaks(rows, items, similarity, recall).drop("text_hash")


def clean_documents(docs: DataFrame, items: DataFrame, similarity: float = SIMILARITY, recall: float = RECALL) -> DataFrame:
    """The rows of ``docs``, all columns, without those that leak an item."""
    rows = documents(docs).withColumn("text_hash", F.xxhash64("text"))
    found = materialize(_leaks(rows, items, similarity, recall).select(F.col("doc_id").alias("_leak_id"), F.col("text_hash").alias("_leak_text"))
                        .distinct(), "leaks")
    same = docs["doc_id"].cast("long").eqNullSafe(found["_leak_id"]) & (F.xxhash64(docs["text"].cast("string")) == found["_leak_text"])
    return docs.join(found, same, "left_anti")
