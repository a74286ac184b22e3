"""SentencePiece BPE encoding and decoding by vectorised merge rounds.

A text is cut into segments that no piece can cross (before a run of spaces,
and around characters that occur in no longer piece). Distinct segments of a
chunk are encoded together in flat numpy arrays: each round finds the best pair
rank of every unfinished segment, merges its occurrences from the left, and
compacts; a segment without a pair is finished. A merge whose result could
itself win an equal or better pair is done one occurrence at a time, so rounds
give what the queue of the sequential algorithm gives. A segment of more than
LONG symbols would take a round per rank; there a round merges every pair that
is the best within the reach of two pieces on either side (``_merge_long``). The
vocabulary file is a parameter; its bytes (half a megabyte) travel with the task.

Defined results: a null or empty text has only the begin and end ids and decodes
to the empty string. Characters outside the vocabulary become byte pieces.
Repeated rows are rows of their own; further columns are left out.
"""

from __future__ import annotations

import hashlib
import heapq

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from carestar.llm.store import documents
from carestar.llm.words import chunks, text_column

SPACE = "▁"
UNKNOWN_SURFACE = " ⁇ "
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6      # piece types of the file format
NO_RANK = np.iinfo(np.int32).max
LONG = 256             # symbols of a segment beyond which its merges are found within a reach
PROGRESS = 1000        # a round of long segments that merges fewer than one symbol in so many is the last


def _fields(data: bytes):
    """(number, value) of each field of a protocol-buffer message."""
    at = 0

    def varint():
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            value = varint()
        else:
            size = {1: 8, 5: 4}[kind] if kind != 2 else varint()
            value = data[at:at + size]
            at += size
        yield key >> 3, value


def _least_before(values: np.ndarray, size: int) -> np.ndarray:
    """Smallest of the ``size`` values before each place, by doubling."""
    out = np.concatenate([np.full(size, NO_RANK, values.dtype), values[:-1]]) if len(values) else values
    span = 1
    while span < size:
        step = min(span, size - span)
        out = np.minimum(out[:-step], out[step:])
        span += step
    return out


class PieceModel:
    """Pieces, merge table and surfaces of a BPE model file with byte fallback and identity normalisation."""

    def __init__(self, data: bytes):
        self.pieces: list[str] = []
        scores, kinds = [], []
        for number, value in _fields(data):
            if number == 1:
                piece = dict(_fields(value))
                self.pieces.append(piece.get(1, b"").decode("utf-8"))
                scores.append(np.frombuffer(piece.get(2, b"\0\0\0\0"), "<f4")[0])
                kinds.append(piece.get(3, NORMAL))
            elif number == 2:
                trainer = dict(_fields(value))
                if trainer.get(3, 1) != 2 or not trainer.get(35, 0):
                    raise ValueError("only BPE models with byte fallback are supported")
            elif number == 3:
                rule = dict(_fields(value))
                if rule.get(2, b"") or not rule.get(3, 1) or rule.get(4, 1) or not rule.get(5, 1):
                    raise ValueError("only identity normalisation with a dummy prefix is supported")
        if USER in kinds or UNUSED in kinds:
            raise ValueError("user-defined and unused pieces are not supported")
        self.n = len(self.pieces)
        self.unknown = kinds.index(UNKNOWN)
        self.begin, self.end = self.pieces.index("<s>"), self.pieces.index("</s>")
        self.byte_ids = np.zeros(256, np.int64)
        self.byte_of: dict[int, int] = {}
        for i, kind in enumerate(kinds):
            if kind == BYTE:
                b = int(self.pieces[i][1:-1], 16)
                self.byte_ids[b], self.byte_of[i] = i, b
        ids = {p: i for i, p in enumerate(self.pieces) if kinds[i] == NORMAL}
        if any(SPACE in p.lstrip(SPACE) for p in ids):
            raise ValueError("pieces that go on after a space are not supported")

        # symbols: pieces, then characters that occur in pieces without being one
        symbol = dict(ids)
        for p in ids:
            for c in p:
                symbol.setdefault(c, self.n + len(symbol) - len(ids))
        self.n_symbols = self.n + len(symbol) - len(ids)
        self.reach = 2 * max(map(len, ids)) + 2
        order = np.unique(np.array([-scores[i] for i in ids.values()]), return_inverse=True)[1]
        rank = dict(zip(ids.values(), order.tolist()))
        pairs: dict[int, int] = {}
        for p, i in ids.items():
            for k in range(1, len(p)):
                left, right = symbol.get(p[:k]), symbol.get(p[k:])
                if left is not None and right is not None:
                    pairs[left * self.n_symbols + right] = i
        self.pair_keys = np.array(sorted(pairs), np.int64)
        self.pair_piece = np.array([pairs[k] for k in self.pair_keys.tolist()], np.int64)
        self.pair_rank = np.array([rank[i] for i in self.pair_piece.tolist()], np.int32)
        piece_rank = np.full(self.n_symbols, NO_RANK, np.int64)
        for i, r in rank.items():
            piece_rank[i] = r
        best = np.full(self.n_symbols, NO_RANK, np.int64)     # best pair that each symbol can take part in
        np.minimum.at(best, self.pair_keys // self.n_symbols, self.pair_rank)
        np.minimum.at(best, self.pair_keys % self.n_symbols, self.pair_rank)
        careful = np.zeros(int(order.max()) + 1, bool)
        merged = np.unique(self.pair_piece)
        careful[piece_rank[merged][best[merged] <= piece_rank[merged]]] = True
        shared = np.bincount(order, minlength=len(careful)) > 1
        self.careful = careful | shared                       # by rank: merge one occurrence at a time
        chars = {c: i for c, i in symbol.items() if len(c) == 1}
        self.char_codes = np.array(sorted(map(ord, chars)), np.int64)
        self.char_symbols = np.array([chars[chr(c)] for c in self.char_codes.tolist()], np.int64)
        joined = {c for p in ids if len(p) > 1 for c in p}
        self.alone = np.array([c < 128 and chr(c) not in joined and chr(c) != " " for c in range(256)])
        self.surface = [
            b"" if kinds[i] == CONTROL else UNKNOWN_SURFACE.encode() if kinds[i] == UNKNOWN
            else bytes([self.byte_of[i]]) if kinds[i] == BYTE else p.replace(SPACE, " ").encode()
            for i, p in enumerate(self.pieces)]
        self.leads = np.array([kinds[i] == NORMAL and p.startswith(SPACE) for i, p in enumerate(self.pieces)])
        self.control = np.array([k == CONTROL for k in kinds])

    # -- encoding ---------------------------------------------------------

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = np.where((left >= 0) & (right >= 0), left * self.n_symbols + right, -1)
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        found = self.pair_keys[at] == key
        return np.where(found, self.pair_rank[at], NO_RANK), self.pair_piece[at]

    def encode_segments(self, codes: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Piece ids of segments given as code points (space as U+2581), flat, and how many each segment has."""
        at = np.minimum(np.searchsorted(self.char_codes, codes), len(self.char_codes) - 1)
        sym = np.where(self.char_codes[at] == codes, self.char_symbols[at], -1 - codes)   # below 0: a lone character
        seg = np.repeat(np.arange(len(lengths)), lengths)
        done_sym, done_seg = [], []
        long = np.repeat(lengths > LONG, lengths)
        if long.any():
            for part, of in zip(self._merge_long(sym[long], seg[long]), (done_sym, done_seg)):
                of.append(part)
            sym, seg = sym[~long], seg[~long]
        while len(sym):
            rank, piece = self._ranks(sym[:-1], sym[1:])
            rank[seg[:-1] != seg[1:]] = NO_RANK
            rank, piece = np.append(rank, NO_RANK), np.append(piece, 0)
            first = np.flatnonzero(np.concatenate([[True], seg[1:] != seg[:-1]]))
            size = np.diff(np.append(first, len(seg)))
            best = np.minimum.reduceat(rank, first)
            over = np.repeat(best == NO_RANK, size)
            done_sym.append(sym[over])
            done_seg.append(seg[over])
            sym, seg, rank, piece = sym[~over], seg[~over], rank[~over], piece[~over]
            if not len(sym):
                break
            best, size = best[best != NO_RANK], size[best != NO_RANK]
            hit = rank == np.repeat(best, size)
            at = np.flatnonzero(hit)
            one = self.careful[rank[at]]
            leads = np.concatenate([[True], seg[at[1:]] != seg[at[:-1]]])
            # a run of adjacent hits (a a a) merges at its 1st, 3rd, ... place
            new_run = np.concatenate([[True], (at[1:] != at[:-1] + 1) | leads[1:]])
            run_start = np.maximum.accumulate(np.where(new_run, np.arange(len(at)), 0))
            take = at[np.where(one, leads, (np.arange(len(at)) - run_start) % 2 == 0)]
            sym[take] = piece[take]
            keep = np.ones(len(sym), bool)
            keep[take + 1] = False
            sym, seg = sym[keep], seg[keep]
        if not done_sym:
            return np.zeros(0, np.int64), np.zeros(len(lengths), np.int64)
        sym, seg = np.concatenate(done_sym), np.concatenate(done_seg)
        order = np.argsort(seg, kind="stable")
        return self._to_ids(sym[order], seg[order], len(lengths))

    def _merge_long(self, sym: np.ndarray, seg: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of long segments after all merges, and their segments.

        A pair that no pair within ``reach`` beats merges now: whatever happens farther away, or follows from this merge
        before worse pairs have their turn, stays within one piece's length of where it began, so neither meets the other.
        Equal pairs within reach of each other form a chain that merges from the left, up to the first merge whose result
        makes an equal or better pair with a neighbour. A chain waits if an equal pair before it has to wait.
        Long chains of such merges (a run of spaces) would take a round each: when rounds get nowhere, a queue does the rest.
        """
        while True:
            rank, piece = self._ranks(sym[:-1], sym[1:])
            rank[seg[:-1] != seg[1:]] = NO_RANK
            before = _least_before(rank, self.reach)
            at = np.flatnonzero((rank < NO_RANK) & (rank <= before) & (rank <= _least_before(rank[::-1], self.reach)[::-1]))
            if not len(at):
                return sym, seg
            place = np.arange(len(at))
            linked = np.concatenate([[False], np.diff(at) <= self.reach])
            head = np.maximum.accumulate(np.where(linked, 0, place))
            new_run = np.concatenate([[True], np.diff(at) != 1])
            run_start = np.maximum.accumulate(np.where(new_run, place, 0))
            take = (rank[at] < before[at])[head] & ((place - run_start) % 2 == 0)
            at, head = at[take], head[take]

            padded, part_of = np.concatenate([[-1], sym, [-1]]), np.concatenate([[-1], seg, [-1]])      # moved by one place
            follows = np.concatenate([[False], np.diff(at) == 2])
            left = np.where(follows, np.concatenate([[-1], piece[at[:-1]]]), padded[at])
            left = np.where(part_of[at] == seg[at], left, -1)
            right = np.where(part_of[at + 3] == seg[at], padded[at + 3], -1)
            stops = (self._ranks(left, piece[at])[0] <= rank[at]) | (self._ranks(piece[at], right)[0] <= rank[at])
            stopped = np.cumsum(stops) - stops
            at = at[stopped == stopped[np.searchsorted(head, head)]]

            sym[at] = piece[at]
            keep = np.ones(len(sym), bool)
            keep[at + 1] = False
            sym, seg = sym[keep], seg[keep]
            if len(at) * PROGRESS < len(sym):
                return self._merge_in_turn(sym, seg)

    def _merge_in_turn(self, sym: np.ndarray, seg: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same, one merge after the other: the best pair first, of equal ones the leftmost."""
        pairs = {k: (r, p) for k, r, p in zip(self.pair_keys.tolist(), self.pair_rank.tolist(), self.pair_piece.tolist())}
        symbols, parts, size, n = sym.tolist(), seg.tolist(), len(sym), self.n_symbols
        after, before, queue = list(range(1, size + 1)), list(range(-1, size - 1)), []

        def offer(i: int) -> None:
            j = after[i]
            if j < size and parts[i] == parts[j] and symbols[i] >= 0 <= symbols[j]:
                key = symbols[i] * n + symbols[j]
                if key in pairs:
                    heapq.heappush(queue, (pairs[key][0], i, key))

        for i in range(size):
            offer(i)
        while queue:
            _, i, key = heapq.heappop(queue)
            j = after[i]
            if j == size or symbols[i] is None or symbols[j] is None or symbols[i] * n + symbols[j] != key:
                continue                                    # merged since
            symbols[i], symbols[j], after[i] = pairs[key][1], None, after[j]
            if after[j] < size:
                before[after[j]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        left = [i for i, s in enumerate(symbols) if s is not None]
        return np.array([symbols[i] for i in left], np.int64), seg[left]

    def _to_ids(self, sym: np.ndarray, seg: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Symbols to piece ids; what is no piece becomes its UTF-8 bytes."""
        odd = np.flatnonzero((sym < 0) | (sym >= self.n))
        if len(odd):
            names = {s: chr(c) for c, s in zip(self.char_codes.tolist(), self.char_symbols.tolist())}
            codes = {s: np.array([self.byte_ids[b] for b in (chr(-1 - s) if s < 0 else names[s]).encode("utf-8", "replace")])
                     for s in np.unique(sym[odd]).tolist()}
            times = np.ones(len(sym), np.int64)
            times[odd] = [len(codes[s]) for s in sym[odd].tolist()]
            ids = np.repeat(sym, times)
            start = np.concatenate([[0], np.cumsum(times)])[:-1][odd]
            values = np.concatenate([codes[s] for s in sym[odd].tolist()])
            inner = np.arange(len(values)) - np.repeat(np.cumsum(times[odd]) - times[odd], times[odd])
            ids[np.repeat(start, times[odd]) + inner] = values
            sym, seg = ids, np.repeat(seg, times)
        return sym, np.bincount(seg, minlength=n)

    def encode_batch(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts (begin and end ids included), flat, and the offsets of each text."""
        texts = pc.replace_substring(pc.fill_null(texts, ""), SPACE, " ")
        filled = pc.if_else(pc.equal(pc.binary_length(texts), 0), "", pc.binary_join_element_wise(" ", texts, ""))
        filled = pa.concat_arrays([filled.cast(pa.large_binary())])
        offsets = np.frombuffer(filled.buffers()[1], np.int64)[filled.offset:filled.offset + len(filled) + 1]
        if filled.buffers()[2] is None or not len(filled):
            data = np.zeros(0, np.uint8)
        else:
            data = np.frombuffer(filled.buffers()[2], np.uint8)[offsets[0]:offsets[-1]]
        offsets = offsets - (offsets[0] if len(offsets) else 0)
        cut = np.zeros(len(data) + 1, bool)
        cut[offsets] = True
        space, alone = data == 0x20, self.alone[data]
        cut[1:-1] |= space[1:] & ~space[:-1]
        cut[:-1] |= alone
        cut[1:] |= alone
        cut[len(data)] = True
        bounds = np.flatnonzero(cut)
        segments = pa.Array.from_buffers(pa.large_binary(), len(bounds) - 1, [
            None, pa.py_buffer(bounds.astype(np.int64).tobytes()), pa.py_buffer(np.ascontiguousarray(data))]).dictionary_encode()
        which, distinct = segments.indices.to_numpy(zero_copy_only=False), segments.dictionary.to_pylist()
        joined = [s.decode("utf-8").replace(" ", SPACE) for s in distinct]
        lengths = np.fromiter(map(len, joined), np.int64, len(joined))
        codes = np.frombuffer("".join(joined).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        seg_ids, seg_n = self.encode_segments(codes, lengths)
        seg_start = np.concatenate([[0], np.cumsum(seg_n)])[:-1]
        n_each = seg_n[which]
        out_start = np.concatenate([[0], np.cumsum(n_each)])
        flat = seg_ids[np.arange(out_start[-1]) + np.repeat(seg_start[which] - out_start[:-1], n_each)]
        text_at = out_start[np.searchsorted(bounds, offsets)]           # first token of each text
        counts = np.diff(text_at) + 2
        ends = np.concatenate([[0], np.cumsum(counts)])
        ids = np.empty(ends[-1], np.uint32)
        inside = np.ones(len(ids), bool)
        inside[ends[:-1]] = inside[ends[1:] - 1] = False
        ids[ends[:-1]], ids[ends[1:] - 1], ids[inside] = self.begin, self.end, flat
        return ids, ends

    # -- decoding ---------------------------------------------------------

    def decode(self, ids: np.ndarray) -> bytes:
        """UTF-8 of the text that the ids stand for: the first space goes, byte pieces join, bad bytes become U+FFFD."""
        control = self.control[ids]
        shown = ids[~control]
        drop = int(len(shown) > 0 and self.leads[shown[0]])
        at = np.flatnonzero(~control)
        if len(at) and at[-1] - at[0] >= len(at):            # a begin or end id in between parts byte pieces
            return self._decode_slowly(ids, drop)
        surface = self.surface
        out = b"".join([surface[i] for i in shown.tolist()])[drop:]
        try:
            out.decode("utf-8")
            return out
        except UnicodeDecodeError:
            return self._decode_slowly(ids, drop)

    def _decode_slowly(self, ids: np.ndarray, drop: int) -> bytes:
        parts, run = [], bytearray()

        def flush():
            rest = bytes(run)
            run.clear()
            while rest:
                for size in range(min(4, len(rest)), 0, -1):
                    try:
                        good = rest[:size].decode("utf-8")
                    except UnicodeDecodeError:
                        continue
                    if len(good) == 1:
                        parts.append(rest[:size])
                        rest = rest[size:]
                        break
                else:
                    parts.append("�".encode())
                    rest = rest[1:]

        for i in ids.tolist():
            if i in self.byte_of:
                run.append(self.byte_of[i])
            else:
                flush()
                parts.append(self.surface[i])
        flush()
        return b"".join(parts)[drop:]


def read_model(spark: SparkSession, path: str) -> bytes:
    """Bytes of the vocabulary file (a parameter): a file of the driver, or one in a store that Spark reads."""
    if "://" in path:
        return bytes(spark.read.format("binaryFile").load(path).select("content").first()[0])
    with open(path, "rb") as f:
        return f.read()


def encode_documents(docs: DataFrame, model: bytes, keep_ids: bool = True, keep_text: bool = True) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256, and on demand ``ids`` (array) and ``decoded`` (text)."""
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    schema += ", ids array<int>" * keep_ids + ", decoded string" * keep_text

    def encode(batches):
        codec = PieceModel(model)
        for batch in chunks(batches, max_bytes=4 << 20):
            ids, ends = codec.encode_batch(text_column(batch))
            ids_sha, text_sha, texts = [], [], []
            for a, b in zip(ends[:-1].tolist(), ends[1:].tolist()):
                text = codec.decode(ids[a:b])
                ids_sha.append(hashlib.sha256(ids[a:b].astype("<u4").tobytes()).hexdigest())
                text_sha.append(hashlib.sha256(text).hexdigest())
                if keep_text:
                    texts.append(text)
            columns = [batch.column("doc_id"), pa.array(np.diff(ends), pa.int64()), pa.array(ids_sha), pa.array(text_sha)]
            if keep_ids:
                columns.append(pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids.astype(np.int32))))
            if keep_text:
                columns.append(pa.array(texts, pa.binary()).cast(pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names=[f.split()[0] for f in schema.split(", ")])

    return documents(docs).mapInArrow(encode, schema)
